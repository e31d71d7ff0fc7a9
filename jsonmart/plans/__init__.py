"""Conformed tables, marts, checks and questions, built from the operators."""
