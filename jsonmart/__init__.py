"""Layered JSON analytics on Spark: raw documents -> conformed tables -> marts."""
