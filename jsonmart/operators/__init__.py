"""Generic DataFrame operators that know nothing about any data model."""
