"""Operators for large text corpora and identifier sets; nothing else in the library imports this subpackage."""
