"""Operators for preparing large text corpora. Nothing else in tidemark imports this subpackage."""
