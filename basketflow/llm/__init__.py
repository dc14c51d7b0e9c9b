"""Operators for preparing large text corpora: deduplication, classification,
tokenisation, mixing and search. Nothing outside this package imports it."""
