"""Readers of counts, tables, read files, gene annotations and gene sets, and writers of results."""
