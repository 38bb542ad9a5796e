"""Spark jobs for scaffolding contigs with contact data, and for text corpora."""
