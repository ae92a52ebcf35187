"""Tidemark: DataFrame-first analytics over versioned document corpora."""
