"""Document analytics on Spark: sources, text operators, scoring, chunking and exact vector search."""
