"""Point-in-time document corpora on Spark: sources, parsing, search, as-of queries, aggregates and sinks."""
