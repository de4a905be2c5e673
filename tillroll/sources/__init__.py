"""Sources (documents, parquet tables) and sinks."""
