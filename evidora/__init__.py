"""Evidence ingestion and analysis as Spark plans."""
