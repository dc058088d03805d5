"""Sales analytics on Spark: ingest, cleanse, join, summarise and report."""
