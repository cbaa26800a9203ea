"""rillflow: log ingestion and ETL as ordinary Spark DataFrame and streaming jobs."""
