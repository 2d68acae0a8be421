"""feedloom: corpus ingestion and change capture as Spark DataFrame jobs."""
