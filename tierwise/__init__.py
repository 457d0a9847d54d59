"""Configuration-driven bronze/silver/gold ETL on the Spark DataFrame API."""
