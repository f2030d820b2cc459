"""Data quality, mapping and migration of record batches, written as Spark DataFrame plans."""
