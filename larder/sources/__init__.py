"""Readers and writers: files (CSV, Parquet), partitioned feature and forecast stores, JDBC
databases and fitted models."""
