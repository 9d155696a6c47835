"""Outputs: CSV export (K1), daily Parquet partitions (K2), JDBC tables (K3)."""
