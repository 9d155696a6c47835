"""Inputs: landed pages (R1), daily Parquet roots (R2), HTML tables (R3), local rows (R4), table scans, and the fixtures derived from the driver tables."""
