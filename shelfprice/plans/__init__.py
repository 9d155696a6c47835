"""The daily jobs (J1-J6), the registered queries and their DuckDB oracle SQL."""
