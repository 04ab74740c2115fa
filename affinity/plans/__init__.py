"""End-to-end jobs, the query catalogue and the SQL oracles."""
