"""End-to-end jobs, registered queries and their SQL oracles."""
