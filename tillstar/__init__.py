"""Retail analytics on Spark: raw sales tables to a star schema and the analyses on it."""
