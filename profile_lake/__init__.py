"""Ingestion and analytics of database query-execution profiles on Spark."""
