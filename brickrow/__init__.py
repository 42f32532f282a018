"""Listing pages to analysis-ready tables, as Spark jobs."""
