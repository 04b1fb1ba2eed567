"""Supplier reporting for a wholesale distributor, as Spark DataFrame jobs."""
