"""Plateward: inspection analytics as Spark DataFrame jobs."""
