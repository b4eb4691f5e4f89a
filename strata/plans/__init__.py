"""Composed plans: the student medallion flow and the query catalog."""
