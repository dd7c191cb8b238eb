"""Composed plans: the fact mart, dashboard queries, and the query catalog."""
