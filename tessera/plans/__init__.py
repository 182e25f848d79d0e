"""Assembled plans: entity definitions, the warehouse, reports and the query registry."""
