"""Whole plans: harmonising raw tables, building the warehouse, queries, published documents."""
