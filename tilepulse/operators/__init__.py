"""Operators: distinct-user metrics, enrichment, KPIs, data-quality checks."""
