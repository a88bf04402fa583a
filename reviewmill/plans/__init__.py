"""Data products: bronze, silver and gold tables, enrichment, quality and dashboards."""
