"""Review analytics on Spark: operators, feeds and tables for bronze, silver and gold."""

__version__ = "0.1.0"
