"""feedloom: Spark operators and pipelines for business data feeds."""
