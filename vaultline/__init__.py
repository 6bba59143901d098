"""vaultline: change-data-capture feeds into a Data Vault, cohort analysis and
data-quality checks, written as Spark DataFrame / SQL / Structured Streaming jobs."""

__version__ = "0.1.0"
