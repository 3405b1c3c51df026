"""Trip lakehouse, warehouse, summaries and governed master data on Spark."""
