"""Data flows built from the operators: lake zones, warehouse, summaries, governance."""
