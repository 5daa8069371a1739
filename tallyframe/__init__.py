"""Table operators for a banking data warehouse, written for PySpark."""
