"""PySpark library for benchmark lakes: questions, databases, catalog, load, checks."""
