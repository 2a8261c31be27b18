"""DataFrame operators: ids, questions, catalog, load, checks, execution, report."""
