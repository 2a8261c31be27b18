"""Column functions: names, types, text measures, domain rules."""
