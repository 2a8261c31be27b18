"""Sources: question splits, database files, embedded payloads, SQLite tables."""
