"""SQLite files for tests."""

import sqlite3
from contextlib import closing


def make_database(path, *statements, rows=()):
    """A SQLite file from statements and (sql, list of rows) inserts."""
    with closing(sqlite3.connect(path)) as db:
        for statement in statements:
            db.execute(statement)
        for sql, values in rows:
            db.executemany(sql, values)
        db.commit()
    return str(path)
