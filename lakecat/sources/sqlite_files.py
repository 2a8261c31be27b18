"""What one task does with one SQLite database: open it, list it, read a key range.

Runs inside executors only. A database is a path every executor can open, or its
bytes (from `binaryFile` or an embedded payload) where storage is not mounted.
"""

from __future__ import annotations

import os
import sqlite3
from collections.abc import Iterator
from contextlib import closing
from decimal import Decimal
from urllib.parse import quote

FETCH_ROWS = 8192


def local_path(path: str) -> str:
    """Plain path of a `file:` path as Spark lists it (not percent-encoded); plain paths as they are."""
    if path.startswith("file:"):
        return "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        raise sqlite3.OperationalError(f"{path} is not on mounted storage: read it with read_payloads")
    return path


def open_database(path: str | None, payload: bytes | None = None) -> closing:
    """Read-only connection, from the bytes when there are any."""
    if payload is not None:
        connection = sqlite3.connect(":memory:")
        connection.deserialize(payload)
    else:
        plain = local_path(path)
        # A file with a write-ahead log beside it is read through the log; one that cannot be is an error.
        frozen = "" if has_log(plain) else "&immutable=1"
        connection = sqlite3.connect(f"file:{quote(plain)}?mode=ro{frozen}", uri=True)
    return closing(connection)


def has_log(path: str) -> bool:
    try:
        return os.path.getsize(f"{path}-wal") > 0
    except OSError:
        return False


def identifier(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def table_names(db: sqlite3.Connection) -> list[str]:
    return [name for (name,) in db.execute("SELECT name FROM sqlite_master WHERE type = 'table'")]


def table_columns(db: sqlite3.Connection, table: str) -> list[tuple[str, str, bool]]:
    """(name, declared type, part of the primary key), in position order."""
    return [(row[1], row[2], row[5] > 0) for row in db.execute(f"PRAGMA table_info({identifier(table)})")]


def stored_columns(db: sqlite3.Connection, table: str) -> list[tuple[str, str]]:
    """(name, declared type) of what `SELECT *` brings: generated columns too, hidden ones not."""
    return [(row[1], row[2]) for row in db.execute(f"PRAGMA table_xinfo({identifier(table)})") if row[6] != 1]


def find_table(db: sqlite3.Connection, table: str) -> str | None:
    """The name of a table as the database spells it; SQLite compares ASCII letters without case."""
    return next((name for name in table_names(db) if folded(name) == folded(table)), None)


def folded(name: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in name)


# How values are stored, as bits: of a column, all its values together. A large integer need not be a double.
STORED = {"integer": 1, "real": 2, "text": 4, "blob": 8}
LARGE, LARGEST_EXACT = 16, 2 ** 53


def count_and_kinds(db: sqlite3.Connection, table: str, columns: list[str], low: str | None = None,
                    high: str | None = None) -> tuple[int, list[int], list[int]]:
    """Rows in (low, high], and of each column the kinds of its values and how many are not null, by one scan."""
    key = range_key(db, table) if low is not None or high is not None else []
    kinds, filled, groups = [], [], [columns[i:i + 400] for i in range(0, len(columns), 400)] or [[]]
    for group in groups:  # SQLite bounds the columns of a result
        asked = "".join(
            ", " + " + ".join(f"{bit} * ifnull(max(typeof(t.{identifier(c)}) = '{kind}'), 0)" for kind, bit in STORED.items())
            + f" + {LARGE} * ifnull(max(typeof(t.{identifier(c)}) = 'integer' AND"
            f" t.{identifier(c)} NOT BETWEEN -{LARGEST_EXACT} AND {LARGEST_EXACT}), 0), count(t.{identifier(c)})"
            for c in group)
        rows, *found = db.execute(f"SELECT count(*){asked} FROM {identifier(table)} t{_between(key, low, high)}").fetchone()
        kinds += found[::2]
        filled += found[1::2]
    return rows, kinds, filled


def decimal_places(db: sqlite3.Connection, table: str, column: str, low: str | None, high: str | None) -> tuple[int, int]:
    """Digits before and after the point that the numbers of a column need in (low, high]; 99 and 99 with an infinite one."""
    key = range_key(db, table) if low is not None or high is not None else []
    name = f"t.{identifier(column)}"
    condition = _between(key, low, high) or " WHERE true"
    whole, scale = 0, 0
    for (value,) in db.execute(
            f"SELECT DISTINCT {name} FROM {identifier(table)} t{condition} AND typeof({name}) IN ('integer', 'real')"):
        exact = Decimal(repr(value))
        if not exact.is_finite():
            return 99, 99
        digits, exponent = exact.as_tuple()[1:]
        whole, scale = max(whole, len(digits) + exponent), max(scale, -exponent)
    return whole, scale


def foreign_keys(db: sqlite3.Connection, table: str) -> list[tuple[str, str, str | None]]:
    """(source column, target table, target column), in the order SQLite lists them."""
    return [(row[3], row[2], row[4]) for row in db.execute(f"PRAGMA foreign_key_list({identifier(table)})")]


def count_rows(db: sqlite3.Connection, table: str) -> int:
    return db.execute(f"SELECT count(*) FROM {identifier(table)}").fetchone()[0]


def range_key(db: sqlite3.Connection, table: str) -> list[str]:
    """Columns that order a table by its own B-tree: the rowid, or the primary key."""
    columns = table_columns(db, table)
    taken = {name.lower() for name, _, _ in columns}
    for alias in ("rowid", "_rowid_", "oid"):
        if alias not in taken:
            try:
                db.execute(f"SELECT {alias} FROM {identifier(table)} LIMIT 0")
                return [alias]
            except sqlite3.OperationalError:
                break
    keyed = db.execute(f"PRAGMA table_info({identifier(table)})").fetchall()
    return [identifier(row[1]) for row in sorted((r for r in keyed if r[5]), key=lambda r: r[5])]


def _between(key: list[str], low: str | None, high: str | None) -> str:
    """Condition `low < key <= high` over SQL literals; an end that is None is open."""
    row = f"({', '.join(key)})"
    parts = [f"{row} > ({low})"] if low is not None else []
    parts += [f"{row} <= ({high})"] if high is not None else []
    return f" WHERE {' AND '.join(parts)}" if parts else ""


def even_ranges(db: sqlite3.Connection, table: str, n: int) -> list[tuple[str | None, str | None]]:
    """`n` ranges of equal rowid width; one open range where the key is no rowid."""
    key = range_key(db, table)
    if n <= 1 or len(key) != 1 or key[0].startswith('"'):
        return [(None, None)]
    name = identifier(table)
    low, high = db.execute(
        f"SELECT (SELECT min({key[0]}) FROM {name}), (SELECT max({key[0]}) FROM {name})").fetchone()
    if low is None:
        return [(None, None)]
    width = high - low + 1
    cuts = sorted({low - 1 + width * i // n for i in range(1, n)} - {low - 1})
    ends = [None, *map(str, cuts), None]
    return list(zip(ends, ends[1:]))


def counted_ranges(db: sqlite3.Connection, table: str, low: str | None, high: str | None,
                   rows: int) -> Iterator[tuple[str | None, str | None, int]]:
    """Split (low, high] into consecutive ranges of `rows` rows: (low, high, n).

    Walks the table's own B-tree from cut to cut, so ranges hold equal numbers of
    rows however sparse or uneven the keys are. The last range keeps its open end.
    """
    key, name = range_key(db, table), identifier(table)
    if not key:
        yield low, high, count_rows(db, table)
        return
    literal = " || ', ' || ".join(f"quote({column})" for column in key)
    while True:
        cut = db.execute(
            f"SELECT {literal} FROM {name}{_between(key, low, high)}"
            f" ORDER BY {', '.join(key)} LIMIT 1 OFFSET {rows - 1}").fetchone()
        if cut is None:
            rest = db.execute(f"SELECT count(*) FROM {name}{_between(key, low, high)}").fetchone()[0]
            yield low, high, rest
            return
        yield low, cut[0], rows
        low = cut[0]


def as_text(value) -> str | None:
    """Lossless text of any SQLite value; a blob as the literal X'..'."""
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, bytes):
        return f"X'{value.hex()}'"
    return repr(value)


def as_bytes(value) -> bytes | None:
    if value is None or isinstance(value, bytes):
        return value
    return as_text(value).encode()


def read_range(db: sqlite3.Connection, table: str, columns: list[str], low: str | None,
               high: str | None) -> Iterator[list[tuple]]:
    """Batches of column tuples of the rows in (low, high]."""
    key = range_key(db, table) if low is not None or high is not None else []
    # Qualified: SQLite takes an unknown quoted name for a text.
    selected = ", ".join(f"t.{identifier(column)}" for column in columns)
    cursor = db.execute(f"SELECT {selected} FROM {identifier(table)} t{_between(key, low, high)}")
    while batch := cursor.fetchmany(FETCH_ROWS):
        yield list(zip(*batch))


def has_header(path: str) -> bool:
    try:
        with open(local_path(path), "rb") as file:
            return file.read(16).startswith(b"SQLite format 3")
    except OSError:
        return False
