import sys
from pathlib import Path

import pytest
from databases import make_database

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lakecat.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "lakecat-tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=f"file://{tmp_path_factory.mktemp('shared')}")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def lake(tmp_path_factory):
    """Folder of small databases that cover the shapes a catalog must survive."""
    folder = tmp_path_factory.mktemp("lake")
    make_database(
        folder / "bank_one.sqlite",
        "CREATE TABLE customers (id INTEGER PRIMARY KEY, name VARCHAR(50), joined DATE)",
        "CREATE TABLE accounts (id INTEGER PRIMARY KEY, customer_id INTEGER REFERENCES customers(id),"
        " balance DECIMAL(15,2))",
        rows=[
            ("INSERT INTO customers VALUES (?, ?, ?)", [(i, f"n{i}", f"2024-01-{i % 28 + 1:02d}") for i in range(1000)]),
            ("INSERT INTO accounts VALUES (?, ?, ?)", [(i * 7, i % 1000, i / 4) for i in range(3000)]),
        ],
    )
    make_database(
        folder / "school-two.db",
        'CREATE TABLE "order" (id INTEGER PRIMARY KEY AUTOINCREMENT, "first name" TEXT, "last-name" TEXT)',
        "CREATE TABLE nothing_in (a INTEGER, b TEXT)",
        "CREATE TABLE pairs (a INTEGER, b TEXT, c REAL, PRIMARY KEY (a, b)) WITHOUT ROWID",
        "CREATE TABLE child (x INTEGER, y TEXT, FOREIGN KEY (x) REFERENCES parent)",
        "CREATE TABLE mixed (n INTEGER, d DECIMAL(6,2), raw BLOB)",
        rows=[
            ('INSERT INTO "order" ("first name", "last-name") VALUES (?, ?)', [("a", "b"), (None, "ü")]),
            ("INSERT INTO pairs VALUES (?, ?, ?)", [(i % 10, f"it's {i}", i / 3) for i in range(200)]),
            ("INSERT INTO mixed VALUES (?, ?, ?)", [(1, 2.5, b"\x00\x01"), ("many", "oops", b"x"), (None, 3, None)]),
        ],
    )
    make_database(folder / "collide.sqlite", 'CREATE TABLE t ("a b" TEXT, "a-b" TEXT)',
                  rows=[("INSERT INTO t VALUES (?, ?)", [("x", "y")])])
    (folder / "header_only.sqlite").write_bytes(b"SQLite format 3\x00" + b"\x00" * 2000)
    make_database(folder / "no_tables.sqlite", "PRAGMA user_version = 1")
    return folder
