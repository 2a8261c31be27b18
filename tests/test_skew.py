"""The joining and folding queries on data with hot keys and nulls, against their SQL."""

import compare
import duckdb
import pytest

import __spark_entry__ as entry
from lakecat.bindings import TABLES

SOURCE = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()

# A third of the rows on one key, and nulls in the columns that queries measure.
CHANGED = {
    "orders": """* REPLACE (
        CASE WHEN o_orderkey % 3 = 0 THEN 7 WHEN o_orderkey % 50 = 1 THEN NULL ELSE o_custkey END AS o_custkey,
        CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
        CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
        CASE WHEN o_orderkey % 47 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority)""",
    "lineitem": """* REPLACE (
        CASE WHEN (l_partkey + l_linenumber) % 3 = 0 THEN 5 ELSE l_orderkey END AS l_orderkey,
        CASE WHEN l_partkey % 31 = 0 THEN NULL ELSE l_partkey END AS l_partkey,
        CASE WHEN l_suppkey % 29 = 0 THEN NULL ELSE l_extendedprice END AS l_extendedprice)""",
    "documents": """* REPLACE (
        CASE WHEN doc_id % 29 = 0 THEN NULL ELSE text END AS text,
        CASE WHEN doc_id % 31 = 0 THEN NULL ELSE lang END AS lang,
        CASE WHEN doc_id % 3 = 0 THEN 'src0' WHEN doc_id % 37 = 1 THEN NULL WHEN doc_id % 41 = 1 THEN ''
             ELSE source END AS source)""",
    "labels": "* REPLACE (CASE WHEN doc_id % 7 = 0 THEN NULL ELSE quality END AS quality)",
    "customer": """* REPLACE (
        CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
        CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment)""",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    out = tmp_path_factory.mktemp("skew")
    db = duckdb.connect()
    for name in TABLES:
        columns = CHANGED.get(name, "*")
        db.execute(f"COPY (SELECT {columns} FROM '{SOURCE}/{name}.parquet') TO '{out}/{name}.parquet' (FORMAT parquet)")
    return str(out)


@pytest.mark.parametrize("name", [
    name for name in sorted(ORACLES)
    if name.startswith(("v_", "q_", "m_", "d_", "g_", "r_a", "t_", "w_", "a_", "j_", "l_", "p_", "s_p", "k_q", "k_b", "k_l"))])
def test_matches_sql(spark, folder, name):
    assert compare.same(name, QUERIES[name](spark, folder), compare.connect(folder, TABLES), ORACLES[name]) is None
