"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import math
import os

import pytest

duckdb = pytest.importorskip("duckdb")
from tessera.plans import bulletins, catalog, matching, operations, reconciliation, tasks  # noqa: E402, F401

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return tuple(map(plain, v)) if isinstance(v, list) else v


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, db, name):
    df = catalog.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    rows = sorted(([plain(r[c]) for c in columns] for r in df.collect()), key=repr)
    if name in catalog.ORACLES:
        found = db.execute(catalog.ORACLES[name])
        names = [d[0] for d in found.description]
        expected = sorted(([plain(dict(zip(names, r))[c]) for c in columns] for r in found.fetchall()), key=repr)
        assert sorted(names) == columns
        assert rows == expected


def test_timeline_takes_every_row_of_both_sides(spark):
    from tessera.plans.harness import side_a, side_b

    rows = catalog.QUERIES["timeline_full_outer"](spark, DATA).collect()
    for column, side in (("left_value", side_a), ("right_value", side_b)):
        assert sum(r[column] or 0 for r in rows) == side(spark, DATA).agg({"Deaths": "sum"}).first()[0]
        assert any(r[column] is None for r in rows)


def test_text_queries_take_whole_tables(spark, tmp_path):
    found = {r["seq"]: r["row_id"] for r in catalog.QUERIES["corrections_by_text"](spark, DATA).collect()}
    sizes = {r["p_partkey"]: r["p_size"] for r in spark.read.parquet(f"{DATA}/part.parquet").collect()}
    assert any(sizes[p] >= 2 for p in found.values())
    docs = spark.read.parquet(f"{DATA}/documents.parquet").filter("text IS NOT NULL")
    assert catalog.QUERIES["narrative_predicates"](spark, DATA).count() == docs.select("doc_id").distinct().count()
    nation = spark.read.parquet(f"{DATA}/nation.parquet").selectExpr("* EXCEPT (n_nationkey)", "n_nationkey + 8 AS n_nationkey")
    nation.write.parquet(str(tmp_path / "nation.parquet"))
    spark.read.parquet(f"{DATA}/orders.parquet").write.parquet(str(tmp_path / "orders.parquet"))
    lines = catalog.QUERIES["relevant_lines"](spark, str(tmp_path))
    assert lines.filter("line LIKE '% NATION_3'").count() > 0
