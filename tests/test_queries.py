"""Every registered query of the library against its SQL twin."""

import random

import duckdb
import pytest

from siftwell.plans import QUERIES, SQL

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def rows_of(frame):
    shown = frame[sorted(frame.columns)]
    as_text = lambda x: "" if x is None or x != x else f"{x:.6f}" if isinstance(x, float) else str(x)
    return sorted(tuple(map(as_text, r)) for r in shown.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, db, name):
    got = QUERIES[name](spark, DATA).toPandas()
    if name in SQL:
        want = db.execute(SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows_of(got) == rows_of(want)
    else:
        assert len(got)


def test_entry(spark):
    import __spark_entry__

    assert set(__spark_entry__.entry(spark).columns) >= {"group_id", "p_value", "fdr", "score"}


def test_evidence_with_nulls(spark, tmp_path):
    """Nulls in every column against the SQL twin; each part's seq values differ, so that no order is left open."""
    con = duckdb.connect()
    con.execute("CREATE TABLE lineitem(l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INTEGER, l_discount DOUBLE, l_returnflag VARCHAR, l_linestatus VARCHAR)")
    rows = [
        (1, 1, 1, 1, 0.1, "R", "O"), (2, 1, 1, 2, None, "A", "F"), (3, 1, 1, None, 0.1, None, None), (4, 1, 1, 4, 0.05, None, "F"), (None, 1, 1, 5, 0.05, "N", "A"),
        (1, 2, 1, 1, None, "A", None), (2, 2, 1, 2, None, None, "Z"), (1, None, 1, 1, 0.1, "A", "F"), (5, 3, 1, 1, 0.1, "R", None), (None, 3, 1, 2, 0.1, "R", "F"),
        *[(10 + i, 4, 1, i, 0.1, "R" if i % 2 else None, "F") for i in range(1, 25)], (7, 5, 1, 2, 0.1, "", "C"), (7, 6, 1, 2, 0.1, None, None),
    ]
    con.executemany("INSERT INTO lineitem VALUES (?, ?, ?, ?, ?, ?, ?)", rows)
    con.execute(f"COPY lineitem TO '{tmp_path}/lineitem.parquet' (FORMAT PARQUET)")
    got = QUERIES["evidence_merge"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(SQL["evidence_merge"]).fetchall())


def test_evidence_of_equal_seq(spark, tmp_path):
    """Reasons of equal seq come as their first rows do in the file, or in the files by path, as one thread of the SQL
    leaves them; no part has 24 reasons, from where on the SQL's sort moves equal ones."""
    con = duckdb.connect(config={"threads": 1})
    con.execute("CREATE TABLE made(l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INTEGER, l_discount DOUBLE, l_returnflag VARCHAR, l_linestatus VARCHAR)")
    draw = random.Random(3)
    rows = [(draw.choice([1, 2, 3, None]), draw.randrange(60), 1, draw.randrange(1, 31), 0.1, draw.choice(["A", "N", "R", "", None]), "F") for _ in range(900)]
    con.executemany("INSERT INTO made VALUES (?, ?, ?, ?, ?, ?, ?)", rows)
    (tmp_path / "one").mkdir()
    con.execute(f"COPY made TO '{tmp_path}/one/lineitem.parquet' (FORMAT PARQUET)")
    several = tmp_path / "se v+e%20ral" / "lineitem.parquet"
    several.mkdir(parents=True)
    for name, start, stop in (("a", 0, 100), ("b c", 100, 350), ("b+c", 350, 600), ("b-c", 600, 900)):
        con.execute(f"COPY (SELECT * FROM made WHERE rowid >= {start} AND rowid < {stop}) TO '{several}/{name}.parquet' (FORMAT PARQUET)")
    for folder, files in ((tmp_path / "one", tmp_path / "one" / "lineitem.parquet"), (several.parent, several / "*.parquet")):
        con.execute(f"CREATE OR REPLACE VIEW lineitem AS SELECT * FROM read_parquet('{files}')")
        got = QUERIES["evidence_merge"](spark, str(folder)).collect()
        assert sorted(map(tuple, got)) == sorted(con.execute(SQL["evidence_merge"]).fetchall())


def test_evidence_rounds_as_its_sql(spark, tmp_path):
    """Scores halfway between two sixth decimals, too large for these, below them on both sides of zero, and not finite."""
    con = duckdb.connect()
    con.execute("CREATE TABLE lineitem(l_orderkey BIGINT, l_partkey BIGINT, l_linenumber INTEGER, l_discount DOUBLE, l_returnflag VARCHAR, l_linestatus VARCHAR)")
    draw = random.Random(4)
    discounts = [1 - draw.choice([1, -1]) * (draw.randrange(size * 10**6) + 0.5) / 10**6 for size in (1, 10, 1000, 10**5, 10**9) for _ in range(400)]
    discounts += [-0.0215705, 1.0000001, 1.0000005, 1.0, 0.9999999, -1e300, 1e303, -1.7e308, float("inf"), float("-inf"), float("nan"), None]
    con.executemany("INSERT INTO lineitem VALUES (?, ?, 1, ?, 'R', 'F')", [(i, i, x) for i, x in enumerate(discounts)])
    con.execute(f"COPY lineitem TO '{tmp_path}/lineitem.parquet' (FORMAT PARQUET)")
    got = QUERIES["evidence_merge"](spark, str(tmp_path)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, con.execute(SQL["evidence_merge"]).fetchall()))


def test_tier_cascade_of_odd_keys(spark, tmp_path, monkeypatch):
    """Null and repeated ids, several keys of one id, and keys of more rows than a block, against the SQL twin."""
    from siftwell.operators import resolve

    monkeypatch.setattr(resolve, "BLOCK", 3)
    con = duckdb.connect()
    con.execute("CREATE TABLE part(p_partkey BIGINT, p_size INTEGER)")
    con.execute("CREATE TABLE supplier(s_suppkey BIGINT, s_nationkey INTEGER)")
    parts = [(3, 5), (3, 5), (3, 6), (200, 5), (200, 6), (200, 6), (201, 5), (201, 30), (None, 5), (None, 30), (4, None), (300, None), (103, 30), (-4, 40), (-400, 6), (500, 12), (501, 3)]
    suppliers = [(3, 1), (3, 2), (6, 5), (6, 6), (6, 6), (7, 5), (None, 5), (None, 6), (8, None), (None, None), (-4, 3), (100, 3), (28, 1)]
    con.executemany("INSERT INTO part VALUES (?, ?)", parts + [(1000 + i, 15) for i in range(70)])
    con.executemany("INSERT INTO supplier VALUES (?, ?)", suppliers + [(5000 + i, 15) for i in range(60)])
    for t in ("part", "supplier"):
        con.execute(f"COPY {t} TO '{tmp_path}/{t}.parquet' (FORMAT PARQUET)")
    got = list(map(tuple, QUERIES["tier_cascade"](spark, str(tmp_path)).collect()))
    want = con.execute(SQL["tier_cascade"]).fetchall()
    assert len(want) > 70 * 60
    assert sorted(got, key=str) == sorted(want, key=str)
