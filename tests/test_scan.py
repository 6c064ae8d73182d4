"""Keys cut into ranges against plain windows, with ties, nulls and a key of a third of the rows."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from placeforge.operators import scan, shaping

ROWS = "k string, day int, id int, v int, _at string, m map<string,int>"


def table(spark, n=900, seed=4):
    r = random.Random(seed)
    rows = [(r.choice([None, "hot", "hot", "hot", *"abcdefgh"]), r.choice([None, *range(40)]), k, r.choice([None, None, 1, 2, 3]), "x", {"a": 1}) for k in range(n)]
    return spark.createDataFrame(rows, ROWS).drop("_at").repartition(5)


@pytest.fixture(scope="module", autouse=True)
def many_ranges(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def rows_of(df):
    return sorted((tuple(sorted(r.asDict().items())) for r in df.drop("m").collect()), key=repr)


@pytest.mark.parametrize("most", [0, 60, 10_000])
def test_ranges_give_what_windows_give(spark, most):
    order = [F.col("day").asc_nulls_last(), F.col("id").desc()]
    for f in (lambda df, m: scan.numbered(df, ["k"], order, "n", m), lambda df, m: scan.followed(df, ["k"], order, "n", ["day", "v"], m), lambda df, m: scan.filled(df, ["k"], order, "v", "near", m)):
        assert rows_of(f(table(spark), most)) == rows_of(f(table(spark), None))


def test_two_keys_and_empty_tables(spark):
    df = table(spark).withColumn("j", F.col("id") % 2)
    assert rows_of(scan.numbered(df, ["k", "j"], [F.col("id").asc()], "n", 5)) == rows_of(scan.numbered(df, ["k", "j"], [F.col("id").asc()], "n", None))
    assert scan.followed(df.limit(0), ["k"], [F.col("id").asc()], "n", ["v"], 5).count() == 0


def test_no_range_holds_a_hot_key(spark):
    df = table(spark, 3000).where("k = 'hot'")
    sizes = [r["count"] for r in scan.cut(df, ["k"], [F.col("day").asc_nulls_last()]).groupBy(scan.RANGE).count().collect()]
    assert len(sizes) > 6 and max(sizes) < 3 * sum(sizes) / len(sizes)
    same = spark.range(2000).selectExpr("'hot' AS k", "1 AS day", "id")  # all tied in the order
    sizes = [r["count"] for r in scan.cut(same, ["k"], [F.col("day").asc()]).groupBy(scan.RANGE).count().collect()]
    assert len(sizes) > 6 and max(sizes) < 3 * sum(sizes) / len(sizes)


def test_asof_of_a_hot_key(spark):
    r = random.Random(6)
    left = spark.createDataFrame([(r.choice(["hot", "hot", "a", "b", None]), r.randint(0, 400), k) for k in range(600)], "k string, a int, id int")
    right = spark.createDataFrame([(k, d, d * 2) for k in ("hot", "a", None) for d in r.sample(range(400), 60)], "k string, b int, q int")
    assert rows_of(shaping.nearest_asof(left, right, "k", "a", "b", ["q"], 40)) == rows_of(shaping.nearest_asof(left, right, "k", "a", "b", ["q"], None))


@pytest.mark.parametrize("most", [0, None])
def test_fill_reads_no_row_anew(spark, most):
    """A frame from each row to the end of its key is quadratic; the fill has none and still gives what such a frame gives."""
    df = table(spark).drop("m")
    out = scan.filled(df, ["k"], [F.col("day").asc_nulls_first(), F.col("id").asc()], "v", "near", most)
    assert "currentrow$(), unboundedfollowing$()" not in out._jdf.queryExecution().analyzed().toString()
    groups = {}
    for r in sorted(df.collect(), key=lambda r: (r.day is not None, r.day or 0, r.id)):
        groups.setdefault(r.k, []).append(r)
    expected = {r.id: next((x.v for x in [*rows[i::-1], *rows[i:]] if x.v is not None), None) for rows in groups.values() for i, r in enumerate(rows)}
    assert {r.id: r.near for r in out.collect()} == expected


def test_nulls_in_the_order_come_last_as_in_the_sql(spark, tmp_path):
    """Days, ids and lines that are missing, in hot keys and others; no two rows are tied, so the SQL has one result."""
    import duckdb

    from placeforge.plans import registry

    r, rows = random.Random(8), []
    for i in range(3000):
        missing = r.choice(["day", "id", "line", None, None])
        day = None if missing == "day" else datetime.datetime(2024, 1, 1) + datetime.timedelta(days=r.randint(0, 30))
        rows.append((None if missing == "id" else i, r.choice([None, 1, 1, 2, 3, *range(4, 9)]), None if missing == "line" else i, float(i % 50), day))
    spark.createDataFrame(rows, "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    name = "win5_hot_key_in_ranges"
    df, expected = registry.queries()[name](spark, str(tmp_path)), con.sql(registry.oracle_sql()[name])
    assert df.columns == expected.columns
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(expected.fetchall(), key=repr)
