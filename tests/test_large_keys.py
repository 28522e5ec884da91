"""Queries whose made-up ids must hold for the keys of large tables, against their SQL."""

import duckdb
import pytest

import __spark_entry__ as e

COLUMNS = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double"
#: (order, part, supplier, line): boxes whose numbers meet if a line counts for 10^6, and an order for 10^7.
LINES = [(97, 1_000_500, 10, 1), (97, 500, 10, 2), (194, 4_000_000, 10, 6), (195, 0, 3, 0), (292, 7_000_001, 3, 7), (293, 4_000_001, 9, 0)]


@pytest.mark.parametrize("name", ["nms", "nms_tiles", "iou", "leader_cluster"])
def test_boxes_of_large_keys(spark, tmp_path, name):
    rows = [(o, p, s, n, 10.0, 0.05) for o, p, s, n in LINES]
    spark.createDataFrame(rows, COLUMNS).coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    got = e.queries()[name](spark, str(tmp_path))
    want = duck.sql(f"SELECT {', '.join(got.columns)} FROM ({e.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
