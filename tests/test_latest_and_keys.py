import datetime as dt
import random

from pyspark.sql import functions as F

from dimloom.operators import keys
from dimloom.operators.latest import latest_per_key
from dimloom.sources import scan


def test_latest_row_with_tie_break_and_missing_month(spark):
    d = dt.date
    rows = [("a", d(2024, 1, 1), d(2024, 1, 5), 1), ("a", d(2024, 1, 1), d(2024, 1, 9), 2),
            ("a", None, d(2024, 1, 1), 3), ("a", None, d(2024, 1, 2), 4), ("b", d(2024, 2, 1), d(2024, 1, 1), 5)]
    df = spark.createDataFrame(rows, "k string, m date, r date, s int")
    assert {r.s for r in latest_per_key(df, ["k"], "r", "s").collect()} == {2, 5}
    assert {r.s for r in latest_per_key(df, ["k"], "r", "s", "m").collect()} == {2, 4, 5}


def test_a_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.current_date().alias("r"), F.col("id").alias("s"))
    plan = latest_per_key(df, ["k"], "r", "s")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_window_bounds_and_look_back(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, n),) for n in range(1, 6)], "r date")
    days = lambda x: sorted(r.r.day for r in x.collect())
    assert days(scan.incremental_window(df, "r", "2024-01-02", "2024-01-04")) == [3, 4]
    assert days(scan.incremental_window(df, "r", "2024-01-02", "2024-01-04", lookback_days=1)) == [2, 3, 4]


def test_window_filter_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([(dt.date(2024, 1, 1), 1, 2)], "r date, a int, b int").write.parquet(str(tmp_path / "t"))
    df = scan.incremental_window(scan.read_source(spark, str(tmp_path / "t"), ["r", "a"]), "r", "2023-01-01", "2024-06-01")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(r,2023-01-01)" in plan and "LessThanOrEqual(r,2024-06-01)" in plan
    assert "ReadSchema: struct<r:date,a:int>" in plan


def test_keys_are_dense_and_stable(spark):
    rows = spark.range(5000).withColumn("k", F.col("id").cast("string"))
    first = {r.k: r.key for r in keys.assign_keys(rows.select("k"), ["k"], "key", 10).collect()}
    assert sorted(first.values()) == list(range(11, 5011))
    shuffled = rows.select("k").repartition(7).orderBy(F.rand(3))
    assert {r.k: r.key for r in keys.assign_keys(shuffled, ["k"], "key", 10).collect()} == first


def test_keys_of_an_empty_table_start_at_one(spark):
    empty = spark.createDataFrame([], "key bigint")
    rows = keys.assign_keys(spark.range(3), ["id"], "key", keys.highest_key(empty, "key"))
    assert sorted(r.key for r in rows.collect()) == [1, 2, 3]


def test_ranges_do_not_overlap(spark):
    random.seed(1)
    widths = [(i, random.randint(0, 5)) for i in range(300)]
    df = spark.createDataFrame(widths, "id int, w int")
    rows = keys.assign_ranges(df, ["id"], "first", 0, F.col("w")).collect()
    used = [n for r in rows for n in range(r["first"], r["first"] + r["w"])]
    assert sorted(used) == list(range(1, sum(w for _, w in widths) + 1))


def test_copies_are_split_and_all_written(spark, monkeypatch):
    monkeypatch.setattr(keys, "COPIES_PER_TASK", 10)
    rows = spark.createDataFrame([("hot", 1)] * 95 + [("cold", 2)] * 3 + [("one", 3)], "a string, b int")
    folded = keys.fold_copies(rows)
    ranged = keys.assign_ranges(folded, ["a", "b", "_piece"], "key", 100, F.col("_copies") * 2)
    out = keys.unfold_copies(ranged, "key", F.lit(2).cast("bigint")).collect()
    assert len(out) == 99 and sum(r.a == "hot" for r in out) == 95
    owned = [n for r in out for n in (r.key, r.key + 1)]
    assert sorted(owned) == list(range(101, 101 + 2 * 99))


def test_keys_do_not_follow_session_settings(spark):
    rows, before = spark.range(50).withColumnRenamed("id", "n"), spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    for parts in ("3", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        found.append({r.n: r.key for r in keys.assign_keys(rows, ["n"], "key", 0).collect()})
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] and sorted(found[0].values()) == list(range(1, 51))
