import datetime as dt

from pyspark.sql import functions as F

from dimloom.operators.reduce import maybe_among
from dimloom.sources import scan


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_key_is_lost_and_most_others_go(spark):
    rows = spark.range(20_000).selectExpr("CAST(id AS string) AS k", "id AS v").union(spark.createDataFrame([(None, -1)], "k string, v bigint"))
    keys = spark.range(0, 20_000, 40).selectExpr("CAST(id AS int) AS other")
    left = maybe_among(rows, keys, [("k", "other")])
    assert left.columns == ["k", "v"]
    found = {r.v for r in left.collect()}
    assert found >= set(range(0, 20_000, 40)) and len(found) < 600


def test_few_bits_keep_more_rows_but_lose_none(spark):
    rows = spark.range(500).selectExpr("id AS a", "id % 7 AS b")
    keys = spark.range(0, 500, 5).selectExpr("id AS a", "id % 7 AS b")
    for bits in (7, 8, 12):
        left = maybe_among(rows, keys, [("a", "a"), ("b", "b")], bits)
        assert {r.a for r in left.collect()} >= set(range(0, 500, 5))
    assert maybe_among(rows, keys.limit(0), [("a", "a")]).count() == 0


def test_rows_are_not_shuffled(spark):
    rows = spark.range(1000).selectExpr("id AS k")
    shuffles = plan(maybe_among(rows, spark.range(10).selectExpr("id AS k"), [("k", "k")])).count("Exchange hashpartitioning")
    assert shuffles == 1  # that of the key map


def test_stored_maximum_is_read_from_statistics(spark, tmp_path):
    days = [dt.date(2024, 1, d) for d in (3, 17, 9)]
    spark.createDataFrame([(d, n) for n, d in enumerate(days)] + [(None, 9)], "day date, n bigint").repartition(3).write.parquet(str(tmp_path / "src"))
    for column, top in (("day", dt.date(2024, 1, 17)), ("n", 9)):
        found = scan.stored_max_watermark(spark, str(tmp_path / "src"), column)
        assert found.first()[0] == top and f"PushedAggregation: [MAX({column})]" in plan(found)
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    empty = spark.createDataFrame([], "day date").write
    empty.parquet(str(tmp_path / "none"))
    assert scan.stored_max_watermark(spark, str(tmp_path / "none"), "day").first()[0] is None


def test_numbering_shuffles_its_input_once(spark, monkeypatch):
    from dimloom.operators import keys
    written = []
    settle = keys.settle
    monkeypatch.setattr(keys, "settle", lambda df, name: written.append(plan(df)) or settle(df, name))
    numbered = keys.assign_keys(spark.range(1000).selectExpr("id AS k"), ["k"], "key", 10)
    assert sorted(r.key for r in numbered.collect()) == list(range(11, 1011))
    assert len(written) == 1 and written[0].count("Exchange") == 1
    assert "Window" not in plan(numbered.filter(F.lit(True))).split("BroadcastExchange")[0]
