import datetime as dt

from pyspark.sql import functions as F

from dimloom.operators import history
from dimloom.operators.history import Target

T = Target("sk", ("k",), ("v",))
D = dt.date
DIM = ("sk bigint, k string, v string, effective_start_date date, effective_end_date date, is_current string, "
       "record_hash string, reporting_date date, etl_run_id bigint, etl_load_date date")
STG = "stg_status string, stg_action string, stg_record_hash string, k string, v string"


def empty(spark):
    return spark.createDataFrame([], DIM)


def load(spark, dim, day, rows, run=1):
    staged = spark.createDataFrame([("PENDING", None, f"h{v}", k, v) for k, v in rows], STG)
    classified = history.classify(staged, dim, T)
    top = dim.agg(F.max("sk")).first()[0] or 0
    out = history.apply_history(dim, classified, T, day, day, run, top).collect()
    return spark.createDataFrame(out, DIM), {r.k: r.stg_action for r in classified.collect()}


def versions(dim, key):
    return sorted((r.effective_start_date, r.effective_end_date, r.v, r.is_current)
                  for r in dim.filter(F.col("k") == key).collect())


def test_three_actions(spark):
    dim, first = load(spark, empty(spark), D(2024, 1, 1), [("a", "1"), ("b", "1")])
    assert first == {"a": "INSERT", "b": "INSERT"}
    dim, second = load(spark, dim, D(2024, 2, 1), [("a", "1"), ("b", "2"), ("c", "1")], 2)
    assert second == {"a": "UNCHANGED", "b": "UPDATE", "c": "INSERT"}
    assert versions(dim, "b") == [(D(2024, 1, 1), D(2024, 1, 31), "1", "N"), (D(2024, 2, 1), D(9999, 12, 31), "2", "Y")]
    assert versions(dim, "a") == [(D(2024, 1, 1), D(9999, 12, 31), "1", "Y")]
    keys = [r.sk for r in dim.collect()]
    assert len(set(keys)) == len(keys) == 4


def test_running_again_changes_nothing(spark):
    dim, _ = load(spark, empty(spark), D(2024, 1, 1), [("a", "1")])
    again, actions = load(spark, dim, D(2024, 1, 2), [("a", "1")], 2)
    assert actions == {"a": "UNCHANGED"} and again.collect() == dim.collect()


def test_second_change_of_a_day_replaces_the_first(spark):
    dim, _ = load(spark, empty(spark), D(2024, 1, 1), [("a", "1")])
    dim, _ = load(spark, dim, D(2024, 2, 1), [("a", "2")], 2)
    dim, _ = load(spark, dim, D(2024, 2, 1), [("a", "3")], 3)
    assert versions(dim, "a") == [(D(2024, 1, 1), D(2024, 1, 31), "1", "N"), (D(2024, 2, 1), D(9999, 12, 31), "3", "Y")]


def test_value_to_null_and_back_makes_versions(spark):
    dim = empty(spark)
    for month, value in ((1, None), (2, "x"), (3, None)):
        dim, _ = load(spark, dim, D(2024, month, 1), [("a", value)], month)
    assert [v for _, _, v, _ in versions(dim, "a")] == [None, "x", None]


def test_only_closed_versions_means_insert(spark):
    closed = spark.createDataFrame([(7, "a", "1", D(2023, 1, 1), D(2023, 6, 1), "N", "h1", None, 1, None)], DIM)
    dim, actions = load(spark, closed, D(2024, 1, 1), [("a", "1")], 2)
    assert actions == {"a": "INSERT"} and {r.sk for r in dim.collect()} == {7, 8}


def test_missing_hash_counts_as_change(spark):
    old = spark.createDataFrame([(1, "a", "1", D(2023, 1, 1), D(9999, 12, 31), "Y", None, None, 1, None)], DIM)
    _, actions = load(spark, old, D(2024, 1, 1), [("a", "1")])
    assert actions == {"a": "UPDATE"}


def test_rejected_rows_take_no_part(spark):
    staged = spark.createDataFrame([("REJECTED", None, "h", "a", "1")], STG)
    classified = history.classify(staged, empty(spark), T)
    assert classified.first().stg_action is None
    assert history.apply_history(empty(spark), classified, T, D(2024, 1, 1), D(2024, 1, 1), 1, 0).count() == 0


def test_intervals_never_overlap(spark):
    dim = empty(spark)
    for n in range(1, 6):
        dim, _ = load(spark, dim, D(2024, n, 1), [(k, str((n * i) % 3)) for i, k in enumerate("abcdef")], n)
    assert history.duplicate_current(dim, T).count() == 0
    for key in "abcdef":
        spans = versions(dim, key)
        assert all(e < s2 for (_, e, _, _), (s2, _, _, _) in zip(spans, spans[1:]))
        assert all(s <= e for s, e, _, _ in spans)


MDIM = "sk bigint, k string, v string, record_hash string, reporting_date date, etl_run_id bigint, etl_load_date date"


def test_merge_updates_inserts_and_keeps(spark):
    dim = spark.createDataFrame([(1, "same", "1", "h1", D(2023, 1, 1), 1, D(2023, 1, 1)),
                                 (2, "diff", "1", "h1", D(2023, 1, 1), 1, D(2023, 1, 1)),
                                 (3, "none", "1", None, D(2023, 1, 1), 1, D(2023, 1, 1)),
                                 (4, "away", "1", "h1", D(2023, 1, 1), 1, D(2023, 1, 1))], MDIM)
    staged = spark.createDataFrame([("PENDING", None, "h1", "same", "1"), ("PENDING", None, "h2", "diff", "2"),
                                    ("PENDING", None, "h3", "none", "3"), ("PENDING", None, "h4", "new", "4"),
                                    ("REJECTED", None, "h5", "bad", "5")], STG)
    rows = {r.k: r for r in history.merge_by_key(dim, staged, T, D(2024, 1, 1), D(2023, 12, 31), 2, 4).collect()}
    assert {k: (r.sk, r.v, r.etl_run_id) for k, r in rows.items()} == {
        "same": (1, "1", 1), "diff": (2, "2", 2), "none": (3, "3", 2), "away": (4, "1", 1), "new": (5, "4", 2)}
    assert rows["diff"].reporting_date == D(2023, 12, 31) and rows["diff"].etl_load_date == D(2024, 1, 1)


def test_merge_again_changes_nothing(spark):
    staged = spark.createDataFrame([("PENDING", None, "h1", "a", "1"), ("PENDING", None, "h2", "b", "2")], STG)
    once = history.merge_by_key(spark.createDataFrame([], MDIM), staged, T, D(2024, 1, 1), D(2024, 1, 1), 1, 0).collect()
    dim = spark.createDataFrame(once, MDIM)
    twice = history.merge_by_key(dim, staged, T, D(2024, 1, 2), D(2024, 1, 2), 2, 2).collect()
    assert sorted(once) == sorted(twice)


def test_duplicate_current_and_version_history(spark):
    dim = spark.createDataFrame([(1, "a", "1", D(2023, 1, 1), D(9999, 12, 31), "Y", "h", None, 1, None),
                                 (2, "a", "2", D(2023, 2, 1), D(9999, 12, 31), "Y", "h", None, 1, None),
                                 (3, "b", "1", D(2023, 1, 1), D(2023, 2, 1), "N", "h", None, 1, None)], DIM)
    assert [tuple(r) for r in history.duplicate_current(dim, T).collect()] == [("a", 2)]
    assert [r.sk for r in history.version_history(dim, T, {"k": "a"}).collect()] == [1, 2]


def test_other_flag_values(spark):
    numeric = Target("sk", ("k",), ("v",), yes=1, no=0)
    dim = empty(spark).withColumn("is_current", F.col("is_current").cast("int"))
    staged = spark.createDataFrame([("PENDING", "INSERT", "h", "a", "1")], STG)
    rows = history.apply_history(dim, staged, numeric, D(2024, 1, 1), D(2024, 1, 1), 1, 0).collect()
    assert [r.is_current for r in rows] == [1]
