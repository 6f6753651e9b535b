import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dimloom.llm import quality
from dimloom.llm.common import fold
from dimloom.llm.queries import op12_quality

MID = "/root/testdata/sf0.01"


def test_sum_of_squares_identity_is_the_sum_over_pairs():
    rng = np.random.default_rng(3)
    size = quality.width(("n_chars",))
    model = quality.Model(("n_chars",), 0.5, 0.3, rng.standard_normal(size), rng.standard_normal((size, 5)))
    slots, values = quality.slots_of("Some words, some MORE words!\nand a line", (40.0,))
    want = 0.3 + sum(model.linear[i] * x for i, x in zip(slots, values)) + sum(
        float(model.factors[i] @ model.factors[j]) * x * y for (i, x), (j, y) in itertools.combinations(zip(slots, values), 2))
    assert math.isclose(model.margin(slots, values), want, rel_tol=1e-12)


@pytest.mark.parametrize("text, meta", [(None, None), ("", 0.0), (" \n\t", float("nan")), ("x" * 70_000, 1e300), ("word " * 30_000, -4.0), ("déjà 語 😀\x00", 3.0)])
def test_slots_of_odd_texts(text, meta):
    slots, values = quality.slots_of(text, (meta,))
    assert (np.diff(slots) > 0).all() and 0 <= slots[0] and slots[-1] < quality.width(("n_chars",)) and np.isfinite(values).all()


def test_words_beyond_any_length_count_whole():
    a, b = (quality.slots_of("x" * 70_000 + end, (1.0,))[0] for end in "pq")
    assert a[0] != b[0]


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = (spark.read.parquet(f"{MID}/{t}.parquet") for t in ("documents", "labels"))
    return quality.fit(docs, labels.filter(fold("doc_id", 4) != 2))


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{MID}/labels.parquet")
    got = op12_quality(spark, MID).join(labels, "doc_id").filter("held_out").toPandas()
    good, bad = got[got["quality"] == 1], got[got["quality"] == 0]
    assert good["predicted"].mean() > 0.98 and bad["predicted"].mean() < 0.1


def test_fit_gives_the_same_model_again(spark, model):
    docs, labels = (spark.read.parquet(f"{MID}/{t}.parquet") for t in ("documents", "labels"))
    again = quality.fit(docs.repartition(5), labels.filter(fold("doc_id", 4) != 2).repartition(3))
    a, b = (quality.scores(docs, m).toPandas().sort_values("doc_id")["predicted"].to_numpy() for m in (model, again))
    assert (a != b).mean() < 0.01


def test_odd_documents_and_clashing_columns(odd_docs, model):
    rows = odd_docs.selectExpr("*", "'no number' AS n_chars", "5 AS m0", "6 AS predicted")
    assert quality.scores(rows, model).count() == odd_docs.count()
    fine = odd_docs.selectExpr("*", "CAST(NULL AS int) AS n_chars", "5 AS m0", "6 AS predicted")
    got = quality.add_scores(fine, model).select("doc.*", F.col("score").alias("own_score")).collect()
    assert len(got) == odd_docs.count() and all(0 <= r["own_score"] <= 1 and r["m0"] == 5 for r in got)
    by_text = {}
    for r in got:
        by_text.setdefault(r["text"], set()).add(r["own_score"])
    assert all(len(s) == 1 for s in by_text.values())
    assert quality.scores(odd_docs, model).count() == odd_docs.count()


def test_no_documents_no_labels_one_kind_and_conflicts(spark, no_docs, model):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.scores(no_docs, quality.fit(no_docs, labels)).count() == 0 and quality.scores(no_docs, model).count() == 0
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(4)] + [(9, "text 0")], "doc_id long, text string")
    some = spark.createDataFrame([(0, 1), (0, 1), (1, 1), (2, None), (None, 0), (9, 0), (9, 0)], "doc_id long, quality int")
    # The text of ids 0 and 9 has one vote each way: good.
    one = quality.fit(docs, some)
    assert one.linear is None and one.prior == 1.0
    assert {r.score for r in quality.scores(docs, one).collect()} == {1.0}
