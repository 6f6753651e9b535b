"""Benchmark decontamination: normalised n-grams of the test items, looked up in every document's token windows.

DataFrame functions only.  Defined results: a null or wordless text has no words and no hits; a wordless item has no window; equal
windows of several items are one window that names them all; repeated rows give equal results each; rows that share an id but not
their text are judged apart; a null id is an id like any other; a null item id matches but is not named; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimloom.llm.common import ascii_lower, cut, let

#: Characters between words: all of ASCII but digits and lower-case letters.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
#: The same before lower-casing.
RAW_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
#: A window table up to this many rows (some 60 MB) is broadcast; a larger one is joined by a shuffle on the window's hash.
BROADCAST_WINDOWS = 200_000
#: The same for documents with hits, joined back to whole rows.
BROADCAST_LEAKS = 50_000


def words(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAP + "+"), lambda w: w != "")


def _windows(tokens: Column, n: int) -> Column:
    """Hashes of all windows of ``n`` words, by position.

    Hashes of 1, 2, 4, ... words are joined pairwise, so a window costs a few hashes of two numbers rather than of ``n`` words.
    """
    def joined(left: Column, right: Column, away: int) -> Column:
        return F.transform(left, lambda x, i: F.xxhash64(x, F.get(right, i + away)))

    def grow(by_width: dict[int, Column]) -> Column:
        width = max(by_width)
        if 2 * width <= n:
            one = by_width[width]
            return let(joined(one, one, width), lambda two: grow(by_width | {2 * width: two}))
        whole, done = by_width[width], width
        for part in sorted(by_width, reverse=True)[1:]:
            if done + part <= n:
                whole, done = joined(whole, by_width[part], done), done + part
        return F.slice(whole, F.lit(1), F.greatest(F.size(whole) - (n - 1), F.lit(0)))

    return let(F.transform(tokens, lambda w: F.xxhash64(w)), lambda one: grow({1: one}))


def benchmark_windows(benchmark: DataFrame, n: int = 10) -> DataFrame:
    """(n, window, items): distinct windows; an item of fewer words is one window of its own length."""
    tokens = benchmark.select("item_id", words(F.col("text")).alias("ws")).filter(F.size("ws") > 0)
    starts = tokens.select("item_id", "ws", F.explode(F.sequence(F.lit(1), F.greatest(F.size("ws") - (n - 1), F.lit(1)))).alias("i"))
    return (starts.select("item_id", F.slice("ws", F.col("i"), n).alias("window"))
            .groupBy("window").agg(F.collect_set("item_id").alias("items"))
            .select(F.size("window").alias("n"), "window", "items"))


def _hits(keyed: DataFrame, windows: DataFrame) -> DataFrame:
    """One row per document and occurrence: (doc_id, text_hash, pos, n, items).

    Positions are sought by hash alone, so a row per window is a few numbers; the words of the documents met are compared after that.
    """
    windows = cut(windows, few=True)
    sizes = windows.groupBy("n").count().collect()  # at most one row per window length
    if not sizes:
        sizes = [{"n": 1, "count": 0}]
    small = sum(row["count"] for row in sizes) <= BROADCAST_WINDOWS
    shared = F.broadcast if small else (lambda df: df)
    met = None
    for row in sizes:
        listed = windows.filter(F.col("n") == row["n"]).select(_windows(F.col("window"), row["n"])[0].alias("h")).distinct()
        scanned = keyed.select("doc_id", "text_hash", F.posexplode(_windows(words(F.col("text")), row["n"])).alias("pos", "h"))
        part = (scanned.join(shared(listed), "h", "left_semi")
                .select("doc_id", "text_hash", F.struct("pos", F.lit(row["n"]).alias("n")).alias("place")))
        met = part if met is None else met.union(part)
    met = cut(met.groupBy("doc_id", "text_hash").agg(F.collect_set("place").alias("places")), few=True)
    # Only the keys of the documents met are broadcast, their places follow by a shuffle.
    keys = met.select(F.col("doc_id").alias("m_id"), F.col("text_hash").alias("m_hash"))
    keys = F.broadcast(keys) if keys.count() <= BROADCAST_LEAKS else keys
    texts = keyed.join(keys, F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("text_hash") == F.col("m_hash")), "left_semi")
    found = let(words(F.col("t.text")), lambda ws: F.transform("m.places", lambda p: F.struct(
        p["pos"].alias("pos"), p["n"].alias("n"), F.slice(ws, p["pos"] + 1, p["n"]).alias("window"))))
    return (texts.alias("t").join(met.alias("m"), _same_row("t.doc_id", "t.text_hash", "m"))
            .select("m.doc_id", "m.text_hash", F.explode(found).alias("place")).select("doc_id", "text_hash", "place.*")
            .join(shared(windows.select("window", "items")), "window").select("doc_id", "text_hash", "pos", "n", "items"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """(doc_id, text_hash, n_hit, items, spans) of the documents with an occurrence, once per distinct id and text.

    ``spans`` are merged half-open word ranges [start, end) as structs.
    """
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    start = F.array().cast("array<struct<start:int,end:int>>")

    def grow(spans: Column, hit: Column) -> Column:
        last = F.element_at(spans, -1)
        end = hit["pos"] + hit["n"]
        whole = lambda a, b: F.array(F.struct(a.alias("start"), b.alias("end")))
        return (F.when((F.size(spans) > 0) & (F.try_element_at(spans, F.lit(-1))["end"] >= hit["pos"]), F.concat(
            F.slice(spans, F.lit(1), F.size(spans) - 1), whole(last["start"], F.greatest(last["end"], end))))
            .otherwise(F.concat(spans, whole(hit["pos"], end))))

    return (_hits(keyed, benchmark_windows(benchmark, n)).groupBy("doc_id", "text_hash")
            .agg(F.array_sort(F.collect_set(F.struct("pos", "n"))).alias("hits"),
                 F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
            .withColumn("spans", F.aggregate("hits", start, grow))
            .withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("bigint"), lambda t, s: t + s["end"] - s["start"]))
            .select("doc_id", "text_hash", "n_hit", "items", "spans"))


def report(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.size(words(F.col("text"))).cast("bigint").alias("n_words"))
    leaks = find_leaks(docs, benchmark, n)
    names = F.coalesce(F.array_sort(F.transform("l.items", lambda i: i.cast("string"))), F.array().cast("array<string>"))
    hit = F.coalesce("l.n_hit", F.lit(0).cast("bigint"))
    return rows.alias("d").join(leaks.alias("l"), _same_row("d.doc_id", "d.text_hash", "l"), "left").select(
        "d.doc_id", "n_words", hit.alias("n_hit"), F.size(names).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def _same_row(doc_id: str, text_hash: Column | str, leaks: str) -> Column:
    text_hash = F.col(text_hash) if isinstance(text_hash, str) else text_hash
    return F.col(doc_id).eqNullSafe(F.col(f"{leaks}.doc_id")) & (text_hash == F.col(f"{leaks}.text_hash"))


def _with_leaks(docs: DataFrame, benchmark: DataFrame, n: int, how: str = "left") -> DataFrame:
    """(doc, leak): whole rows as structs, so that no column of the input can clash.  A few leaks are broadcast, many shuffled."""
    leaks = cut(find_leaks(docs.select("doc_id", "text"), benchmark, n)).select(F.struct("*").alias("leak"))
    if leaks.count() <= BROADCAST_LEAKS:
        leaks = F.broadcast(leaks)
    return docs.select(F.struct("*").alias("doc")).join(leaks, _same_row("doc.doc_id", F.xxhash64("doc.text"), "leak"), how)


def drop_documents(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """Documents without any occurrence, all columns as they were."""
    return _with_leaks(docs, benchmark, n, "left_anti").select("doc.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """All documents, with every hit word and the gap after it taken out of ``text``."""
    text = F.col("doc.text")
    kept = let(F.col("leak.spans"), lambda spans: F.filter(
        F.regexp_extract_all(text, F.lit(f"{RAW_WORD}+{RAW_GAP}*"), F.lit(0)),
        lambda p, i: ~F.exists(spans, lambda s: (s["start"] <= i) & (i < s["end"]))))
    clean = (F.when(F.col("leak.n_hit") > 0, F.concat(F.regexp_extract(text, f"^{RAW_GAP}*", 0), F.array_join(kept, "")))
             .otherwise(text))
    return _with_leaks(docs, benchmark, n).select("doc", clean.alias("_clean")).select(
        *[F.col("_clean").alias(c) if c == "text" else F.col("doc").getField(c).alias(c) for c in docs.columns])
