"""Personal data and the terms that give it away.

Patterns find e-mail addresses, IP addresses, card and phone numbers.  What they find are the protected entities.  Over the whole corpus,
the terms within ``window`` words of an entity are compared with the texts that hold the term anywhere.  All counts are of distinct texts: with
C(e) texts of an entity, C(t, e) of them with the term beside it, C(t) with the term and D in all, the term reveals
``log2(C(t, e) D / (C(t) C(e)))`` of the entity's ``-log2(C(e) / D)`` bits.  In documents that hold the entity, a term with at least
``support`` distinct contexts (copies of a passage are one context) is generalised if it reveals the share ``generalise_at`` and
removed from ``remove_at`` on.

Defined results: a null or empty text has no spans; rows are told apart by id and text, so repeated rows get equal results and rows that
share an id but not their text are judged apart; null ids are kept; extra columns are ignored by ``spans`` and returned by ``sanitise``.
Patterns run in time linear in the text.  Every document counts; nothing is capped.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimloom.llm.common import ascii_lower, cut

KINDS = ("email", "ip", "card", "phone", "term")
LABEL = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
#: A table of terms up to this many rows is broadcast; a larger one is joined by a shuffle.
BROADCAST_TERMS = 200_000

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match can only begin where a run of digits does; the possessive runs keep a failing one linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_GAP = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, number of the kind, end, normalised value), leftmost and non-overlapping per kind, in that order."""
    found, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            found.append((start, 0, m.end(), text[start:m.end()].translate(_LOWER)))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end(), m[0]))
    for m in _CARD.finditer(text):
        if 12 <= len(m[0]) <= 37 and 12 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and _luhn(d):
            found.append((m.start(), 2, m.end(), d))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(d := re.sub(r"[^0-9]", "", m[0])) <= 15:
                found.append((m.start(), 3, m.end(), d))
    return sorted(found)


def contexts(text: str, spans: list[tuple[int, int, int, str]], window: int) -> list[tuple[str, str]]:
    """(entity, sorted terms around it, space-joined) of each span; terms are runs of letters outside all spans."""
    blank = list(text) if spans else []
    for start, _, end, _ in spans:
        blank[start:end] = " " * (end - start)
    words, starts = [], []
    for m in _TERM.finditer("".join(blank)):
        words.append(m[0])
        starts.append(m.start())
    out = []
    for start, kind, end, value in spans:
        i, j = bisect_left(starts, start), bisect_left(starts, end)
        terms = {w.translate(_LOWER) for w in words[max(0, i - window):i] + words[j:j + window] if len(w) >= 3}
        out.append((f"{KINDS[kind]}:{value}", " ".join(sorted(terms))))
    return out


def _scan(docs: DataFrame, window: int) -> DataFrame:
    """Base spans and contexts of every row: doc_id, text_hash, n_email .. n_phone, base, entities, contexts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                found = base_spans(text) if text else []
                around = contexts(text, found, window) if found else []
                rows.append((*[sum(f[1] == k for f in found) for k in range(4)],
                             ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b, _ in found),
                             sorted({e for e, _ in around}), sorted({f"{e}\t{t}" for e, t in around})))
            out = pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base", "entities", "contexts"])
            out.insert(0, "text_hash", batch["text_hash"].array)
            out.insert(0, "doc_id", batch["doc_id"].array)
            yield out

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInPandas(
        run, f"doc_id {kind}, text_hash bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base string, "
             "entities array<string>, contexts array<string>")


def disclosing_terms(docs: DataFrame, scanned: DataFrame, support: int = 3, generalise_at: float = 0.8,
                     remove_at: float = 0.95) -> DataFrame:
    """(entity, term, share, remove): terms that reveal at least ``generalise_at`` of an entity's information."""
    seen = scanned.select("text_hash", F.explode("contexts").alias("context")).distinct().select(
        "text_hash", F.split("context", "\t")[0].alias("entity"), F.split("context", "\t")[1].alias("terms"))
    count_e = seen.groupBy("entity").agg(F.count_distinct("terms").alias("met"), F.count_distinct("text_hash").alias("c_e")).filter(F.col("met") >= support)
    pairs = cut(seen.join(count_e, "entity").select("entity", "c_e", "text_hash", "terms", F.explode(F.split("terms", " ")).alias("term"))
                .filter("term <> ''").groupBy("entity", "c_e", "term")
                .agg(F.count_distinct("terms").alias("met"), F.count_distinct("text_hash").alias("c_te"))
                .filter(F.col("met") >= support).drop("met"), few=True)
    terms = pairs.select("term").distinct()
    n_terms = terms.count()
    if not n_terms:
        return pairs.select("entity", "term", F.lit(1.0).alias("share"), F.lit(True).alias("remove"))
    # Copies of a text weigh as one.
    hashes = scanned.groupBy("text_hash").agg(F.count(F.lit(1)).alias("many"))
    copied = cut(hashes.filter("many > 1"), few=True)
    n_copied = copied.count()
    texts = docs.select(F.xxhash64("text").alias("text_hash"), "text")
    weighed = texts.join(F.broadcast(copied) if n_copied <= BROADCAST_TERMS else copied, "text_hash", "left").select(
        "text", (1 / F.coalesce("many", F.lit(1))).alias("weight"))
    everywhere = weighed.select("weight", F.explode(F.array_distinct(F.split(ascii_lower(F.coalesce("text", F.lit(""))), _GAP))).alias("term"))
    # Counted before the join: a common term would pass it once for every document.  (Spark moves a semi join below the count.)
    count_t = (everywhere.groupBy("term").agg(F.round(F.sum("weight")).alias("c_t"))
               .join(F.broadcast(terms) if n_terms <= BROADCAST_TERMS else terms, "term"))
    total = F.lit(float(max(2, hashes.count())))
    share = F.log2(F.col("c_te") * total / (F.col("c_t") * F.col("c_e"))) / F.greatest(-F.log2(F.col("c_e") / total), F.lit(1e-9))
    return (pairs.join(count_t, "term").withColumn("share", share).filter(F.col("share") >= generalise_at)
            .select("entity", "term", "share", (F.col("share") >= remove_at).alias("remove")))


def term_spans(text: str, terms: set[str]) -> list[tuple[int, int, str]]:
    """(start, end, term) of every occurrence outside the base spans."""
    taken = [(a, b) for a, _, b, _ in base_spans(text)]
    found, i = [], 0
    for m in _TERM.finditer(text):
        while i < len(taken) and taken[i][1] <= m.start():
            i += 1
        if (word := m[0].translate(_LOWER)) in terms and not any(a < m.end() and m.start() < b for a, b in taken[i:i + 4]):
            found.append((m.start(), m.end(), word))
    return found


def _listed(scanned: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, text_hash, terms, removed): the disclosing terms of the entities that a document holds."""
    held = scanned.filter(F.size("entities") > 0).select("doc_id", "text_hash", F.explode("entities").alias("entity")).distinct()
    return cut(held.join(terms, "entity").groupBy("doc_id", "text_hash").agg(
        F.collect_set("term").alias("terms"), F.collect_set(F.when(F.col("remove"), F.col("term"))).alias("removed")))


def _same_row(a: str, b: str) -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.text_hash") == F.col(f"{b}.text_hash"))


def spans(docs: DataFrame, window: int = 8, support: int = 3, generalise_at: float = 0.8, remove_at: float = 0.95) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base, spans (kind:start:end by start, comma-joined)."""
    scanned = cut(_scan(docs, window))
    listed = _listed(scanned, disclosing_terms(docs, scanned, support, generalise_at, remove_at))

    @F.pandas_udf("string")
    def merged(texts: pd.Series, bases: pd.Series, terms: pd.Series) -> pd.Series:
        out = []
        for text, base, own in zip(texts, bases, terms):
            all_spans = [(int((p := s.split(":"))[1]), KINDS.index(p[0]), int(p[2])) for s in base.split(",") if s]
            all_spans += [(a, 4, b) for a, b, _ in term_spans(text, set(own))]
            out.append(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(all_spans)))
        return pd.Series(out, dtype=object)

    n_listed = listed.count()
    few = (lambda df: F.broadcast(df)) if n_listed <= BROADCAST_TERMS else (lambda df: df)
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    more = (texts.alias("t").join(few(listed).alias("l"), _same_row("t", "l"))
            .select("t.doc_id", "t.text_hash", "t.text", "l.terms").dropDuplicates(["doc_id", "text_hash"])
            .join(scanned.alias("s").filter(F.size("entities") > 0).select("doc_id", "text_hash", "base")
                  .dropDuplicates(["doc_id", "text_hash"]).withColumnsRenamed({"doc_id": "b_id", "text_hash": "b_hash"}),
                  F.col("doc_id").eqNullSafe(F.col("b_id")) & (F.col("text_hash") == F.col("b_hash")))
            .select("doc_id", "text_hash", merged("text", "base", "terms").alias("spans"))) if n_listed else None
    if more is None:
        return scanned.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base", F.col("base").alias("spans"))
    return (scanned.alias("s").join(few(cut(more)).alias("m"), _same_row("s", "m"), "left")
            .select("s.doc_id", "n_email", "n_ip", "n_card", "n_phone", "base", F.coalesce("m.spans", "s.base").alias("spans")))


def sanitise(docs: DataFrame, window: int = 8, support: int = 3, generalise_at: float = 0.8, remove_at: float = 0.95) -> DataFrame:
    """All rows and columns; in ``text``, base spans become their kind's label, disclosing terms a class word or nothing.

    Documents without spans keep their text as it is; ``n_chars``, if there is such a column, follows the text.
    """
    plain = docs.select("doc_id", "text")
    scanned = cut(_scan(plain, window))
    listed = _listed(scanned, disclosing_terms(plain, scanned, support, generalise_at, remove_at))
    n_listed = listed.count()

    @F.pandas_udf("string")
    def redacted(texts: pd.Series, terms: pd.Series, removed: pd.Series) -> pd.Series:
        out = []
        for text, own, gone in zip(texts, terms, removed):
            found = base_spans(text) if text else []
            marks = [(a, b, LABEL[KINDS[k]]) for a, k, b, _ in found]
            if own is not None and text:
                gone = set(gone)
                marks += [(a, b, "" if word in gone else "[NAME]" if text[a].isupper() else "[WORD]")
                          for a, b, word in term_spans(text, set(own))]
            if marks:
                pieces, done = [], 0
                for a, b, label in sorted(marks):
                    if a >= done:
                        pieces += [text[done:a], label]
                    done = max(done, b)
                text = "".join(pieces) + text[done:]
            out.append(text)
        return pd.Series(out, dtype=object)

    rows = docs.select(F.struct("*").alias("doc"))
    nothing = F.lit(None).cast("array<string>")
    if n_listed:
        small = F.broadcast(listed) if n_listed <= BROADCAST_TERMS else listed
        rows = rows.join(small, F.col("doc.doc_id").eqNullSafe(F.col("doc_id")) & (F.xxhash64("doc.text") == F.col("text_hash")), "left")
        rows = rows.select("doc", redacted("doc.text", "terms", "removed").alias("_clean"))
    else:
        rows = rows.select("doc", redacted("doc.text", nothing, nothing).alias("_clean"))
    size = F.when(F.col("_clean").eqNullSafe(F.col("doc.text")), F.col("doc.n_chars")).otherwise(
        F.char_length("_clean")) if "n_chars" in docs.columns else None
    return rows.select(*[F.col("_clean").alias(c) if c == "text" else size.cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
                         else F.col("doc").getField(c).alias(c) for c in docs.columns])


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, counts per kind, base_sha256, spans of every row."""
    return spans(docs).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")
