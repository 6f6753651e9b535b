"""Coding reference: nine coding columns and the key that stands for them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimloom.functions.dates import within_day
from dimloom.functions.text import all_of, code_prefix, dotted_key
from dimloom.operators.keys import assign_keys, highest_key
from dimloom.sources.scan import scope_filter

# Reference column, source column, prefix length (None keeps the code whole).
CODING = (
    ("project_id", "project_id", None),
    ("business_unit_id", "business_unit", None),
    ("operating_center_id", "execution_center", 2),
    ("bill_type_id", "bill_type", 2),
    ("wbs1_id", "wbs_1_code", None),
    ("wbs2_id", "wbs_2_code", None),
    ("cost_type_id", "cost_type", 5),
    ("cbs_id", "cbs", 7),
)
CODING_COLUMNS = ("portfolio_id", *[c[0] for c in CODING])


def coding_parts() -> dict[str, Column]:
    """The eight source-side coding columns under their reference names."""
    return {ref: F.col(src) if n is None else code_prefix(F.col(src), n) for ref, src, n in CODING}


def coding_prefixes(source: DataFrame) -> DataFrame:
    return source.select("portfolio_id", *[c.alias(n) for n, c in coding_parts().items()])


def composite_code(portfolio: Column | None = None) -> Column:
    """Nine whole codes joined by dots."""
    first = F.col("portfolio_id") if portfolio is None else portfolio
    return dotted_key(first, *[F.col(src) for _, src, _ in CODING])


def distinct_codings(source: DataFrame, portfolio: str, day: dt.date | str) -> DataFrame:
    """Distinct coding combinations of a scope.

    Grouping combines on the map side, so a combination held by most rows stays cheap.
    """
    return coding_prefixes(scope_filter(source, portfolio, day)).distinct()


def stage_codings(source: DataFrame, portfolio: str, day: dt.date | str, flag: str, now: dt.datetime,
                  user: str) -> DataFrame:
    """Distinct combinations of a scope as staged rows, tagged with the feed they come from."""
    other = "cost_flag" if flag == "staffing_flag" else "staffing_flag"
    return distinct_codings(source, portfolio, day).withColumns({
        flag: F.lit(1), other: F.lit(None).cast("int"), "is_valid": F.lit(1),
        "dt_created": F.lit(now).cast("timestamp_ntz"), "created_by": F.lit(user)})


def purge_codings(staged: DataFrame, portfolio: str, day: dt.date | dt.datetime) -> DataFrame:
    """Drop what was staged for the portfolio on that day, so a repeated load stages it once."""
    again = (F.col("portfolio_id") == F.lit(portfolio)) & within_day(F.col("dt_created"), day)
    return staged.filter(~again)


def _same_codes(left: DataFrame, right: DataFrame) -> Column:
    return all_of([left[c].eqNullSafe(right[c]) for c in CODING_COLUMNS])


def upsert_reference(reference: DataFrame, codings: DataFrame, flag: str, after: Column | int | None = None) -> DataFrame:
    """Merge coding combinations into the reference under ``staffing_flag`` or ``cost_flag``.

    A known combination, missing codes included, keeps its key and gains the flag; a new
    one gets the next key.  Repeating the call changes nothing.  ``after`` is the highest key
    given so far, where ``reference`` is a part of the table and cannot tell; without it, the
    highest in ``reference`` counts.
    """
    seen = codings.select(*CODING_COLUMNS, F.lit(1).alias("_seen"))
    joined = reference.join(seen, _same_codes(reference, seen), "left")
    kept = joined.select(*[
        F.greatest(reference[c], F.col("_seen")).alias(c) if c == flag else reference[c]
        for c in reference.columns])
    fresh = codings.join(reference, _same_codes(codings, reference), "left_anti")
    numbered = assign_keys(fresh, list(CODING_COLUMNS), "gcs_key", highest_key(reference, "gcs_key") if after is None else after)
    other = "cost_flag" if flag == "staffing_flag" else "staffing_flag"
    return kept.unionByName(numbered.withColumns({
        flag: F.lit(1), other: F.lit(0), "is_valid": F.lit(1)}).select(*reference.columns))


def _match(portfolio: str) -> Column:
    parts = [F.col(f"s.{name}") == F.col(f"r.{name}") for name, _, _ in CODING]
    return all_of([F.col("r.portfolio_id") == F.lit(portfolio), F.col("r.is_valid") == 1, *parts])


def _coded(source: DataFrame) -> DataFrame:
    """Source rows with the reference-side codes in place of clashing source columns."""
    parts = coding_parts()
    return source.select(*[F.col(c).alias(f"src_{c}") if c in parts else F.col(c) for c in source.columns],
                         *[c.alias(n) for n, c in parts.items()])


def _plain(coded: DataFrame, source: DataFrame, *more: str) -> DataFrame:
    parts = coding_parts()
    return coded.select(*[F.col(f"src_{c}").alias(c) if c in parts else F.col(c) for c in source.columns], *more)


def lookup_key(source: DataFrame, reference: DataFrame, portfolio: str) -> DataFrame:
    """Source rows with their ``gcs_key``; rows without a valid reference row, or with a missing code, drop out.

    No broadcast is forced: Spark broadcasts the reference when its size is under the
    session threshold and otherwise shuffles and splits a hot coding across tasks.
    """
    coded = _coded(source).alias("s")
    ref = reference.select("gcs_key", "is_valid", *CODING_COLUMNS).alias("r")
    joined = coded.join(ref, _match(portfolio), "inner")
    return _plain(joined.select("s.*", "r.gcs_key"), source, "gcs_key")


def unmatched_count(source: DataFrame, reference: DataFrame, portfolio: str) -> DataFrame:
    """One row: source rows that ``lookup_key`` drops."""
    coded = _coded(source).alias("s")
    ref = reference.select("gcs_key", "is_valid", *CODING_COLUMNS).alias("r")
    return coded.join(ref, _match(portfolio), "left_anti").agg(F.count(F.lit(1)).alias("unmatched_rows"))
