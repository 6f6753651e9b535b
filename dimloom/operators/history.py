"""Slowly changing dimensions and keyed merge.

Staged rows are unique per key (``latest_per_key``) and a dimension holds one
current row per key, so every join here is one-to-one and no key can be hot.
The classification reads only key and hash of the current rows, reduced in place to
about the staged keys; the payload of the dimension is joined with the changed keys
alone, which Spark broadcasts when they are few and otherwise shuffles.  The merge reads
either side once.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimloom.functions.dates import OPEN_END
from dimloom.operators.keys import assign_keys
from dimloom.operators.reduce import maybe_among
from dimloom.operators.staging import union_all
from dimloom.plans.registry import Mapping, Registry
from dimloom.sources.settle import settle


@dataclass(frozen=True)
class Target:
    """Column roles of a dimension."""

    key: str
    business_keys: tuple[str, ...]
    attributes: tuple[str, ...]
    hash: str = "record_hash"
    current: str = "is_current"
    start: str = "effective_start_date"
    end: str = "effective_end_date"
    open_end: dt.date = OPEN_END
    yes: str | int = "Y"
    no: str | int = "N"

    @classmethod
    def of(cls, registry: Registry, mapping: Mapping) -> Target:
        return cls(mapping.surrogate_key_col, tuple(registry.keys(mapping.mapping_id)),
                   tuple(registry.attributes(mapping.mapping_id)), mapping.hash_col, mapping.current_col,
                   mapping.start_col, mapping.end_col, mapping.end_sentinel,
                   mapping.current_flag, mapping.expired_flag)

    @property
    def payload(self) -> list[str]:
        return [*self.business_keys, *self.attributes]


def _keys_as(df: DataFrame, target: Target, *more: Column) -> DataFrame:
    """Key columns under private names, for joins that keep the other side's columns."""
    return df.select(*[F.col(k).alias(f"_k_{k}") for k in target.business_keys], *more)


def _on(target: Target, left: DataFrame) -> Column:
    condition = F.lit(True)
    for k in target.business_keys:
        condition = condition & (left[k] == F.col(f"_k_{k}"))
    return condition


def _drop_keys(df: DataFrame, target: Target) -> DataFrame:
    return df.drop(*[f"_k_{k}" for k in target.business_keys])


def current_rows(dimension: DataFrame, target: Target) -> DataFrame:
    return dimension.filter(F.col(target.current) == F.lit(target.yes))


def only_staged(rows: DataFrame, staged: DataFrame, target: Target) -> DataFrame:
    """Rows whose key is staged.

    The staged keys stand on the side Spark may broadcast, so a load that is small against
    the dimension filters it in place and shuffles no more than it brings.
    """
    return rows.join(_keys_as(staged, target), _on(target, rows), "left_semi")


def classify(staged: DataFrame, dimension: DataFrame, target: Target, written: bool = False) -> DataFrame:
    """Set ``stg_action`` of pending rows: UNCHANGED, UPDATE, or INSERT when no current row exists.

    ``written`` says that the staged rows stand in a table and are cheap to read twice: the current
    rows are then tested against a map of the staged keys before any of them is shuffled, so the join
    moves about as many rows as are staged, however large the dimension.
    """
    current = current_rows(dimension, target)
    if written:
        current = maybe_among(current, staged, [(k, k) for k in target.business_keys])
    known = _keys_as(current, target, F.col(target.hash).alias("_hash"), F.lit(True).alias("_known"))
    joined = staged.join(known, _on(target, staged), "left")
    action = (
        F.when(F.col("stg_status") != "PENDING", F.col("stg_action"))
        .when(F.col("_known").isNull(), F.lit("INSERT"))
        .when(F.col("_hash") == F.col("stg_record_hash"), F.lit("UNCHANGED"))
        .otherwise(F.lit("UPDATE"))
    )
    return _drop_keys(joined.withColumn("stg_action", action).drop("_hash", "_known"), target)


def new_keys(staged: DataFrame, dimension: DataFrame, target: Target) -> DataFrame:
    """Staged rows whose key has no current row."""
    known = _keys_as(current_rows(dimension, target), target)
    return staged.join(known, _on(target, staged), "left_anti")


def expire(dimension: DataFrame, classified: DataFrame, target: Target, as_of: dt.date) -> DataFrame:
    """Close the current version of every UPDATE key on the day before ``as_of``.

    A version opened on ``as_of`` itself is dropped, because the new one replaces it; closing
    it would end it before it began.
    """
    changed = _keys_as(classified.filter(F.col("stg_action") == "UPDATE"), target, F.lit(True).alias("_changed"))
    joined = dimension.join(changed, _on(target, dimension), "left")
    hit = F.col("_changed").isNotNull() & (F.col(target.current) == F.lit(target.yes))
    same_day = hit & (F.col(target.start) >= F.lit(as_of))
    closed = joined.filter(~same_day).withColumns({
        target.end: F.when(hit, F.lit(as_of - dt.timedelta(days=1))).otherwise(F.col(target.end)),
        target.current: F.when(hit, F.lit(target.no)).otherwise(F.col(target.current)),
    })
    return _drop_keys(closed.drop("_changed"), target)


def new_versions(classified: DataFrame, target: Target, as_of: dt.date, reporting_date: dt.date,
                 run_id: int, after: Column | int) -> DataFrame:
    """The INSERT and UPDATE rows as current versions with fresh surrogate keys."""
    fresh = classified.filter(F.col("stg_action").isin("INSERT", "UPDATE") & (F.col("stg_status") != "REJECTED"))
    numbered = assign_keys(fresh.select(*target.payload, "stg_record_hash"), list(target.business_keys),
                           target.key, after)
    return numbered.select(
        F.col(target.key),
        *target.payload,
        F.lit(as_of).alias(target.start),
        F.lit(target.open_end).alias(target.end),
        F.lit(target.yes).alias(target.current),
        F.col("stg_record_hash").alias(target.hash),
        F.lit(reporting_date).alias("reporting_date"),
        F.lit(run_id).cast("bigint").alias("etl_run_id"),
        F.lit(as_of).alias("etl_load_date"),
    )


def apply_history(dimension: DataFrame, classified: DataFrame, target: Target, as_of: dt.date,
                  reporting_date: dt.date, run_id: int, after: Column | int) -> DataFrame:
    """The whole dimension after the load: closed, kept and new versions.

    Versions closed by earlier loads take no part in any join.
    """
    closed = dimension.filter(F.col(target.current) != F.lit(target.yes))
    return (closed
            .unionByName(expire(current_rows(dimension, target), classified, target, as_of))
            .unionByName(new_versions(classified, target, as_of, reporting_date, run_id, after)))


def merge_by_key(dimension: DataFrame, staged: DataFrame, target: Target, as_of: dt.date,
                 reporting_date: dt.date, run_id: int, after: Column | int) -> DataFrame:
    """Upsert pending rows: rewrite matched rows whose hash differs, add unmatched, keep the rest.

    Also the load of a type-1 dimension.  Hashes are compared null-safely, so a row that
    never had a hash is rewritten.  One full join reads either side once and tags each row;
    its result is written out, and the added rows, read back alone, get their keys.
    """
    pending = staged.filter(F.col("stg_status") == "PENDING")
    incoming = _keys_as(pending, target, F.col("stg_record_hash").alias("_hash"), F.lit(True).alias("_in"),
                        *[F.col(a).alias(f"_v_{a}") for a in target.attributes])
    joined = dimension.withColumn("_old", F.lit(True)).join(incoming, _on(target, dimension), "full_outer")
    added = F.col("_old").isNull()
    change = added | (F.col("_in").isNotNull() & ~F.col(target.hash).eqNullSafe(F.col("_hash")))
    values = {k: F.col(f"_k_{k}") for k in target.business_keys} | {a: F.col(f"_v_{a}") for a in target.attributes} | {
        target.hash: F.col("_hash"),
        "reporting_date": F.lit(reporting_date),
        "etl_run_id": F.lit(run_id).cast("bigint"),
        "etl_load_date": F.lit(as_of),
    }
    merged = settle(joined.select(added.alias("_added"), *[
        F.when(change, values[c]).otherwise(dimension[c]).cast(dimension.schema[c].dataType).alias(c) if c in values else dimension[c]
        for c in dimension.columns]), "merged")
    fresh = assign_keys(merged.filter("_added").drop(target.key), list(target.business_keys), target.key, after)
    return merged.filter("NOT _added").unionByName(fresh).select(*dimension.columns)


def duplicate_current(dimension: DataFrame, target: Target) -> DataFrame:
    """Business keys with more than one current row."""
    return (current_rows(dimension, target).groupBy(*target.business_keys)
            .agg(F.count(F.lit(1)).alias("duplicate_count"))
            .filter(F.col("duplicate_count") > 1))


def duplicate_report(dimensions: dict[str, tuple[DataFrame, Target]]) -> DataFrame:
    """Keys with more than one current row, of several dimensions with a single key column each."""
    return union_all([
        duplicate_current(df, target).select(F.lit(name).alias("dimension"), F.col(target.business_keys[0]).alias("record_key"),
                                             "duplicate_count") for name, (df, target) in dimensions.items()])


def version_history(dimension: DataFrame, target: Target, key: dict[str, object] | None = None) -> DataFrame:
    """Versions by effective start; of one business key, or of all."""
    rows = dimension
    for column, value in (key or {}).items():
        rows = rows.filter(F.col(column) == F.lit(value))
    return rows.select(target.key, *target.payload, target.start, target.end, target.current,
                       "reporting_date", "etl_run_id").orderBy(*target.business_keys, target.start)
