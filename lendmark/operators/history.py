"""Dedup, incremental load and slowly changing dimensions, without a table format."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendmark.operators.ordered import HOT_ROWS, SLICE, neighbour, slice_timelines


def latest(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key: largest ``order`` columns, remaining columns as tie-break.

    A maximum over the whole row instead of a ranking window: rows of a hot
    key are combined before the shuffle, so no task receives all of them.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.max(F.struct(*order, *rest)).alias("__row")
    return df.groupBy(*keys).agg(best).select(*keys, "__row.*").select(*df.columns)


def upsert(target: DataFrame, source: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Matched keys take the source row, unmatched source keys are added.

    Of several source rows per key the newest counts, as they would make the
    outcome ambiguous otherwise. One aggregate over both sides reads each once;
    keys of the target are unique, so its rows only ever meet source rows.
    """
    side = "__source"
    both = target.withColumn(side, F.lit(0)).unionByName(source.select(*target.columns).withColumn(side, F.lit(1)))
    rest = [c for c in target.columns if c != key and c not in order]
    best = F.max(F.struct(side, *order, *rest)).alias("__row")
    named = both.filter(F.col(key).isNotNull()).groupBy(key).agg(best).select(key, "__row.*").select(*target.columns)
    # rows without a key match nothing: those of the target stay, the newest of the source is added
    unnamed = target.filter(F.col(key).isNull())
    return named.unionByName(unnamed).unionByName(latest(source.filter(F.col(key).isNull()), key, order).select(*target.columns))


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> None:
    """A table in ``buckets`` by a hash of the key, each sorted and written by one task.

    ``latest`` by this key and ``upsert_bucketed`` then read the table where it
    lies, without a shuffle. A key with very many rows is one bucket whatever
    their number: bucket tables with a row per key, such as a loaded target.
    """
    df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def upsert_bucketed(target: DataFrame, source: DataFrame, key: str, order: Sequence[str], buckets: int) -> DataFrame:
    """``upsert`` into a target read from a table of ``write_bucketed``, whose rows stay where they are.

    Only the source is shuffled, into the buckets of the target. Its rows are
    combined before that, so a hot key of the source stays small.
    """
    held = [c for c in target.columns if c != key]
    new = latest(source.select(*target.columns), key, order).repartition(buckets, key)
    new = new.select(key, F.struct(*held).alias("__new"))
    both = target.select(key, F.struct(*held).alias("__old")).join(new, key, "full_outer")
    return both.select(key, F.coalesce("__new", "__old").alias("__row")).select(key, "__row.*").select(*target.columns)


def high_water_mark(target: DataFrame | None, ts: str) -> str | None:
    """Largest loaded timestamp as text in session time, None when nothing is loaded."""
    return None if target is None else target.agg(F.max(ts).cast("string")).first()[0]


def newer_than(df: DataFrame, ts: str, target: DataFrame | None, target_ts: str | None = None) -> DataFrame:
    """Rows strictly newer than the target's newest row (1970 for an empty target).

    The mark becomes a literal, so the filter reaches the file scan.
    """
    mark = high_water_mark(target, target_ts or ts)
    dtype = df.schema[ts].dataType
    if mark is None and not isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return df.filter(F.col(ts).isNotNull())
    return df.filter(F.col(ts) > F.lit("1970-01-01" if mark is None else mark).cast(dtype))


def load_increment(landing: DataFrame, target: DataFrame | None, key: str, ts: str) -> DataFrame:
    """One incremental run: new landing rows, deduplicated, upserted into the target."""
    fresh = newer_than(landing, ts, target)
    if target is None:
        return latest(fresh, key, [ts])
    return upsert(target, fresh, key, [ts])


def scd2_seed(df: DataFrame, key: str, attributes: Sequence[str], valid_from: str) -> DataFrame:
    """First load of a dimension: every row is the open version."""
    since = F.col(valid_from)
    return df.select(
        key,
        *attributes,
        since.alias("valid_from"),
        F.lit(None).cast(df.schema[valid_from].dataType).alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def scd2_apply(
    dim: DataFrame, snapshot: DataFrame, key: str, check: Sequence[str], at: Column, carry: Sequence[str] = ()
) -> DataFrame:
    """Fold a snapshot (one row per key) into a dimension.

    Changed key: close the open version, add a new one. New key: add. Unchanged
    key: keep. Key missing from the snapshot: stays open. Columns in ``carry``
    come along with their version without opening a new one. One full outer
    join yields closed and opened rows together.
    """
    held = [*check, *carry]
    dtype = dim.schema["valid_from"].dataType
    at = at.cast(dtype)
    old = dim.filter("is_current").select(key, F.struct(*held, "valid_from").alias("old"))
    new = snapshot.select(key, F.struct(*held).alias("new"))
    both = old.join(new, key, "full_outer")

    def version(side: str, since: Column, until: Column, current: bool) -> Column:
        return F.struct(
            F.col(key),
            *(F.col(f"{side}.{c}").alias(c) for c in held),
            since.alias("valid_from"),
            until.alias("valid_to"),
            F.lit(current).alias("is_current"),
        )

    never = F.lit(None).cast(dtype)
    keep = version("old", F.col("old.valid_from"), never, True)
    close = version("old", F.col("old.valid_from"), at, False)
    start = version("new", at, never, True)
    same = F.lit(True)
    for c in check:
        same = same & F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    rows = (
        F.when(F.col("old").isNull(), F.array(start))
        .when(F.col("new").isNull() | same, F.array(keep))
        .otherwise(F.array(close, start))
    )
    layout = [key, *held, "valid_from", "valid_to", "is_current"]
    return both.select(F.inline(rows)).select(*layout).unionByName(dim.filter("NOT is_current").select(*layout))


def scd2_history(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    check: Sequence[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Versions from a change log: a version starts where a checked column differs
    from the key's previous row and ends where the next version starts.

    ``order`` must be unique within a key; its first column dates the versions.
    Keys with more than ``hot_rows`` rows are worked on in slices of their timeline.
    """
    rows, sliced = slice_timelines(df.select(key, *order, *check), key, order, hot_rows)
    seen = neighbour(rows, key, order, F.struct(*check), "__before", sliced)
    unchanged = F.col("__before").isNotNull()
    for c in check:
        unchanged = unchanged & F.col(c).eqNullSafe(F.col(f"__before.v.{c}"))
    starts = seen.filter(~unchanged).drop("__before")
    ended = neighbour(starts, key, order, F.col(order[0]), "__after", sliced, following=True)
    return ended.select(
        key,
        *order[1:],
        *check,
        F.col(order[0]).alias("valid_from"),
        F.col("__after.v").alias("valid_to"),
        F.col("__after").isNull().alias("is_current"),
    )


__all__ = [
    "SLICE",
    "high_water_mark",
    "latest",
    "load_increment",
    "newer_than",
    "scd2_apply",
    "scd2_history",
    "scd2_seed",
    "upsert",
    "upsert_bucketed",
    "write_bucketed",
]
