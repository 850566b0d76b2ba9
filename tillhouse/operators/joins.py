"""Joins of a big side with a smaller one, and point-in-time version lookup.

A side is broadcast only after its rows have been measured. Beyond the limit the join is
shuffled on its keys, and adaptive execution splits the partitions of a key that holds very
many rows (null included), since the other side is repeated per split. The size of a side decides
how a join runs, never what it gives.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.functions.periods import valid_on


@dataclass(frozen=True)
class JoinLimits:
    """What may be broadcast."""

    broadcast_bytes: int = 64 << 20


DEFAULT_LIMITS = JoinLimits()
#: Stretches of time that a lookup in a large dimension is cut into, at most: each holds about equally many facts.
BUCKETS = 64
#: Versions of an entity that a fact may be held against: time is cut no finer than leaves about so many in a stretch.
MET = 4


def _row_bytes(df: DataFrame) -> Column:
    """Bytes one row takes in memory: 16 per column plus the length of its text."""
    sizes = [F.lit(16 * len(df.columns))]
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.coalesce(F.octet_length(f.name), F.lit(0)))
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            sizes.append(F.coalesce(F.octet_length(F.to_json(f.name)), F.lit(0)))
    return reduce(lambda a, b: a + b, sizes).cast("bigint")


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows of ``df``, by one aggregation over them."""
    return df.agg(F.sum(_row_bytes(df)).alias("b")).first()["b"] or 0


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    limits: JoinLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """Equi-join ``big`` with ``small`` on equally named keys; null keys never match.

    ``how`` is inner, left, left_semi or left_anti. The big side is read once, with the columns
    that are used later, on either path.
    """
    keys = list(keys)
    if how in ("left_semi", "left_anti"):
        small = small.select(*keys).distinct()
    if measured_bytes(small) <= limits.broadcast_bytes:
        return big.join(F.broadcast(small), keys, how)
    return big.join(small.hint("shuffle_merge"), keys, how)


def enrich(
    dim: DataFrame, master: DataFrame, dim_key: str, master_key: str, limits: JoinLimits = DEFAULT_LIMITS
) -> DataFrame:
    """Left join to master data; the master's own key column is not kept."""
    return lookup_join(dim, master.withColumnRenamed(master_key, dim_key), [dim_key], "left", limits)


@dataclass(frozen=True)
class VersionStats:
    bytes: int
    overlaps: int
    #: Versions of the entity of a version, on average: busy entities weigh by what they have.
    met: float = 0.0


def version_stats(versions: DataFrame, natural_key: str) -> VersionStats:
    """Size of a version table, how many of its versions overlap an earlier one, and how many an entity has."""
    per_key = versions.groupBy(natural_key).agg(
        F.sum(_row_bytes(versions)).alias("b"), F.count(F.lit(1)).alias("n")
    )
    n = F.col("n").cast("double")
    size = per_key.agg(F.sum("b").alias("b"), F.max("n").alias("n"), (F.sum(n * n) / F.sum(n)).alias("met")).first()
    overlaps = overlapping_versions(versions, natural_key).count() if (size["n"] or 0) > 1 else 0
    return VersionStats(size["b"] or 0, overlaps, size["met"] or 0.0)


def buckets_for(stats: VersionStats) -> int:
    """How finely to cut time. A version is repeated for each stretch it overlaps, so entities of few versions are not cut at all."""
    return min(BUCKETS, max(1, int(stats.met / MET)))


def overlapping_versions(versions: DataFrame, natural_key: str) -> DataFrame:
    """Versions that start before an earlier one of the same entity has ended."""
    earlier = (
        Window.partitionBy(natural_key)
        .orderBy("valid_from", F.col("valid_to").asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    open_end = F.coalesce(F.col("valid_to"), F.lit("9999-12-31").cast("timestamp"))
    marked = versions.withColumn("_ended", F.max(open_end).over(earlier))
    return marked.filter(F.col("valid_from") < F.col("_ended")).drop("_ended")


def point_in_time_join(
    facts: DataFrame,
    dim: DataFrame,
    natural_key: str,
    surrogate_key: str,
    date_column: str = "time_period_end_date",
    strict: bool = True,
    limits: JoinLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """Add the surrogate key of the dimension version valid at each fact's date or instant.

    A date counts as midnight UTC; validity is compared as instants whatever the size of the
    dimension. ``strict`` makes the job that uses the result fail on a fact without a version, naming
    the dimension and the id, also if the key itself is not used; otherwise such facts keep a null key.
    Overlapping versions, which would multiply facts, are always refused.
    """
    versions = dim.select(
        F.col(natural_key).alias("_id"),
        F.col(surrogate_key).alias("_key"),
        F.col("valid_from").alias("_from"),
        F.col("valid_to").alias("_to"),
    )
    stats = version_stats(dim.select(natural_key, surrogate_key, "valid_from", "valid_to"), natural_key)
    if stats.overlaps:
        raise ValueError(f"{stats.overlaps} versions overlap on {natural_key}: facts would fan out")
    at = facts[date_column].cast("timestamp")
    on = (facts[natural_key] == F.col("_id")) & valid_on(at, "_from", "_to")
    if stats.bytes <= limits.broadcast_bytes:
        joined = facts.join(F.broadcast(versions), on, "left")
    elif (buckets := buckets_for(stats)) == 1:
        joined = facts.join(versions.hint("shuffle_merge"), on, "left")
    else:
        cuts = time_cuts(facts, date_column, buckets)
        spread = by_bucket(versions, cuts).hint("shuffle_merge")
        joined = facts.withColumn("_at", bucket_of(at, cuts)).join(spread, on & (F.col("_at") == F.col("_bucket")), "left")
    found = joined.withColumn(surrogate_key, F.col("_key")).select(*facts.columns, surrogate_key)
    return _checked(found, natural_key, surrogate_key, date_column) if strict else found


def time_cuts(facts: DataFrame, date_column: str, buckets: int = BUCKETS) -> list[int]:
    """Instants (microseconds) that cut the facts into about equally many by time, at most ``buckets - 1``, from one pass over the column."""
    at = F.col(date_column).cast("timestamp")
    shares = [k / buckets for k in range(1, buckets)]
    found = facts.agg(F.percentile_approx(F.unix_micros(at), shares, 50 * buckets).alias("cuts")).first()["cuts"]
    return sorted(set(found or []))


def _passed(at: Column, cuts: Sequence[int], ends: bool = False) -> Column:
    """How many cuts (microseconds) lie at or before an instant, or before it if it ``ends`` a stretch; null for a null one."""
    micros = F.unix_micros(at)
    return reduce(lambda n, c: n + ((micros > c) if ends else (micros >= c)).cast("int"), cuts, F.when(at.isNotNull(), F.lit(0)))


def bucket_of(at: Column, cuts: Sequence[int]) -> Column:
    """The bucket of an instant. A null one is in the first."""
    return F.coalesce(_passed(at, cuts), F.lit(0))


def by_bucket(versions: DataFrame, cuts: Sequence[int]) -> DataFrame:
    """Each version once per bucket that it overlaps, ``_bucket``.

    With the bucket in the join key a fact meets the versions of one stretch of time only, however many its
    entity has had, and the busiest entity is spread over its buckets, which hold about equally many facts. A date
    far from all others costs no more than a bucket.
    """
    first, last = bucket_of(F.col("_from"), cuts), F.coalesce(_passed(F.col("_to"), cuts, ends=True), F.lit(len(cuts)))
    covers = versions.withColumns({"_first": first, "_last": last}).filter("_first <= _last")
    return covers.withColumn("_bucket", F.explode(F.sequence("_first", "_last"))).drop("_first", "_last")


def _checked(found: DataFrame, natural_key: str, surrogate_key: str, date_column: str) -> DataFrame:
    """The same rows. The check is a filter, which stays when the key column is pruned."""
    orphan = F.raise_error(
        F.concat(
            F.lit(f"integrity error: no {surrogate_key} for {natural_key} "),
            F.coalesce(F.col(natural_key).cast("string"), F.lit("null")),
            F.lit(" on "),
            F.coalesce(F.col(date_column).cast("string"), F.lit("null")),
        )
    )
    return found.filter(F.when(F.col(surrogate_key).isNull(), orphan.cast("boolean")).otherwise(F.lit(True)))


def orphans(
    facts: DataFrame,
    dim: DataFrame,
    natural_key: str,
    surrogate_key: str,
    date_column: str = "time_period_end_date",
    limits: JoinLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """Facts that no dimension version covers on their date."""
    found = point_in_time_join(
        facts, dim, natural_key, surrogate_key, date_column, strict=False, limits=limits
    )
    return found.filter(F.col(surrogate_key).isNull()).drop(surrogate_key)


def with_history(
    facts: DataFrame, dim: DataFrame, surrogate_key: str, limits: JoinLimits = DEFAULT_LIMITS
) -> DataFrame:
    """Facts with the attributes of the version valid at the time of the fact."""
    new = [surrogate_key, *[c for c in dim.columns if c not in facts.columns]]
    return lookup_join(facts, dim.select(*new), [surrogate_key], "inner", limits)


def with_current(
    facts: DataFrame, dim: DataFrame, natural_key: str, limits: JoinLimits = DEFAULT_LIMITS
) -> DataFrame:
    """Facts with the attributes their dimension entity has now."""
    new = [natural_key, *[c for c in dim.columns if c not in facts.columns]]
    current = dim.filter("is_current").select(*new)
    return lookup_join(facts, current, [natural_key], "inner", limits)
