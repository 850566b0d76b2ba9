"""Files as a stream: bronze append, and silver dimensions and facts kept up per micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillhouse.operators.bronze import strings_only, with_provider, with_security
from tillhouse.operators.dedupe import INGESTED
from tillhouse.plans import silver
from tillhouse.plans.lakehouse import Lakehouse
from tillhouse.plans.providers import Provider
from tillhouse.schemas import PROVENANCE, TABLE_KEYS
from tillhouse.session import scratch, together, written
from tillhouse.sources.feeds import DELIMITERS
from tillhouse.sources.tables import load_table, upsert_table

ARRIVED = "_arrived"


def stream_feed(
    spark: SparkSession,
    landing: str,
    fmt: str,
    schema: T.StructType,
    files_per_batch: int = 1000,
    json_lines: bool = False,
) -> DataFrame:
    """New files of a landing directory; the checkpoint remembers which were read.

    Each batch reads a bounded number of files, so a large backlog is worked off in
    steps instead of all at once.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if fmt in DELIMITERS:
        reader = reader.option("header", "true").option("sep", DELIMITERS[fmt])
        reader = reader.option("enforceSchema", "false")
        return reader.csv(landing)
    if fmt == "json":
        return reader.option("multiLine", str(not json_lines).lower()).json(landing)
    if fmt == "parquet":
        return reader.parquet(landing)
    raise ValueError(f"unsupported feed format {fmt!r}")


def stream_bronze(
    feed: DataFrame, provider_id: int | str, secure_group_key: int, data_source: str
) -> DataFrame:
    """The stateless bronze projection; rows of one micro-batch share its trigger time."""
    now = F.current_timestamp()
    tagged = feed.transform(strings_only).transform(with_security, secure_group_key)
    return tagged.transform(with_provider, provider_id).withColumns(
        {INGESTED: now, "created_at_date": F.to_date(now), "data_source": F.lit(data_source)}
    )


def without_resent(rows: DataFrame, columns: Sequence[str] | None = None, within: str = "30 days") -> DataFrame:
    """Rows that did not come before ``within`` that time: a file sent again, under its own name or another, adds nothing.

    Time is that of the micro-batch, so no row is ever too late, however old its sales are; and what is remembered is
    bounded by what arrives ``within``. Rows are told apart by ``columns``, or by all.
    """
    keys = list(columns or rows.columns)
    seen = rows.withColumn(ARRIVED, F.current_timestamp()).withWatermark(ARRIVED, within)
    return seen.dropDuplicatesWithinWatermark(keys).drop(ARRIVED)


def append_stream(rows: DataFrame, path: str, checkpoint: str, partition_by=()) -> StreamingQuery:
    """Append everything that is there now, each file exactly once, then stop."""
    writer = rows.writeStream.format("parquet").outputMode("append").partitionBy(*partition_by)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)


def stream_batches(
    rows: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]
) -> StreamingQuery:
    writer = rows.writeStream.foreachBatch(handle).outputMode("update")
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def dimension_feed(rows: DataFrame, who: Provider, table: str) -> DataFrame:
    """The bronze columns that a provider's dimension is made of. A micro-batch holds all columns of its stream, used or not."""
    fields, extras = {"prod_dim": (who.prod, who.prod_extras), "site_dim": (who.site, who.site_extras)}[table]
    used = {*[source for source, _ in fields.values()], *extras, *PROVENANCE}
    return rows.select(*[c for c in rows.columns if c in used])


def dimension_upsert(
    who: Provider,
    table: str,
    path: str,
    master: DataFrame | None = None,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
    **options,
) -> Callable[[DataFrame, int], None]:
    """A batch handler that keeps a silver dimension up to date.

    The delta depends only on the rows and on the stored dimension, and it is empty
    for rows already applied, so a batch that is delivered twice changes nothing. Options go to
    ``version_delta``.
    """
    build = {"prod_dim": silver.prod_dim_delta, "site_dim": silver.site_dim_delta}[table]

    def handle(batch: DataFrame, batch_id: int) -> None:
        existing = load_table(batch.sparkSession, path)
        delta = build(batch, who, existing, master, clock(), **options)
        upsert_table(delta, path, TABLE_KEYS[table], ["data_provider_code"])

    return handle


def fact_upsert(
    lake: Lakehouse,
    who: Provider,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
    **options,
) -> Callable[[DataFrame, int], None]:
    """A batch handler that keeps a provider's dimensions, day, week and month facts up to date.

    Between batches there is no state but the stored tables: a batch reads its own rows, the versions of the
    dimensions, the last rows of its series and the sums of its groups. One that fails half-way is finished ahead of the
    next, and one that is delivered twice changes nothing. Options go to ``version_delta``.
    """
    deltas = {"prod_dim": silver.prod_dim_delta, "site_dim": silver.site_dim_delta}

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark, now = batch.sparkSession, clock()
        with scratch(spark):
            rows = written(batch)

            def refresh(name: str) -> None:
                delta = deltas[name](rows, who, lake.table("silver", name, who), None, now, lake.limits, **options)
                lake.store(delta, name, who)

            together(*[partial(refresh, name) for name in deltas])
            dims = [lake.table("silver", name, who) for name in deltas]
            lake.apply_days(who, silver.keyed_days(rows, who, *dims, lake.limits), now)
        lake.record_run(now, who)

    return handle
