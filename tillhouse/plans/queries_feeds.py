"""Queries over feeds in awkward forms: arrays cut among tasks, files sent again, attributes of any kind."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillhouse.functions.columns import attribute, attribute_kinds, attributes_variant
from tillhouse.operators.conform import pack
from tillhouse.plans import standins as s
from tillhouse.plans.queries import _text, query
from tillhouse.session import work_dir, written
from tillhouse.sources import feeds, json_arrays
from tillhouse.streaming import ingest


@query
def json_array_split(spark, sf_dir):
    """Sales as one JSON array a month, with quotes, braces, escapes and line ends in values, read by many tasks a file."""
    sales, path = s.table(spark, sf_dir, "lineitem"), work_dir(spark)
    note = F.concat(F.lit('{"'), "l_returnflag", F.lit('"},\n[\\'), "l_linestatus", F.lit('\\"}'))
    texts = [F.col(c).cast("string").alias(c) for c in ("l_orderkey", "l_partkey", "l_suppkey")]
    place = F.struct("l_linenumber", F.struct("l_suppkey").alias("at")).alias("place")
    month = F.date_format("l_shipdate", "yyyy-MM").alias("month")
    json_arrays.write_json_arrays(sales.select(*texts, "l_linenumber", place, note.alias("note"), month), path, "month")
    found = feeds.read_feed(spark, f"{path}/*", "json", split_arrays=True)
    return found.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("place.at.l_suppkey").alias("placed_at"), "note")


@query
def stream_dedupe(spark, sf_dir):
    """Event files as a stream; half of them come again under other names, in later runs and with new rows among the old."""
    root, events = work_dir(spark), s.table(spark, sf_dir, "events")
    part = F.pmod(F.xxhash64("event_id"), F.lit(4))
    for rows in (events.filter(part < 2), events.filter(part > 0), events):
        rows.write.mode("append").parquet(f"{root}/landing")
        stream = ingest.stream_feed(spark, f"{root}/landing", "parquet", events.schema)
        fresh = ingest.without_resent(stream)
        ingest.append_stream(fresh, f"{root}/bronze", f"{root}/checkpoint").awaitTermination()
    return _text(spark.read.schema(events.schema).parquet(f"{root}/bronze"), "ts")


@query
def extra_attributes_variant(spark, sf_dir):
    """Attributes stored as VARIANT and taken out typed, beside their JSON text and the schema of all of them."""
    extras = ["product", "package_material", "is_bundle", "shelf_life_days"]
    rows = written(attributes_variant(s.products(spark, sf_dir).select("product_id", pack(extras))))
    return rows.select(
        "product_id",
        F.to_json("extra_attributes").alias("extra_attributes"),
        attribute("package_material", "string").alias("package_material"),
        attribute("shelf_life_days", "bigint").alias("shelf_life_days"),
        attribute("product", "bigint", tolerant=True).alias("no_number"),
        attribute("is_bundle", "string").alias("is_bundle"),
        attribute("absent", "string").alias("absent"),
        F.lit(attribute_kinds(rows).first()["attribute_schema"]).alias("attribute_schema"),  # one row
    )
