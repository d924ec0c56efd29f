"""Snapshots, raw registry, variable JSON lines, paths, cutoffs and catalog descriptions over the benchmark tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType, StringType, StructField, StructType

from peerscope.functions.columns import file_name, parent_prefix, relative_cutoff, utc_today
from peerscope.operators.matching import FEATURES, result_table, unavailable_targets
from peerscope.operators.quality import undocumented_columns
from peerscope.plans.benchmark_tables import place_profile_frame, read, tables, to_double
from peerscope.plans.descriptions import DESCRIPTIONS
from peerscope.plans.matching_queries import KEEP, _match
from peerscope.session import checkpoint_dir
from peerscope.sources.publish import StagedRun
from peerscope.sources.readers import SourceRegistry, bind_fields, observed_fields, read_jsonl_variant, read_mart
from peerscope.sources.sinks import write_raw_partition
from peerscope.sources.tables import AuditedTables, qualified_name


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def snapshot_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of four snapshots of the customers the newest two are broken (one shrunken, one without a row); the second is read."""
    raw, customer = _folder(spark, "snapshots"), read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    snapshots = {"2024-01-01": customer.withColumn("version", F.lit("old")), "2024-02-01": customer.withColumn("version", F.lit("good")),
                 "2024-03-01": customer.filter("c_custkey % 100 = 0").withColumn("version", F.lit("shrunken")),
                 "2024-04-01": customer.filter("false").withColumn("version", F.lit("empty"))}
    with StagedRun(spark, raw) as run:
        for date, rows in snapshots.items():
            run.write_partition(rows, "customers", date)
        run.publish()
    registry = SourceRegistry(spark, raw, min_share=0.5)
    out = registry.read_snapshot("customers")
    passed = ",".join(value for value, _ in registry.chosen["customers"].passed_over)
    return out.withColumn("passed_over", F.lit(passed))


def raw_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources landed on two days, read as views by their logical names."""
    raw = _folder(spark, "registry")
    customer, orders = read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders")
    write_raw_partition(customer.filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("id")), raw, "customers", "2024-01-01")
    write_raw_partition(customer.select(F.col("c_custkey").alias("id")), raw, "customers", "2024-02-01")
    write_raw_partition(orders.select(F.col("o_orderkey").alias("id")), raw, "orders", "2024-02-01")
    sources = ("customers", "orders")
    SourceRegistry(spark, raw).register(sources)
    parts = [f"SELECT '{qualified_name('staging', f'stg_{s}')}' AS model, ingestion_date, id FROM raw_{s}" for s in sources]
    return spark.sql(f"SELECT model, ingestion_date, count(*) AS n, sum(id) AS ids FROM ({' UNION ALL '.join(parts)}) GROUP BY model, ingestion_date")


KNOWN_FIELDS = StructType([StructField("id", LongType()), StructField("k", LongType()), StructField("code", StringType()),
                           StructField("amount", DecimalType(18, 2))])
_TEXT = """CASE WHEN event_id % 13 = 0 THEN concat('{"id": ', event_id, ', "k": ')
     WHEN event_id % 17 = 0 THEN '[1, 2]'
     ELSE concat('{"id": ', event_id, ', "k": ', CASE WHEN event_id % 7 = 0 THEN '"many"' ELSE cast(event_id % 5 AS STRING) END,
                 CASE event_type WHEN 'error' THEN concat(', "code": "e', event_id % 9, '"') WHEN 'purchase' THEN concat(', "amount": ', event_id % 100, '.25')
                                 WHEN 'signup' THEN concat(', "more": {"user": ', user_id, '}') ELSE '' END, '}') END"""


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON lines: fields differ by type of event, some values have another type, some lines are broken."""
    path = _folder(spark, "lines")
    read(spark, sf_dir, "events").select(F.expr(_TEXT).alias("value")).write.text(path)
    return read_jsonl_variant(spark, path)


def jsonl_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5: declared fields typed, a field that no schema names still there, broken lines kept as text."""
    bound = bind_fields(_lines(spark, sf_dir), KNOWN_FIELDS)
    more = F.try_variant_get("record", "$.more.user", "long")
    return bound.select("_valid", "id", "k", "code", F.col("amount").cast("double").alias("amount"), more.alias("more_user"), "_bad")


def jsonl_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5: the fields observed in the records, with the types of their values."""
    return observed_fields(_lines(spark, sf_dir).filter("_valid"))


def page_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last component and parent of every page's url."""
    return read(spark, sf_dir, "pages").select("page_id", file_name("url").alias("name"), parent_prefix("url").alias("parent"))


def recent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by day of the ten days before the newest event; all of them lie before today."""
    ev = read(spark, sf_dir, "events")
    newest = ev.select(F.max("ts")).scalar()
    recent = ev.filter(F.col("ts") >= relative_cutoff(10, newest)).withColumn("day", F.to_date("ts"))
    return recent.groupBy("day").agg(F.count(F.lit(1)).alias("events"), F.bool_and(F.col("day") < utc_today()).alias("before_today"))


def match_unavailable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested places that cannot be matched: without a complete profile, or unknown."""
    nations = read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("id_municipio"))
    requested = nations.union(nations.select(F.col("id_municipio") + 20)).distinct()
    profiles = to_double(place_profile_frame(tables(spark, sf_dir)))
    return unavailable_targets(requested, profiles.withColumn("id_municipio", F.col("id_municipio").cast("long")), "id_municipio", FEATURES)


def match_result_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table a user sees: rank, place, label, distance and ratio of each match."""
    res, _ = _match(spark, sf_dir, FEATURES)
    return result_table(res, "id_municipio", *KEEP)


def described_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart published with column comments and read by its name; the columns without one are listed."""
    customer = read(spark, sf_dir, "customer")
    mart = customer.groupBy(F.col("c_nationkey").alias("id_municipio")).agg(
        F.count(F.lit(1)).alias("clientes_unicos"), F.max("c_custkey").alias("newest_customer"))
    layer = "described_marts"
    with AuditedTables(spark, _folder(spark, "described")) as t:
        t.write(mart, layer, "customers", DESCRIPTIONS)
        t.publish()
    name = qualified_name(layer, "customers")
    return read_mart(spark, name).withColumn("undocumented", F.lit(",".join(undocumented_columns(spark, name))))


QUERIES = {f.__name__: f for f in (snapshot_choice, raw_registry, jsonl_records, jsonl_fields, page_paths, recent_events,
                                   match_unavailable, match_result_table, described_mart)}
