"""Ingest over landing folders written from the benchmark tables: streams, corrections, runs that fail."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType

from peerscope.operators.quality import Check, QualityGateError, QualitySuite
from peerscope.session import checkpoint_dir
from peerscope.sources.contracts import OLIST, TableContract
from peerscope.sources.ingest import InvalidSource, ingest_landing
from peerscope.sources.publish import Folders
from peerscope.sources.tables import AuditedTables
from peerscope.streaming.file_ingest import ingest_stream

CUSTOMER = TableContract("customer", (
    ("c_custkey", LongType(), True), ("c_name", StringType(), True), ("c_nationkey", IntegerType(), True),
    ("c_acctbal", DoubleType(), True), ("c_mktsegment", StringType(), True),
), file_name="part-*.csv")


def land_as_csv(df: DataFrame, landing: str) -> None:
    """Write a table as CSV files into a landing folder (distributed write)."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(landing)


def file_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1-K4 / A1 / B1: land ``customer`` as CSV, stream it into the raw layer,
    return what landed.  Work folders live under the shared checkpoint dir."""
    base = f"{checkpoint_dir(spark)}/ingest-{uuid.uuid4().hex}"
    land_as_csv(spark.read.parquet(f"{sf_dir.rstrip('/')}/customer.parquet"), f"{base}/landing")
    ingest_stream(spark, f"{base}/landing", CUSTOMER, f"{base}/raw", f"{base}/checkpoint",
                  quarantine_root=f"{base}/quarantine")
    raw = spark.read.parquet(f"{base}/raw/customer")
    return raw.select(*[F.col(n) for n, _, _ in CUSTOMER.fields])


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _land_run(df: DataFrame, landing: str, contract: TableContract) -> None:
    """One source of a landing folder, as a folder of CSV files."""
    df.select(*contract.text_schema.fieldNames()).write.mode("overwrite").option("header", True).option("escape", '"') \
        .csv(f"{landing}/{contract.file_name}")


def staged_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the raw layer holds after a good run, after one whose last table has no rows, and after its repetition.

    ``customer`` lands as two sources, later runs with another city; ``phase`` numbers the runs.
    """
    base, root = _folder(spark, "runs"), sf_dir.rstrip("/")
    customer, part = (spark.read.parquet(f"{root}/{t}.parquet") for t in ("customer", "part"))
    key = F.col("c_custkey").cast("string")

    def customers(city: str) -> DataFrame:
        return customer.select(key.alias("customer_id"), key.alias("customer_unique_id"), F.col("c_nationkey").cast("string").alias("customer_zip_code_prefix"),
                               F.lit(city).alias("customer_city"), F.col("c_mktsegment").alias("customer_state"))

    translation = part.select(F.col("p_type").alias("product_category_name"), F.lower("p_type").alias("product_category_name_english")).distinct()
    seen = []
    for phase, (city, words) in enumerate((("first", translation), ("second", translation.filter("false")), ("second", translation)), 1):
        _land_run(customers(city), f"{base}/landing", OLIST["customers"])
        _land_run(words, f"{base}/landing", OLIST["category_translation"])
        try:
            ingest_landing(spark, f"{base}/landing", f"{base}/raw", "2024-01-01")
        except InvalidSource:
            if phase != 2:
                raise
        raw = spark.read.parquet(f"{base}/raw/olist_customers").select(
            F.lit(phase).alias("phase"), F.col("customer_id").cast("long").alias("customer_id"), "customer_zip_code_prefix", "customer_city")
        raw.write.parquet(f"{base}/seen/phase={phase}")
        seen.append(spark.read.parquet(f"{base}/seen/phase={phase}"))
    return seen[0].union(seen[1]).union(seen[2])


def _upload(spark: SparkSession, df: DataFrame, base: str, names: str, files: int = 3) -> None:
    """Rows as ``files`` CSV files with fixed names in the landing folder, as an upload would leave them."""
    aside, folders = f"{base}/aside-{uuid.uuid4().hex}", Folders(spark)
    df.repartition(files).write.option("header", True).option("escape", '"').csv(aside)
    written = [f for f in folders.children(aside) if f.endswith(".csv")]
    for i, path in enumerate(written):
        target = f"{base}/landing/{names}-{i}.csv"
        if folders.exists(target):
            folders.delete(target)
        folders.move(path, target)


def stream_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1-K4: raw and quarantine rows of good, reordered, invalid and misnamed files, of which some are uploaded again.

    ``customer`` lands in files of four kinds, two files a micro-batch.  The invalid files are corrected under their old
    names, the good ones get new balances, and the last micro-batch is replayed as if the stream had died before its
    commit.
    """
    base, rows = _folder(spark, "corrections"), spark.read.parquet(f"{sf_dir.rstrip('/')}/customer.parquet")
    names = [n for n, _, _ in CUSTOMER.fields]
    kind = F.pmod(F.col("c_custkey"), F.lit(4))

    def of(n: int, *columns) -> DataFrame:
        return rows.filter(kind == n).select(*(columns or names))

    def run() -> None:
        ingest_stream(spark, f"{base}/landing", CUSTOMER, f"{base}/raw", f"{base}/checkpoint", f"{base}/quarantine", glob="*.csv", max_files=2)

    _upload(spark, of(0), base, "good")
    _upload(spark, of(1, *reversed(names), F.lit("x").alias("more")), base, "reordered")
    _upload(spark, of(2).withColumn("c_acctbal", F.lit("n/a")), base, "invalid")
    _upload(spark, of(3).withColumnRenamed("c_acctbal", "balance"), base, "misnamed")
    run()
    _upload(spark, of(0).withColumn("c_acctbal", F.col("c_acctbal") + 1), base, "good")
    _upload(spark, of(2), base, "invalid")
    run()
    folders = Folders(spark)
    folders.delete(max(folders.children(f"{base}/checkpoint/commits"), key=lambda c: int(c.rsplit("/", 1)[1])))
    run()
    raw = spark.read.parquet(f"{base}/raw/customer").select(F.lit("raw").alias("place"), "c_custkey", "c_acctbal", F.lit("").alias("reason"))
    aside = spark.read.parquet(f"{base}/quarantine/customer")
    key = F.coalesce(F.col("c_custkey"), F.split("_line", ",")[0]).try_cast("long")  # none: a header line
    reason = F.regexp_replace("_reason", "^[0-9]+ ", "")
    return raw.union(aside.select(F.lit("quarantine"), key.alias("k"), F.lit(None).cast("double"), reason).filter("k IS NOT NULL"))


def gated_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2 + M10: what two tables serve after a good build, after one whose second table fails its gate, and after the next.

    The tables are balances by customer and by nation; ``state`` also shows the version that the last build replaced.
    """
    warehouse, customer = f"{_folder(spark, 'gated')}/wh", spark.read.parquet(f"{sf_dir.rstrip('/')}/customer.parquet")
    balances = {"first": F.abs("c_acctbal"), "failed": F.abs("c_acctbal") + 1, "second": F.abs("c_acctbal") + 2}

    def states(tables: AuditedTables, state: str, read) -> DataFrame:
        one = read("staging", "by_customer").select(F.lit(state).alias("state"), F.lit("customer").alias("level"), F.col("c_custkey").alias("id"), "cents")
        return one.union(read("marts", "by_nation").select(F.lit(state), F.lit("nation"), "c_nationkey", "cents"))

    out = []
    for build, balance in balances.items():
        with AuditedTables(spark, warehouse, catalog=False) as tables:
            rows = tables.write(customer.select("c_custkey", "c_nationkey", F.round(balance * 100).cast("long").alias("cents")), "staging", "by_customer")
            sums = rows.groupBy("c_nationkey").agg(F.sum("cents").alias("cents"))
            sums = tables.write(sums.withColumn("cents", -F.col("cents")) if build == "failed" else sums, "marts", "by_nation")
            try:
                tables.audit(QualitySuite("by_nation", sums, [Check("positive", "expression", expression="cents >= 0")]))
                tables.publish()
            except QualityGateError:
                if build != "failed":
                    raise
        if build != "first":
            served = states(tables, f"after {build}", lambda layer, model: spark.read.parquet(tables.path(layer, model)))
            served.write.parquet(f"{warehouse}_seen/{build}")
            out.append(spark.read.parquet(f"{warehouse}_seen/{build}"))
    return out[0].union(out[1]).union(states(tables, "replaced", tables.previous))
