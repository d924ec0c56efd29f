"""The layered models themselves, run over raw tables drawn from the benchmark tables, and the JSON readers.

Every source is delivered twice, so each staging model has repeats to remove; snapshot sources also have an older
snapshot.  The later models run on the staging models' output, as in the layered build.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.plans import intermediate as I
from peerscope.plans import marts as M
from peerscope.plans import raw_tables as R
from peerscope.plans import staging as S
from peerscope.plans.benchmark_tables import tables, to_double
from peerscope.session import checkpoint_dir
from peerscope.sources import readers
from peerscope.sources.publish import Folders

TS = "timestamp_ntz"
MART_SINCE = "1996-01-01"
SHARES = 8  # shares of the orders that the order fact's lines are worked out in, at most
ROWS_A_SHARE = 2_000_000  # landed orders, items and payments of a share, while there are fewer shares


def _twice(t, text: str) -> DataFrame:
    df = R.landed(t, text)
    return df.unionByName(df)


def _snapshots(t, text: str, changed: str) -> DataFrame:
    """The newest snapshot delivered twice, and an older one in which a column had another value."""
    new = _twice(t, text).withColumn("ingestion_date", F.to_date(F.lit("2024-02-01")))
    old = R.landed(t, text).withColumn(changed, F.concat(F.lit("old "), F.col(changed).cast("string"))) \
        .withColumn("ingestion_date", F.to_date(F.lit("2024-01-01")))
    return new.unionByName(old)


STAGING = {
    "stg_order_items": lambda t: S.stg_olist_order_items(_twice(t, R.ORDER_ITEMS), TS),
    "stg_order_payments": lambda t: S.stg_olist_order_payments(_twice(t, R.ORDER_PAYMENTS)),
    "stg_order_reviews": lambda t: S.stg_olist_order_reviews(_twice(t, R.ORDER_REVIEWS), TS),
    "stg_geolocation": lambda t: S.stg_olist_geolocation(_twice(t, R.GEOLOCATION)),
    "stg_products": lambda t: S.stg_olist_products(_twice(t, R.PRODUCTS)),
    "stg_sellers": lambda t: S.stg_olist_sellers(_twice(t, R.SELLERS)),
    "stg_localidades": lambda t: S.stg_ibge_localidades(_snapshots(t, R.LOCALIDADES, "nome_municipio")),
    "stg_censo_9514": lambda t: S.stg_ibge_censo_9514(_snapshots(t, R.CENSO_9514, "D2N")),
    "stg_censo_10295": lambda t: S.stg_ibge_censo_10295(_snapshots(t, R.CENSO_10295, "D2N")),
    "stg_censo_9936": lambda t: S.stg_ibge_censo_9936(_snapshots(t, R.CENSO_9936, "D1C")),
    "stg_pix": lambda t: S.stg_bcb_pix(_snapshots(t, R.PIX, "Municipio")),
}


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, a write's shuffle files are deleted once it has ended, not when the driver next collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _written(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """``df`` written once, as the layered build does with its models, so that several readers do not derive it each for itself."""
    spark = df.sparkSession
    path = f"{folder}/{name}" if folder else _folder(spark, name)
    with _shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _customers(t) -> DataFrame:
    return S.stg_olist_customers(_twice(t, R.CUSTOMERS))


def _geo(t) -> DataFrame:
    return I.int_olist_geolocation(STAGING["stg_geolocation"](t))


def _reviews(t) -> DataFrame:
    return I.int_olist_order_reviews_agg(STAGING["stg_order_reviews"](t))


def _covariates(t) -> DataFrame:
    return I.int_ibge_censo_covariaveis(*(STAGING[f"stg_censo_{n}"](t) for n in ("9514", "10295", "9936")))


def _places(t) -> DataFrame:
    return I.int_ibge_municipios(STAGING["stg_localidades"](t), _covariates(t))


def _share(df: DataFrame, n: int, i: int) -> DataFrame:
    """The rows of the ``i``-th of ``n`` shares of the orders.

    All rows of an order fall to one share, and so do all rows of a fingerprint that begins with the order's id: up to its
    first separator, which an id may hold, they are the same.  Shares are compared as texts, which generated code does not
    hold, so all of them run the same compiled code.
    """
    if n == 1:
        return df
    head = F.substring_index(F.coalesce("order_id", F.lit("")), "|", 1)
    return df.filter(F.pmod(F.xxhash64(head), F.lit(n)).cast("string") == str(i))


def _all(df: DataFrame) -> DataFrame:
    return df


def _payments_agg(t, of: Callable[[DataFrame], DataFrame] = _all, folder: str | None = None) -> DataFrame:
    """Payments per order of the landed rows that ``of`` takes; the staged lines are written to ``folder``."""
    return I.int_olist_order_payments_agg(_written(S.stg_olist_order_payments(of(_twice(t, R.ORDER_PAYMENTS))).select(
        "order_id", "payment_type", "payment_installments", "payment_value"), "stg-order-payments", folder))


def _items_agg(t, products: DataFrame, of: Callable[[DataFrame], DataFrame] = _all, folder: str | None = None) -> DataFrame:
    """Items per order, likewise."""
    return I.int_olist_order_items_agg(_written(S.stg_olist_order_items(of(_twice(t, R.ORDER_ITEMS)), TS).select(
        "order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"), "stg-order-items", folder), products)


def _in_shares(spark: SparkSession, name: str, n: int, make: Callable[..., DataFrame]) -> DataFrame:
    """``make``'s rows of every share of the orders, worked out and written one share after the other.

    What a share has shuffled and staged is deleted before the next one begins, so of the lines the disk holds one share's.
    Every share reads the landed rows once more.
    """
    path = _folder(spark, name)
    for i in range(n):
        folder = _folder(spark, f"{name}-share")
        try:
            df = make(of=partial(_share, n=n, i=i), folder=folder)
            with _shuffles_dropped(spark):
                df.write.mode("append").parquet(path)
        finally:
            Folders(spark).delete(folder)
    return spark.read.schema(df.schema).parquet(path)


def _fact_orders(t) -> DataFrame:
    """The order fact over models that are written first, those of the orders and their lines in shares of the orders."""
    spark = t["orders"].sparkSession
    rows = sum(R.landed(t, text).count() for text in (R.ORDERS, R.ORDER_ITEMS, R.ORDER_PAYMENTS))
    n = max(1, min(SHARES, -(-rows // ROWS_A_SHARE)))
    reviews = _written(_reviews(t), "int-order-reviews-agg")
    geo, customers = _written(_geo(t), "int-geolocation"), _written(_customers(t), "stg-customers")
    products = _written(STAGING["stg_products"](t).select("product_id", "product_category_name"), "stg-products")
    payments = _in_shares(spark, "int-order-payments-agg", n, partial(_payments_agg, t))
    items = _in_shares(spark, "int-order-items-agg", n, partial(_items_agg, t, products))
    orders = _in_shares(spark, "stg-orders", n, lambda of, folder: S.stg_olist_orders(of(_twice(t, R.ORDERS)), TS).drop("row_hash"))
    return I.int_fact_orders(orders, customers, geo, payments, items, reviews)


def _mart(t) -> DataFrame:
    geo = _written(_geo(t), "int-geolocation")
    sellers = I.int_dim_sellers(STAGING["stg_sellers"](t), geo)
    fact = I.int_fact_orders(
        S.stg_olist_orders(_twice(t, R.ORDERS), TS), _customers(t), geo, _payments_agg(t),
        _items_agg(t, STAGING["stg_products"](t)), _reviews(t), order_keys=R.landed(t, R.ORDERS))
    return M.mart_olist(fact, geo, _places(t), sellers, since=MART_SINCE)


MODELS = {
    **STAGING,
    "int_geolocation": _geo,
    "int_order_reviews_agg": _reviews,
    "int_dim_customers": lambda t: I.int_dim_customers(_customers(t), _geo(t)),
    "int_dim_sellers": lambda t: I.int_dim_sellers(STAGING["stg_sellers"](t), _geo(t)),
    "int_dim_products": lambda t: I.int_dim_products(STAGING["stg_products"](t)),
    "int_censo_covariaveis": _covariates,
    "int_municipios": _places,
    "int_fact_orders": _fact_orders,
    "mart_orders": _mart,
}


def _run(model, spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_double(model(tables(spark, sf_dir)))


QUERIES = {name: partial(_run, model) for name, model in MODELS.items()}


# --------------------------------------------------------------- JSON readers
def _pages(documents: DataFrame, spark: SparkSession) -> str:
    """A landing folder with one file for each row's JSON document."""
    path = f"{checkpoint_dir(spark)}/pages-{uuid.uuid4().hex}"
    documents.write.option("maxRecordsPerFile", 1).text(path)
    return path


def odata_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: payment pages, one a place, with code columns as floats and some rows without a code."""
    rows = R.landed(tables(spark, sf_dir), R.PIX)
    code = F.when(F.col("AnoMes") % 7 != 0, F.col("Municipio_Ibge").cast("double"))
    record = F.struct(*[code.alias(c) if c == "Municipio_Ibge" else F.col(c).cast("double").alias(c) if c == "Estado_Ibge"
                        else F.col(c) for c in rows.columns])
    pages = rows.withColumn("place", F.col("Municipio_Ibge")).groupBy("place").agg(F.collect_list(record).alias("value"))
    path = _pages(pages.select(F.to_json(F.struct("value")).alias("text")), spark)
    return readers.read_pix_json(spark, path)[0]


def sidra_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: census pages, one a place: a header record, sentinels for missing values, optional fields absent."""
    rows = R.landed(tables(spark, sf_dir), R.CENSO_10295)
    value = F.coalesce("V", F.when(F.col("D1C") == "5", F.lit("...")).otherwise(F.lit("-")))
    record = F.struct(*[value.alias("V") if c == "V" else F.col(c) for c in rows.columns])
    header = F.struct(*[F.lit("Valor" if c == "V" else c).alias(c) for c in rows.columns])
    pages = rows.groupBy("D1C").agg(F.concat(F.array(header), F.collect_list(record)).alias("page"))
    return readers.read_sidra_json(spark, _pages(pages.select(F.to_json("page").alias("text")), spark))


def municipios_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: municipality pages of nested records, some without the optional branch."""
    rows = R.landed(tables(spark, sf_dir), R.LOCALIDADES)

    def named(identity: str, name: str, *more):
        return F.struct(F.col(identity).alias("id"), F.col(name).alias("nome"), *more)

    macro = named("macroregiao_id", "macroregiao_nome", F.col("macroregiao_sigla").alias("sigla")).alias("regiao")
    uf = named("uf_id", "uf_nome", F.col("uf_sigla").alias("sigla"), macro).alias("UF")
    middle = named("regiao_interm_id", "regiao_interm_nome", uf).alias("regiao-intermediaria")
    micro = named("microrregiao_id", "microrregiao_nome", named("mesorregiao_id", "mesorregiao_nome").alias("mesorregiao"))
    record = F.struct(F.col("id_municipio").alias("id"), F.col("nome_municipio").alias("nome"),
                      named("regiao_imediata_id", "regiao_imediata_nome", middle).alias("regiao-imediata"),
                      F.when(F.col("microrregiao_id").isNotNull(), micro).alias("microrregiao"))
    pages = rows.groupBy("uf_id").agg(F.collect_list(record).alias("page"))
    return readers.read_municipios_json(spark, _pages(pages.select(F.to_json("page").alias("text")), spark))


QUERIES |= {"odata_ingest": odata_ingest, "sidra_ingest": sidra_ingest, "municipios_ingest": municipios_ingest}
