"""The reference models re-aimed at the benchmark tables.

Mapping of the reference domain onto the benchmark star schema (our choice,
used consistently by the Spark queries and their SQL oracles):

  place (municipality)   -> nation, macro-region -> region
  customer / seller      -> customer / supplier (place = *_nationkey)
  order                  -> orders; status F / O / P -> delivered / shipped / canceled
  order item             -> lineitem (price = extendedprice, freight = extendedprice * tax)
  product category       -> part.p_type
  payment                -> lineitem; type by returnflag R / A / N ->
                            credit_card / boleto / voucher, instalments = linenumber
  approval / delivery    -> first / last ship date of the order (delivery only when F)
  estimated delivery     -> order date + 60 days
  review                 -> latest event per user (user_id = customer key),
                            score = 1 + event_id % 5, comment = event_type unless 'view'
  monthly payment panel  -> lineitem per supplier nation x ship month;
                            payer = linestatus O, receiver = F; person = returnflag N
  census covariates      -> customers per nation: population = count, mean income = mean
                            account balance, "median" income = mean positive balance,
                            internet share = share of customers with balance > 0

Money is carried as ``decimal`` so that sums do not depend on row order; it is
turned into double only in the final projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from peerscope.functions.columns import is_present, to_money
from peerscope.operators.dedup import latest_per_key
from peerscope.operators.joins import skew_join
from peerscope.plans import intermediate as I
from peerscope.plans.marts import KPI_COLUMNS, order_kpis

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed values of the mapping above.
STATUS_BY_CODE = {"F": "delivered", "O": "shipped", "P": "canceled"}
PAYMENT_BY_FLAG = {"R": "credit_card", "A": "boleto", "N": "voucher"}
ESTIMATE_DAYS = 60
KPI_SINCE = "1996-01-01"
PROFILE_YEAR = 1998


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One benchmark table; only the columns a query uses are read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def to_double(df: DataFrame) -> DataFrame:
    """Final projection: exact decimals become double (one SQL projection)."""
    return df.selectExpr(*[
        f"CAST(`{f.name}` AS DOUBLE) AS `{f.name}`" if isinstance(f.dataType, DecimalType) else f"`{f.name}`"
        for f in df.schema.fields
    ])


def _case(col: str, mapping: dict[str, str]) -> Column:
    """``CASE col WHEN k THEN v ... END`` (NULL for anything unmapped)."""
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return F.expr(f"CASE `{col}` {whens} END")


# ------------------------------------------------------------------ adapters
def items(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        to_money("l_extendedprice").alias("price"),
        to_money(F.col("l_extendedprice") * F.col("l_tax"), 4).alias("freight_value"),
        F.col("l_shipdate"),
        _case("l_returnflag", PAYMENT_BY_FLAG).alias("payment_type"),
    )


def payments(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        _case("l_returnflag", PAYMENT_BY_FLAG).alias("payment_type"),
        F.col("l_linenumber").alias("payment_installments"),
        to_money("l_extendedprice").alias("payment_value"),
    )


def products(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_partkey").alias("product_id"), F.col("p_type").alias("product_category_name"))


def reviews(events: DataFrame) -> DataFrame:
    """Latest event per user as its review (G2 + C7)."""
    ev = events.select(
        F.col("user_id").alias("customer_id"), "event_id", "ts",
        (F.lit(1) + F.col("event_id") % 5).cast("int").alias("review_score"),
        F.when(F.col("event_type") != F.lit("view"), F.col("event_type")).alias("review_comment_message"),
    )
    latest = latest_per_key(ev, ["customer_id"], "ts", ["event_id"])
    return latest.select("customer_id", "review_score", is_present("review_comment_message").alias("has_comment"))


def fact_orders(t: dict[str, DataFrame]) -> DataFrame:
    """One row per order (E4 star join over pre-aggregated children, J6, C6)."""
    # Items and payments both come from the order lines: the additive item
    # measures and the payment pivot share one aggregation of lineitem per
    # order; distinct counts and the dominant category are their own narrow
    # aggregations (Catalyst drops any branch a consumer does not read).
    li = items(t["lineitem"])
    lines_agg = I.int_olist_order_items_agg(
        li, products(t["part"]),
        extra=[F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"),
               *I.payment_pivot_columns(I.PAYMENT_TYPES, "payment_type", "price", "order_item_id",
                                        closed_domain=True)],
    )
    cust = t["customer"].select(F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("place_id"))
    rev = reviews(t["events"])
    o = t["orders"].select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        _case("o_orderstatus", STATUS_BY_CODE).alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
    )
    # Customer and review are both one row per customer and are joined first;
    # the orders meet them once, and a customer with many orders is divided.
    # Then comes the one join keyed by order (the line aggregate is already
    # partitioned by it).
    j = (skew_join(o, cust.join(rev, "customer_id", "left"), "customer_id", "order_id")
         .join(lines_agg, "order_id", "left"))
    purchase = F.col("order_purchase_timestamp")
    estimated = purchase + F.expr(f"INTERVAL {ESTIMATE_DAYS} DAYS")
    delivered_at = F.when(F.col("order_status") == F.lit("delivered"), F.col("last_ship"))
    return j.select(
        "order_id", "customer_id", F.col("customer_id").alias("customer_unique_id"), "place_id", "order_status",
        "order_purchase_timestamp",
        F.col("first_ship").alias("order_approved_at"),
        delivered_at.alias("order_delivered_customer_date"),
        estimated.alias("order_estimated_delivery_date"),
        *I.delivery_measures(purchase, F.col("first_ship"), estimated, delivered_at),
        "total_payment_value", "credit_card_value", "credit_card_installments", "boleto_value",
        "voucher_value", "payment_types_count",
        "items_count", "unique_products_count", "unique_sellers_count", "total_price",
        "total_freight_value", "total_revenue", "dominant_category_name",
        "review_score", "has_comment",
    )


def place_dim(t: dict[str, DataFrame]) -> DataFrame:
    n = t["nation"].select(F.col("n_nationkey").alias("place_id"), F.col("n_name").alias("place_name"),
                           F.col("n_regionkey").alias("r_regionkey"))
    r = t["region"].select("r_regionkey", F.col("r_name").alias("region_name"))
    return n.join(r, "r_regionkey", "left").drop("r_regionkey")


class Tables(dict):
    """Benchmark tables opened on first use (a query only lists the files it reads)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        df = read(self.spark, self.sf_dir, name)
        self[name] = df
        return df


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return Tables(spark, sf_dir)


# ------------------------------------------------------------------- queries
def place_year_mart(t: dict[str, DataFrame], since: str = KPI_SINCE, until: str | None = None) -> DataFrame:
    """Order indicators per place x year in the shape of the yearly mart (P25).

    ``since`` / ``until`` bound the purchase timestamp as a range, which
    Spark pushes into the Parquet scan (a filter on ``year(ts)`` would not).
    """
    facts = fact_orders(t)
    ts = F.col("order_purchase_timestamp")
    ts_type = facts.schema["order_purchase_timestamp"].dataType
    cond = ts >= F.lit(since).cast(ts_type)
    if until is not None:
        cond = cond & (ts < F.lit(until).cast(ts_type))
    facts = facts.filter(cond).withColumn("year", F.year("order_purchase_timestamp"))
    agg = order_kpis(facts, ["place_id", "year"])
    sellers = t["supplier"].groupBy(F.col("s_nationkey").alias("place_id")).agg(
        F.count("s_suppkey").alias("vendedores_no_municipio"))
    return agg.join(place_dim(t), "place_id", "left").join(sellers, "place_id", "left")


def kpi_by_place_year(spark: SparkSession, sf_dir: str, since: str = KPI_SINCE) -> DataFrame:
    """Flagship: order indicators per place x year (P25 on the benchmark tables)."""
    out = place_year_mart(tables(spark, sf_dir), since)
    return to_double(out.select("place_id", "place_name", "region_name", "year", *KPI_COLUMNS))


def place_profile_frame(t: dict[str, DataFrame], year: int = PROFILE_YEAR) -> DataFrame:
    """One profile row per place (P27): yearly orders + whole-period payments."""
    from peerscope.plans.families import municipios, pix_raw
    from peerscope.plans.marts import mart_geo_analytics, mart_ibge_pix

    since = max(KPI_SINCE, f"{year:04d}-01-01")
    olist = place_year_mart(t, since, f"{year + 1:04d}-01-01").select(
        F.col("place_id").alias("id_municipio"), F.col("place_name").alias("nome_municipio"),
        F.col("region_name").alias("uf_sigla"), F.col("region_name").alias("macroregiao_nome"),
        F.col("year").alias("ano"), *KPI_COLUMNS)
    pix = mart_ibge_pix(I.int_bcb_pix_municipio(pix_raw(t)), municipios(t))
    return mart_geo_analytics(olist, pix, year=year)


def place_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P27 on the benchmark tables."""
    return to_double(place_profile_frame(tables(spark, sf_dir)))


def fact_orders_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P24 on the benchmark tables."""
    return to_double(fact_orders(tables(spark, sf_dir)))
