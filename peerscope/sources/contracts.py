"""Declared contracts of the landed sources.

A contract is a ``StructType`` plus the required columns.  Raw text is read
with an all-string schema; ``validity`` turns the contract into one boolean
column (required fields present, typed fields parse) evaluated for *every*
row, and ``typed`` applies the safe casts.  No Python runs per row.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

S, L, D = StringType(), LongType(), DoubleType()


@dataclass(frozen=True)
class TableContract:
    name: str
    fields: tuple[tuple[str, object, bool], ...]  # (column, type, required)
    file_name: str | None = None                 # landed file name (dispatch key)
    min_rows: int = 0                            # ingest volume warning (M8)
    multiline: bool = False                      # CSV with quoted newlines
    renames: dict = field(default_factory=dict)  # staging renames (C1)
    source: str | None = None                    # folder in the raw layer; the name if None

    @property
    def raw_name(self) -> str:
        return self.source or self.name

    @property
    def schema(self) -> StructType:
        return StructType([StructField(n, t, not req) for n, t, req in self.fields])

    @property
    def text_schema(self) -> StructType:
        return StructType([StructField(n, S, True) for n, _, _ in self.fields])

    @property
    def required(self) -> list[str]:
        return [n for n, _, req in self.fields if req]

    def field_checks(self) -> dict[str, Column]:
        """Per-column validity of a text row: present if required, parses if typed."""
        out = {}
        for n, t, req in self.fields:
            c = F.col(n)
            ok = c.isNotNull() if req else F.lit(True)
            if t != S:
                ok = ok & (c.isNull() | c.try_cast(t).isNotNull())
            out[n] = ok
        return out

    def validity(self) -> Column:
        """One boolean: the row satisfies the whole contract."""
        return reduce(lambda a, b: a & b, self.field_checks().values())

    def typed(self, df: DataFrame) -> DataFrame:
        """Safe casts of the text columns to the contract types."""
        return df.select(*[
            (F.col(n).try_cast(t) if t != S else F.col(n)).alias(n) for n, t, _ in self.fields
        ])


def _c(name, fields, file_name=None, min_rows=0, multiline=False, renames=None):
    source = f"olist_{name}" if file_name else None
    return TableContract(name, tuple(fields), file_name, min_rows, multiline, renames or {}, source)


# ----------------------------------------------------------------------------
# The business tables (file name, columns, minimum volume).
# ----------------------------------------------------------------------------
OLIST = {
    "customers": _c("customers", [
        ("customer_id", S, True), ("customer_unique_id", S, True), ("customer_zip_code_prefix", L, True),
        ("customer_city", S, True), ("customer_state", S, True)],
        "olist_customers_dataset.csv", 99000),
    "orders": _c("orders", [
        ("order_id", S, True), ("customer_id", S, True), ("order_status", S, True),
        ("order_purchase_timestamp", S, True), ("order_approved_at", S, False),
        ("order_delivered_carrier_date", S, False), ("order_delivered_customer_date", S, False),
        ("order_estimated_delivery_date", S, True)],
        "olist_orders_dataset.csv", 99000),
    "order_items": _c("order_items", [
        ("order_id", S, True), ("order_item_id", L, True), ("product_id", S, True), ("seller_id", S, True),
        ("shipping_limit_date", S, True), ("price", D, True), ("freight_value", D, True)],
        "olist_order_items_dataset.csv", 112000),
    "order_payments": _c("order_payments", [
        ("order_id", S, True), ("payment_sequential", L, True), ("payment_type", S, True),
        ("payment_installments", L, True), ("payment_value", D, True)],
        "olist_order_payments_dataset.csv", 103000),
    "order_reviews": _c("order_reviews", [
        ("review_id", S, True), ("order_id", S, True), ("review_score", L, True),
        ("review_comment_title", S, False), ("review_comment_message", S, False),
        ("review_creation_date", S, True), ("review_answer_timestamp", S, True)],
        "olist_order_reviews_dataset.csv", 99000, multiline=True),
    "geolocation": _c("geolocation", [
        ("geolocation_zip_code_prefix", L, True), ("geolocation_lat", D, True), ("geolocation_lng", D, True),
        ("geolocation_city", S, True), ("geolocation_state", S, True)],
        "olist_geolocation_dataset.csv", 1000000),
    "products": _c("products", [
        ("product_id", S, True), ("product_category_name", S, False), ("product_name_lenght", D, False),
        ("product_description_lenght", D, False), ("product_photos_qty", D, False),
        ("product_weight_g", D, False), ("product_length_cm", D, False), ("product_height_cm", D, False),
        ("product_width_cm", D, False)],
        "olist_products_dataset.csv", 32000,
        renames={"product_name_lenght": "product_name_length",
                 "product_description_lenght": "product_description_length"}),
    "sellers": _c("sellers", [
        ("seller_id", S, True), ("seller_zip_code_prefix", L, True), ("seller_city", S, True),
        ("seller_state", S, True)],
        "olist_sellers_dataset.csv", 3000),
    "category_translation": _c("category_translation", [
        ("product_category_name", S, True), ("product_category_name_english", S, True)],
        "product_category_name_translation.csv", 70),
}

PIX = _c("bcb_pix", [
    ("AnoMes", L, True), ("Municipio_Ibge", D, True), ("Municipio", S, True), ("Estado_Ibge", D, True),
    ("Estado", S, True), ("Sigla_Regiao", S, True), ("Regiao", S, True),
    ("VL_PagadorPF", D, True), ("QT_PagadorPF", L, True), ("VL_PagadorPJ", D, True), ("QT_PagadorPJ", L, True),
    ("VL_RecebedorPF", D, True), ("QT_RecebedorPF", L, True), ("VL_RecebedorPJ", D, True),
    ("QT_RecebedorPJ", L, True), ("QT_PES_PagadorPF", L, True), ("QT_PES_PagadorPJ", L, True),
    ("QT_PES_RecebedorPF", L, True), ("QT_PES_RecebedorPJ", L, True)],
    min_rows=378000)

SIDRA = _c("sidra", [
    ("NC", S, True), ("NN", S, True), ("MC", S, True), ("MN", S, True), ("V", S, False),
    ("D1C", S, True), ("D1N", S, True), ("D2C", S, True), ("D2N", S, True), ("D3C", S, True), ("D3N", S, True),
    ("D4C", S, True), ("D4N", S, True), ("D5C", S, False), ("D5N", S, False), ("D6C", S, False),
    ("D6N", S, False)])

MUNICIPIO = _c("ibge_localidades", [
    ("id_municipio", L, True), ("nome_municipio", S, True),
    ("regiao_imediata_id", L, True), ("regiao_imediata_nome", S, True),
    ("regiao_interm_id", L, True), ("regiao_interm_nome", S, True),
    ("uf_id", L, True), ("uf_sigla", S, True), ("uf_nome", S, True),
    ("macroregiao_id", L, True), ("macroregiao_sigla", S, True), ("macroregiao_nome", S, True),
    ("microrregiao_id", L, False), ("microrregiao_nome", S, False),
    ("mesorregiao_id", L, False), ("mesorregiao_nome", S, False)],
    min_rows=5500)

# Census tables by SIDRA table number, with their minimum volume.
CENSUS_TABLES = {"9514": 11000, "10295": 11000, "9936": 5000}

# Raw layer registry (A7): logical source name -> raw folder under the root.
RAW_SOURCES = (
    "olist_customers", "olist_orders", "olist_order_items", "olist_order_payments", "olist_order_reviews",
    "olist_geolocation", "olist_products", "olist_sellers",
    "bcb_pix", "ibge_localidades", "ibge_censo_9514", "ibge_censo_10295", "ibge_censo_9936",
)
# Those of which staging takes the newest snapshot only.
SNAPSHOT_SOURCES = ("bcb_pix", "ibge_localidades", "ibge_censo_9514", "ibge_censo_10295", "ibge_censo_9936")
# ----------------------------------------------------------------------------


def contract_for_file(file_name: str) -> TableContract | None:
    """Dispatch a landed file name to its contract (K1); None if unknown (K2)."""
    for c in OLIST.values():
        if c.file_name == file_name:
            return c
    return None
