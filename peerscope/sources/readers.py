"""Readers for the landed sources.

All readers declare their schema (no inference), read in parallel and keep
rows distributed; validation is a column predicate over every row.
"""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from peerscope.functions.columns import sentinel_to_null
from peerscope.sources.contracts import MUNICIPIO, PIX, SIDRA, TableContract
from peerscope.sources.publish import Folders


class InvalidSource(ValueError):
    """A landed file breaks its contract; nothing of the run is written."""


def read_csv_table(spark: SparkSession, path: str, contract: TableContract) -> DataFrame:
    """A1: a business CSV as text columns plus ``_valid`` and ``_source_file``.

    Columns are bound by the names in the header, whatever their order; a
    missing one is an error, further ones are left out.  The files of a folder
    share one header; another one among them is an error.  ``multiLine`` (needed
    where quoted fields hold newlines, e.g. review comments) makes a file
    unsplittable, so it is enabled per contract.
    """
    df = (spark.read.option("header", True).option("escape", '"').option("quote", '"')
          .option("multiLine", contract.multiline).option("mode", "PERMISSIVE").option("inferSchema", False)
          .option("enforceSchema", False).option("recursiveFileLookup", True).csv(path))
    names = contract.text_schema.fieldNames()
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise InvalidSource(f"{path}: no column {', '.join(missing)} in the header")
    df = df.select(*names, F.col("_metadata.file_path").alias("_source_file"))
    return df.withColumn("_valid", contract.validity()).select(*names, "_valid", "_source_file")


def typed_valid_rows(df: DataFrame, contract: TableContract) -> DataFrame:
    """Rows that satisfy the contract, with the contract types applied."""
    return contract.typed(df.filter(F.col("_valid")))


def sample_check(df: DataFrame, n: int = 1000) -> int:
    """M9: invalid rows among the first ``n`` (parity with sample validation)."""
    return df.limit(n).filter(~F.col("_valid")).count()


# ---------------------------------------------------------------- nested JSON
_ID_NAME = [StructField("id", LongType()), StructField("nome", StringType())]
MUNICIPIO_JSON = StructType([
    StructField("id", LongType()), StructField("nome", StringType()),
    StructField("regiao-imediata", StructType(_ID_NAME + [
        StructField("regiao-intermediaria", StructType(_ID_NAME + [
            StructField("UF", StructType(_ID_NAME + [
                StructField("sigla", StringType()),
                StructField("regiao", StructType(_ID_NAME + [StructField("sigla", StringType())])),
            ])),
        ])),
    ])),
    StructField("microrregiao", StructType(_ID_NAME + [
        StructField("mesorregiao", StructType(_ID_NAME)),
    ])),
])


def flatten_municipios(nested: DataFrame) -> DataFrame:
    """A2: nested municipality records -> 16 flat columns plus ``_valid``.

    Struct access on a NULL parent yields NULL (J14), so a missing optional
    branch gives NULL fields and a missing required branch fails validity.
    """
    ri = F.col("`regiao-imediata`")
    rint = ri.getField("regiao-intermediaria")
    uf = rint.getField("UF")
    macro = uf.getField("regiao")
    micro = F.col("microrregiao")
    meso = micro.getField("mesorregiao")
    flat = nested.select(
        F.col("id").alias("id_municipio"), F.col("nome").alias("nome_municipio"),
        ri.getField("id").alias("regiao_imediata_id"), ri.getField("nome").alias("regiao_imediata_nome"),
        rint.getField("id").alias("regiao_interm_id"), rint.getField("nome").alias("regiao_interm_nome"),
        uf.getField("id").alias("uf_id"), uf.getField("sigla").alias("uf_sigla"), uf.getField("nome").alias("uf_nome"),
        macro.getField("id").alias("macroregiao_id"), macro.getField("sigla").alias("macroregiao_sigla"),
        macro.getField("nome").alias("macroregiao_nome"),
        micro.getField("id").alias("microrregiao_id"), micro.getField("nome").alias("microrregiao_nome"),
        meso.getField("id").alias("mesorregiao_id"), meso.getField("nome").alias("mesorregiao_nome"),
        *[F.col(c) for c in nested.columns if c == BAD],
    )
    required = [F.col(c).isNotNull() for c in MUNICIPIO.required]
    valid = required[0]
    for r in required[1:]:
        valid = valid & r
    return flat.withColumn("_valid", valid)


BAD = "_bad_document"


def _documents(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Records of a JSON dump, one file or a folder of pages at any depth; ``BAD`` holds what does not parse."""
    full = StructType([*schema.fields, StructField(BAD, StringType())])
    return (spark.read.schema(full).option("multiLine", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", BAD).option("recursiveFileLookup", True).json(path))


def broken_document(path: str, text: str) -> InvalidSource:
    return InvalidSource(f"{path}: not a whole JSON document of the declared shape, from: {text[:80]!r}")


def _whole(rows: DataFrame, path: str) -> DataFrame:
    """The rows, if every document parsed: one that does not is an error, not an absence of rows."""
    broken = rows.filter(F.col(BAD).isNotNull()).limit(1).collect()
    if broken:
        raise broken_document(path, broken[0][BAD])
    return rows.drop(BAD)


def municipios_rows(spark: SparkSession, path: str) -> DataFrame:
    """A2: flat municipality records with ``_valid`` and ``BAD``, nothing checked yet."""
    return flatten_municipios(_documents(spark, path, MUNICIPIO_JSON))


def read_municipios_json(spark: SparkSession, path: str) -> DataFrame:
    """A2: the municipality API dump (a JSON array of nested records)."""
    return _whole(municipios_rows(spark, path), path)


def parse_sidra(raw: DataFrame) -> DataFrame:
    """A3: drop the header record, map sentinels to NULL, keep D5/D6 optional, check the rest (``_valid``).

    The header is recognised by value (its ``V`` is the literal column title
    and its municipality code is not numeric), not by position, because a
    distributed read has no first row.  Any other record whose code is missing
    or not a number is invalid.
    """
    coded = F.col("D1C").try_cast("long").isNotNull()
    body = raw.filter(~F.col("V").eqNullSafe("Valor") | coded)
    cols = []
    for name in SIDRA.schema.fieldNames():
        c = F.col(name) if name in raw.columns else F.lit(None).cast("string")
        cols.append((sentinel_to_null(c) if name == "V" else c).alias(name))
    cols += [F.col(c) for c in raw.columns if c == BAD]
    return body.select(*cols).withColumn("_valid", SIDRA.validity() & coded)


def sidra_rows(spark: SparkSession, path: str) -> DataFrame:
    """A3: census records with ``_valid`` and ``BAD``, nothing checked yet."""
    return parse_sidra(_documents(spark, path, SIDRA.text_schema))


def read_sidra_json(spark: SparkSession, path: str) -> DataFrame:
    """A3: a census table dump (JSON array, first element is the header)."""
    return _whole(sidra_rows(spark, path), path)


NO_ARRAY = "no array of records under 'value'"
PIX_JSON = StructType([StructField("value", ArrayType(StructType(PIX.text_schema.fields)))])


def pix_rows(spark: SparkSession, path: str) -> DataFrame:
    """A4: payment records with ``_valid``, ``_discarded`` and ``BAD``, nothing checked yet.

    Values are read as text and held against the contract (``_valid``) before
    they are typed, so a value that does not fit is an invalid row and not a
    NULL.  Codes delivered as floats (``4311759.0``) become integers.
    ``_discarded`` marks the records without municipality or state code.  A page
    without its ``value`` array is one row that only has ``BAD``.
    """
    doc = _documents(spark, path, PIX_JSON)
    said = F.coalesce(F.col(BAD), F.lit(NO_ARRAY))
    rows = doc.select(F.when(F.col(BAD).isNotNull() | F.col("value").isNull(), said).alias(BAD), F.explode_outer("value").alias("r"))
    rows = rows.filter(F.col(BAD).isNotNull() | F.col("r").isNotNull()).select(BAD, "r.*")  # an empty array has no rows
    lost = F.col(BAD).isNull() & (F.col("Municipio_Ibge").isNull() | F.col("Estado_Ibge").isNull())
    codes = ("Municipio_Ibge", "Estado_Ibge")
    return rows.withColumn("_valid", PIX.validity()).withColumn("_discarded", lost).select(
        *[F.col(n).try_cast(t).try_cast("long").alias(n) if n in codes else F.col(n).try_cast(t).alias(n)
          for n, t, _ in PIX.fields], "_valid", "_discarded", BAD)


def read_pix_json(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A4: OData payload -> rows; rows without municipality or state code drop.

    Returns ``(rows, discarded_count_frame)``.  Every page needs its ``value``
    array; one without (an error document) is an error, and so is an empty
    folder.
    """
    doc = _documents(spark, path, PIX_JSON)
    pages = doc.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("value").isNull()).alias("bad"), F.max(BAD).alias("text")).first()
    if pages["text"] is not None:
        raise broken_document(path, pages["text"])
    if not pages["n"] or pages["bad"]:
        raise InvalidSource(f"{path}: {pages['bad']} of {pages['n']} documents without an array of records under 'value'")
    rows = pix_rows(spark, path)
    kept = rows.filter(~F.col("_discarded")).drop("_discarded", BAD)
    return kept, rows.agg(F.count_if("_discarded").alias("descartados"))


# ------------------------------------------------------------ partitioned raw
def read_partitioned(spark: SparkSession, root: str, partition_col: str = "ingestion_date") -> DataFrame:
    """A5: a hive-partitioned Parquet folder; the partition column is a DATE."""
    df = spark.read.option("basePath", root).parquet(root)
    if partition_col in df.columns:
        df = df.withColumn(partition_col, F.col(partition_col).cast("date"))
    return df


@dataclass(frozen=True)
class SnapshotChoice:
    """The snapshot that a reader takes, and the newer ones it passes over, with the reason."""

    path: str
    value: str
    rows: int
    passed_over: tuple[tuple[str, str], ...] = ()


def snapshot_values(spark: SparkSession, root: str, partition_col: str = "ingestion_date") -> list[str]:
    """Partition values of a source, newest first, from the folder listing alone."""
    names = (p.rsplit("/", 1)[1] for p in Folders(spark).children(root))
    return sorted((n.split("=", 1)[1] for n in names if n.startswith(f"{partition_col}=")), reverse=True)


def _rows_by_footers(spark: SparkSession, path: str) -> int | str:
    """Rows of a snapshot; no column is read, so the counts come from the files' footers.  A text says why there are none."""
    try:
        return spark.read.parquet(path).count()
    except (PySparkException, Py4JJavaError) as e:  # a footer that is none is not converted to a Spark error
        return f"unreadable: {e.getCondition() if isinstance(e, PySparkException) else type(e).__name__}"


def choose_snapshot(spark: SparkSession, root: str, partition_col: str = "ingestion_date", min_rows: int = 1,
                    min_share: float = 0.0) -> SnapshotChoice | None:
    """The newest snapshot with ``min_rows`` rows and ``min_share`` of the rows of the one before it.

    Decided from the folder listing and footers: normally two snapshots'
    footers are looked at and no data.  An unreadable, empty or shrunken newest
    snapshot is passed over.  None: there is no valid snapshot.
    """
    values, passed = snapshot_values(spark, root, partition_col), []
    rows: dict[str, int | str] = {}

    def count(value: str) -> int | str:
        if value not in rows:
            rows[value] = _rows_by_footers(spark, f"{root.rstrip('/')}/{partition_col}={value}")
        return rows[value]

    for i, value in enumerate(values):
        n = count(value)
        older = next((m for v in values[i + 1:] if isinstance(m := count(v), int) and m >= min_rows), 0) if min_share else 0
        if isinstance(n, str):
            passed.append((value, n))
        elif n < min_rows or n < min_share * older:
            passed.append((value, f"{n} rows"))
        else:
            return SnapshotChoice(f"{root.rstrip('/')}/{partition_col}={value}", value, n, tuple(passed))
    return None


class SourceRegistry:
    """Logical source name -> raw folder, registered as temp views.

    ``min_share``: a newest snapshot with less than this share of the rows of
    the one before it counts as broken (T11).
    """

    def __init__(self, spark: SparkSession, raw_root: str, min_share: float = 0.0):
        self.spark = spark
        self.raw_root = raw_root.rstrip("/")
        self.min_share = min_share
        self.chosen: dict[str, SnapshotChoice] = {}

    def path(self, source: str) -> str:
        return f"{self.raw_root}/{source}"

    def read(self, source: str) -> DataFrame:
        return read_partitioned(self.spark, self.path(source))

    def read_snapshot(self, source: str, partition_col: str = "ingestion_date") -> DataFrame:
        """The newest valid snapshot alone; older ones are neither listed as files nor read."""
        choice = choose_snapshot(self.spark, self.path(source), partition_col, min_share=self.min_share)
        if choice is None:
            raise InvalidSource(f"{self.path(source)}: no readable snapshot with rows")
        self.chosen[source] = choice
        df = self.spark.read.option("basePath", self.path(source)).parquet(choice.path)
        return df.withColumn(partition_col, F.col(partition_col).cast("date"))

    def register(self, sources, snapshots=()) -> dict[str, DataFrame]:
        """Views ``raw_<source>``; of the sources among ``snapshots`` only the newest valid snapshot."""
        out = {}
        for s in sources:
            df = self.read_snapshot(s) if s in snapshots else self.read(s)
            df.createOrReplaceTempView(f"raw_{s}")
            out[s] = df
        return out


def read_mart(spark: SparkSession, table: str) -> DataFrame:
    """A finished mart, kept distributed."""
    return spark.table(table)


def read_jsonl(spark: SparkSession, path: str, schema: StructType, corrupt_col: str = "_bad") -> DataFrame:
    """Q5: JSON-lines fallback for variable-schema sources.

    Rows that do not fit the declared schema keep their raw text in
    ``corrupt_col`` instead of failing the read.
    """
    full = StructType(schema.fields + [StructField(corrupt_col, StringType(), True)])
    df = (spark.read.schema(full).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", corrupt_col).json(path))
    return df.withColumn("_valid", F.col(corrupt_col).isNull())


def read_jsonl_variant(spark: SparkSession, path: str) -> DataFrame:
    """Q5: JSON lines of any shape: ``record`` (a VARIANT, every field kept), ``_bad`` (the text of a line that is no object), ``_valid``.

    Blank lines are left out.  Fields that no schema names survive in
    ``record``; ``bind_fields`` types the ones a consumer knows.
    """
    lines = spark.read.text(path).filter(F.trim("value") != "").withColumn("record", F.try_parse_json("value"))
    ok = F.coalesce(F.schema_of_variant("record").startswith("OBJECT"), F.lit(False))
    return lines.select(F.when(ok, F.col("record")).alias("record"), F.when(~ok, F.col("value")).alias("_bad"), ok.alias("_valid"))


def bind_fields(df: DataFrame, schema: StructType, record: str = "record") -> DataFrame:
    """Declared fields of a VARIANT record as typed columns; a value that does not fit its type is NULL."""
    fields = [F.try_variant_get(F.col(record), f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in schema.fields]
    return df.select("*", *fields)


def observed_fields(df: DataFrame, record: str = "record") -> DataFrame:
    """(field, type, n): the top-level fields that records have and the types observed in each."""
    rows = df.select(F.col(record).alias("record"))
    fields = rows.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col("record").outer()))
    kind = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)  # precisions and nested shapes left aside
    return fields.groupBy(F.col("key").alias("field"), kind.alias("type")).agg(F.count(F.lit(1)).alias("n"))
