"""Full-refresh tables behind a gate (B2, M10, L2): a table is written aside, audited, and only then takes its place.

The tables of one build are published together, so consumers see the old build until the new one has passed as a whole.
The version that a table replaces stays readable below ``{warehouse}_previous``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.operators.quality import QualitySuite
from peerscope.sources.publish import StagedRun


def qualified_name(layer: str, model: str) -> str:
    """L2: layer -> schema naming."""
    return f"{layer}.{model}"


def with_comments(df: DataFrame, descriptions: Mapping[str, str] | None) -> DataFrame:
    """``df`` with the comments of the columns that ``descriptions`` name (Q4)."""
    texts = descriptions or {}
    return df.select(*[F.col(c).alias(c, metadata={"comment": texts[c]}) if c in texts else F.col(c) for c in df.columns])


class AuditedTables:
    """The tables of one build.  Use as a context; without ``publish`` the warehouse stays as it was.

    ``catalog``: published tables are also registered as external tables of their layer.
    """

    def __init__(self, spark: SparkSession, warehouse: str | None = None, catalog: bool = True) -> None:
        self.spark, self.catalog = spark, catalog
        self.warehouse = (warehouse or f"{spark.conf.get('spark.sql.warehouse.dir')}/peerscope").rstrip("/")
        self.schemas: dict[tuple[str, str], object] = {}
        self._run = StagedRun(spark, self.warehouse)

    def __enter__(self) -> "AuditedTables":
        self._run.__enter__()
        return self

    def __exit__(self, *error) -> None:
        self._run.__exit__(*error)

    def path(self, layer: str, model: str) -> str:
        return f"{self.warehouse}/{layer}/{model}"

    def previous(self, layer: str, model: str) -> DataFrame:
        """The version that the last publication replaced."""
        return self.spark.read.parquet(self._kept(layer, model))

    def _kept(self, layer: str, model: str) -> str:
        return f"{self.warehouse}_previous/{layer}/{model}"

    def write(self, df: DataFrame, layer: str, model: str, descriptions: Mapping[str, str] | None = None) -> DataFrame:
        """The candidate of a table, written aside; later models of the build read it, consumers do not."""
        described = with_comments(df, descriptions)
        aside = self._run.place(f"{layer}/{model}", self.path(layer, model), self._kept(layer, model))
        described.write.parquet(aside)
        self.schemas[layer, model] = described.schema
        return self.spark.read.schema(described.schema).parquet(aside)

    def audit(self, suite: QualitySuite) -> list[tuple[str, int]]:
        """The suite's warnings; a failed check is an error, after which nothing can be published."""
        try:
            return suite.enforce()
        except Exception:
            self._run.moves.clear()
            self.schemas.clear()
            raise

    def publish(self) -> dict[tuple[str, str], DataFrame]:
        """Every candidate takes its place; the published tables."""
        self._run.publish()
        return {(layer, model): self._published(layer, model, schema) for (layer, model), schema in self.schemas.items()}

    def _published(self, layer: str, model: str, schema) -> DataFrame:
        path = self.path(layer, model)
        if not self.catalog:
            return self.spark.read.schema(schema).parquet(path)
        register_table(self.spark, layer, model, path, schema)
        return self.spark.table(qualified_name(layer, model))


def register_table(spark: SparkSession, layer: str, model: str, path: str, schema) -> str:
    """An external table over ``path``; one that is there already with these columns only forgets its file listing."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    name = qualified_name(layer, model)
    if spark.catalog.tableExists(name):
        same = [(f.name, f.dataType, f.metadata.get("comment")) for f in schema.fields] == \
            [(f.name, f.dataType, f.metadata.get("comment")) for f in spark.table(name).schema.fields]
        place = spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").first()
        if same and place and place.data_type.rstrip("/").endswith(path.split(":", 1)[-1].rstrip("/").lstrip("/")):
            spark.catalog.refreshTable(name)
            return name
        spark.sql(f"DROP TABLE {name}")
    spark.catalog.createTable(name, path=path, source="parquet", schema=schema)
    return name
