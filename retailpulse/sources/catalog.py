"""Catalog and cart documents landed as JSON files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailpulse.config import CatalogParams
from retailpulse.functions.labels import synthesized_stock
from retailpulse.operators.merge import REFRESH, merge_catalog
from retailpulse.operators.shape import fit_widths
from retailpulse.schemas import CART_DOCUMENT, PRODUCT_DOCUMENT


def product_documents(spark: SparkSession, path: str, array_per_file: bool = True) -> DataFrame:
    return spark.read.schema(PRODUCT_DOCUMENT).option("multiLine", array_per_file).json(path)


def cart_documents(spark: SparkSession, path: str, array_per_file: bool = True) -> DataFrame:
    return spark.read.schema(CART_DOCUMENT).option("multiLine", array_per_file).json(path)


def categories(documents: DataFrame) -> DataFrame:
    return documents.select("category").distinct()


def flatten_documents(documents: DataFrame) -> DataFrame:
    """Product documents as catalog columns; missing ratings count as 0."""
    return documents.select(
        F.col("id").alias("product_id"),
        F.col("title").alias("name"),
        "category",
        F.col("price").cast("decimal(10,2)").alias("price"),
        F.col("image").alias("image_url"),
        "description",
        F.coalesce("rating.rate", F.lit(0.0)).cast("decimal(3,2)").alias("rating_rate"),
        F.coalesce("rating.count", F.lit(0)).alias("rating_count"),
    )


def hydrate(
    documents: DataFrame, target: DataFrame | None = None, params: CatalogParams = CatalogParams()
) -> DataFrame:
    """Documents -> catalog rows with stock levels -> merged into ``target``."""
    rows = fit_widths(flatten_documents(documents))
    rows = rows.withColumns(synthesized_stock(F.col("rating_count"))).withColumn(
        "source", F.lit(params.source_name)
    )
    return rows if target is None else merge_catalog(target, rows, REFRESH)


class CatalogTable:
    """The catalog as whole versions: a refresh writes a new one beside the one it reads, and names it last.

    Two folders hold the last two versions in turn. One refresh at a time; a refresh that
    breaks off leaves the version before it, and may simply be made again. Who reads
    longer than until the refresh after next reads again.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def version(self) -> int:
        """Number of the newest whole version; 0 before the first."""
        try:
            names = self.spark.read.schema("version long").parquet(f"{self.root}/names")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0
        return names.agg(F.max("version")).first()[0] or 0

    def read(self) -> DataFrame | None:
        """The newest version; None before the first."""
        version = self.version()
        return self.spark.read.parquet(f"{self.root}/versions/{version % 2}") if version else None

    def replace(self, rows: DataFrame) -> int:
        """Make ``rows``, which may be computed from the present version, the next one; returns its number."""
        version = self.version() + 1
        self._overwrite(rows, "versions", version)
        self._overwrite(self.spark.range(1).select(F.lit(version).cast("long").alias("version")).coalesce(1), "names", version)
        return version

    def _overwrite(self, rows: DataFrame, kind: str, version: int) -> None:
        folder = f"{version % 2}" if kind == "versions" else f"slot={version % 2}"
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.root}/{kind}/{folder}")

    def refresh(self, documents: DataFrame, params: CatalogParams = CatalogParams()) -> int:
        """Merge product documents into the catalog by its refresh rules; the same documents again change nothing."""
        return self.replace(hydrate(documents, self.read(), params))
