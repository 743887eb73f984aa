"""Batch files: shop CSVs, layers, metrics."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.schema import METRICS_DDL, SHOP_TABLES


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a reader finds the folder; asks for its file list only."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def read_csv(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A headed CSV file under a given schema; blanks are NULL.

    The header is checked against the schema and no pass is spent on guessing
    types. One line is one row, so that a large file is read in many splits.
    """
    return (
        spark.read.schema(ddl)
        .options(header=True, nullValue="", escape='"', enforceSchema=False)
        .csv(path)
    )


# File names of the public order dataset.
SHOP_FILES = {
    "orders": "olist_orders_dataset.csv",
    "items": "olist_order_items_dataset.csv",
    "payments": "olist_order_payments_dataset.csv",
    "customers": "olist_customers_dataset.csv",
    "products": "olist_products_dataset.csv",
}


def read_shop(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The five shop tables of one folder."""
    return {
        name: read_csv(spark, f"{folder.rstrip('/')}/{file}", SHOP_TABLES[name])
        for name, file in SHOP_FILES.items()
    }


def in_file_order(rows: DataFrame, column: str = "_row") -> DataFrame:
    """Rows with their place in the files they are read from: file, start of the split, place in it.

    A task may read splits of several files, the largest first; its own row numbers
    tell apart rows of one split only.
    """
    return rows.withColumn(column, F.struct(
        "_metadata.file_path", "_metadata.file_block_start",
        F.monotonically_increasing_id().alias("place")))


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet layer; partition columns come from the folder names."""
    return spark.read.parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Metrics of all batches as text, under the union of both writers' fields."""
    return spark.read.schema(METRICS_DDL).json(path)
