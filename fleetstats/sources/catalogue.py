"""Catalogue tables: database reads, delimited files, columnar files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Fixed values of the dump format: comma, optional double quotes, backslash escape.
CSV_OPTIONS = {
    "sep": ",", "quote": '"', "escape": "\\",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def jdbc_options(
    url: str,
    table: str,
    split: str | None = None,
    lower=None,
    upper=None,
    parts: int = 1,
    fetch: int = 10_000,
    text_columns: tuple[str, ...] = (),
    properties: dict[str, str] | None = None,
) -> dict[str, str]:
    """Reader options of a parallel import.

    ``table`` may also be a query in brackets with a name, so that a day's extract is filtered
    by the database.
    ``parts`` readers share the range of the ``split`` column; rows outside the bounds still
    come with the first and last part. ``text_columns`` are read as text whatever the database
    calls them (large objects).
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch), **(properties or {})}
    if parts > 1:
        if split is None or lower is None or upper is None:
            raise ValueError("a parallel import needs split, lower and upper")
        options |= {
            "partitionColumn": split,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(parts),
        }
    if text_columns:
        options["customSchema"] = ", ".join(f"{c} STRING" for c in text_columns)
    return options


def jdbc_table(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kwargs)).load()


def read_csv_dump(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)


def write_csv_dump(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_OPTIONS, compression="gzip").csv(path)


def read_dump(spark: SparkSession, path: str, fmt: str = "avro") -> DataFrame:
    """Binary dumps; Avro needs the external Spark package, Parquet and ORC do not."""
    return spark.read.format(fmt).load(path)
