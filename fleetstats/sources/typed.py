"""Delimited dumps with a type for each column, and the rows that do not fit kept aside."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType, VarcharType

from fleetstats.sources.catalogue import CSV_OPTIONS

BAD_COLUMNS, RAW = "bad_columns", "raw_row"


def merged_schema(table: StructType, overrides: Mapping[str, str]) -> StructType:
    """A table's schema with the types of some columns replaced, as an import asks for them.

    Raises ValueError for a column the table does not have; names are compared without regard to case.
    """
    names = {f.name.lower(): f.name for f in table}
    unknown = sorted(set(overrides) - {o for o in overrides if o.lower() in names})
    if unknown:
        raise ValueError(f"no such columns: {', '.join(unknown)}")
    wanted = {names[o.lower()]: DataType.fromDDL(kind) for o, kind in overrides.items()}
    return StructType([StructField(f.name, wanted.get(f.name, f.dataType), f.nullable) for f in table])


def read_text_columns(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A dump with all columns as texts, and in ``raw_row`` the lines that have too many columns or too few."""
    texts = StructType([*[StructField(f.name, StringType()) for f in schema], StructField(RAW, StringType())])
    # a pruned reader would not see how many columns a line has
    options = {**CSV_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW, "columnPruning": False}
    return spark.read.schema(texts).options(**options).csv(path)


def cast_columns(texts: DataFrame, schema: StructType) -> DataFrame:
    """Each column in its type, null where its text is none of that type, and ``bad_columns``, the names of those.

    A blank text is null, except in a column of texts; null is bad in a column that must have values. Nothing is lost: the texts of the bad columns are in ``raw_values``, by name.
    """
    typed, bad, raw = {}, [], []
    for f in schema:
        text = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (StringType, VarcharType)):
            value, wrong = text.cast(f.dataType), F.lit(False)
        else:
            given = F.nullif(F.trim(text), F.lit(""))
            value = given.try_cast(f.dataType)
            wrong = given.isNotNull() & value.isNull()
        if not f.nullable:
            wrong = wrong | value.isNull()
        typed[f.name] = value
        bad.append(F.when(wrong, F.lit(f.name)))
        raw.append(F.when(wrong, F.struct(F.lit(f.name).alias("name"), text.alias("text"))))
    return texts.select(
        *[c.alias(name) for name, c in typed.items()],
        F.array_compact(F.array(*bad)).cast("array<string>").alias(BAD_COLUMNS),
        F.map_from_entries(F.array_compact(F.array(*raw))).cast("map<string,string>").alias("raw_values"),
        *([F.col(RAW)] if RAW in texts.columns else []),
    )


def read_typed_dump(
    spark: SparkSession, path: str, table: StructType, overrides: Mapping[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """The rows of a delimited dump in their types, and the rows that do not fit with ``bad_columns``, ``raw_values`` and
    ``raw_row``.

    A row with a bad value, or with too many or too few columns, is a reject and in no other table. To write both, write
    the marked rows (``cast_columns``) once.
    """
    schema = merged_schema(table, overrides or {})
    marked = cast_columns(read_text_columns(spark, path, schema), schema)
    fits = (F.size(BAD_COLUMNS) == 0) & F.col(RAW).isNull()
    return marked.where(fits).select(*[f"`{f.name}`" for f in schema]), marked.where(~fits)
