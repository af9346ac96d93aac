"""Column-name cleaning and the staging type mapping of an arbitrary frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Staging type names by kind of column, in the order they are tested.
STAGING_TYPE_NAMES = ("BIGINT", "FLOAT", "BOOLEAN", "TEXT[]", "TEXT")


def clean_column_name(position: int, name: str) -> str:
    """``Unnamed*`` -> ``column_<position>``; otherwise strip, spaces -> '_', lower."""
    if name.startswith("Unnamed"):
        return f"column_{position}"
    return name.strip().replace(" ", "_").lower()


def clean_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_column_name(i, c) for i, c in enumerate(df.columns)])


def clean_schema_name(name: str) -> str:
    """Namespace names are trimmed, spaces -> '_', lower-cased."""
    return name.strip().replace(" ", "_").lower()


def staging_type(dt: T.DataType) -> tuple[str, T.DataType]:
    """(staging type name, Spark type) of a column type."""
    if isinstance(dt, T.IntegralType):
        return "BIGINT", T.LongType()
    if isinstance(dt, T.DecimalType):
        return "TEXT", T.StringType()  # exact digits; a double would merge different amounts
    if isinstance(dt, T.FractionalType):
        return "FLOAT", T.DoubleType()
    if isinstance(dt, T.BooleanType):
        return "BOOLEAN", T.BooleanType()
    if isinstance(dt, T.ArrayType):
        return "TEXT[]", T.ArrayType(T.StringType())
    return "TEXT", T.StringType()


def staging_types(df: DataFrame) -> DataFrame:
    """Cast every column to its staging type (integers -> bigint, reals -> double, ...)."""
    out = []
    for f in df.schema.fields:
        _, target = staging_type(f.dataType)
        c = F.col(f"`{f.name}`")
        out.append((c if f.dataType == target else c.cast(target)).alias(f.name))
    return df.select(*out)


def staging_type_report(df: DataFrame) -> list[tuple[int, str, str]]:
    """(position, column, staging type) for each column; ``id`` is the UUID key."""
    rows = [(0, "id", "UUID PRIMARY KEY")]
    for i, f in enumerate(df.schema.fields, start=1):
        if f.name != "id":
            rows.append((i, f.name, staging_type(f.dataType)[0]))
    return rows
