"""Table schemas and schema-conforming column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EMPLOYEES = T.StructType([
    T.StructField("EmployeeID", T.LongType()),
    T.StructField("Name", T.StringType()),
    T.StructField("Age", T.IntegerType()),
    T.StructField("Role", T.StringType()),
    T.StructField("Domain_Expertise", T.StringType()),
    T.StructField("Availability", T.StringType()),
    T.StructField("Skills", T.StringType()),
    T.StructField("Cost_per_Hour", T.DoubleType()),
])


PROJECTS = T.StructType([
    T.StructField("ProjectID", T.LongType()),
    T.StructField("EmployeeID", T.LongType()),
    T.StructField("Project_Name", T.StringType()),
    T.StructField("Project_Description", T.StringType()),
    T.StructField("Tech_Stack_Used", T.StringType()),
    T.StructField("Domain", T.StringType()),
    T.StructField("Project_Role", T.StringType()),
    T.StructField("Project_Success_Score", T.DoubleType()),
    T.StructField("Individual_Performance_Score", T.DoubleType()),
])

HISTORY = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("operation", T.StringType()),
    T.StructField("operationMetrics", T.MapType(T.StringType(), T.StringType())),
])


def coerce_numeric(c: Column | str) -> Column:
    """Numeric text → double; anything unparseable or missing → 0.0."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.cast("string").try_cast("double"), F.lit(0.0))


def clip01(c: Column | str) -> Column:
    """Clamp to [0, 1]."""
    col = F.col(c) if isinstance(c, str) else c
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), col))


def with_default(df: DataFrame, name: str, value, dtype: T.DataType) -> DataFrame:
    """Add ``name`` with a constant default unless the frame already has it."""
    if name in df.columns:
        return df
    return df.withColumn(name, F.lit(value).cast(dtype))


def conform(df: DataFrame, schema: T.StructType, fill_missing: bool = True) -> DataFrame:
    """Select the target fields by name, cast to the target types.

    Fields missing from ``df`` become typed nulls when ``fill_missing``.
    """
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif fill_missing:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            raise ValueError(f"column {f.name!r} missing from source")
    return df.select(*cols)
