"""Projection onto another record type by field name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def project_like(df: DataFrame, target: T.StructType) -> DataFrame:
    """Columns of ``target`` in its order: a column of ``df`` with the same
    name and type is copied, every other target field is a typed NULL.
    Source columns the target does not have are left out."""
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = [F.col(f.name) if have.get(f.name) == f.dataType
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target.fields]
    return df.select(*cols)
