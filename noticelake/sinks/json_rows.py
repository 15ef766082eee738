"""Rows as JSON (K6): ISO moments, nulls kept, accents kept, no storage id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "dateFormat": "yyyy-MM-dd",
    "ignoreNullFields": "false",
}


def as_json(df: DataFrame, name: str = "documento") -> DataFrame:
    """One JSON text per row."""
    return df.select(F.to_json(F.struct(*[c for c in df.columns if c != "_id"]), OPTIONS).alias(name))


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, written by the executors."""
    df.drop("_id").write.mode("errorifexists").options(**OPTIONS).json(path)
