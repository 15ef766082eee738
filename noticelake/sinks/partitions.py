"""Replacing whole partitions of a Parquet table (K3)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from noticelake.workspace import child_names, drop_path, move_path

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def spread(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of a partition together, but a large partition over many tasks.

    A rebalance, not a repartition by value: AQE splits the partition that holds
    a third of the rows and joins the small ones.
    """
    return rows.hint("rebalance", *columns)


def replace_partitions(rows: DataFrame, path: str, columns: Sequence[str], staged: str | None = None) -> None:
    """Overwrite the partitions ``rows`` has, leave all others as they are.

    ``rows`` must not be read from ``path``. ``staged``: a folder beside ``path`` that holds just these rows by the one
    column; its partitions are moved in as they are, and no row is written again. That may be repeated after it
    was broken off: what has been moved is no longer staged.
    """
    if staged is not None:
        spark, (column,) = rows.sparkSession, columns
        for name in child_names(spark, staged):
            if name.startswith(f"{column}="):
                move_path(spark, f"{staged}/{name}", f"{path}/{name}")
        spark.catalog.refreshByPath(path)
        return
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def clear_partitions(spark: SparkSession, path: str, emptied: Iterable[Mapping[str, object]]) -> None:
    """Remove the folders of partitions that no longer have a row; those that are not there stay so.

    A dynamic overwrite does not touch a partition it has no row for.
    """
    for partition in emptied:
        folder = "/".join(f"{c}={NULL_PARTITION if x is None else x}" for c, x in partition.items())
        drop_path(spark, f"{path}/{folder}")
