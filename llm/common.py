"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.workspace import drop_path, fresh_dir

#: Characters that end a word: space, and tab to carriage return.
SPACE = "[\\x20\\x09-\\x0D]"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this code to the executors, once a session: their Python has no other way to it unless the job was
    submitted with it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="llm-code-")) / "llm_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for package in ("llm", "noticelake"):
            for source in sorted((root / package).rglob("*.py")):
                out.write(source, source.relative_to(root).as_posix())
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(name: str) -> Column:
    """A column by its exact name, whatever characters it has."""
    return F.col(f"`{name.replace('`', '``')}`")


def ids_and_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads; a null text is the empty text."""
    return docs.select(column(id_col).alias("doc_id"), F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"))


class Stored:
    """A table written to the shared folder and read again: its lineage ends at the files, so a lost
    executor costs no more than the tasks that read them."""

    def __init__(self, frame: DataFrame, name: str, by: tuple[str, ...] = ()):
        self.spark = frame.sparkSession
        self.path = fresh_dir(self.spark, name)
        writer = frame.write.mode("error")
        (writer.partitionBy(*by) if by else writer).parquet(self.path)
        self.frame = self.spark.read.parquet(self.path)

    def drop(self) -> None:
        """Only once nothing reads it any more."""
        drop_path(self.spark, self.path)


def stored(frame: DataFrame, name: str) -> DataFrame:
    return Stored(frame, name).frame


def tokenizer_file(name: str) -> str:
    """A path as given, or the place of a public tokenizer's file; called in the task."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def sliced(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``limit`` bytes each; a larger row stands alone."""
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def one_array(col: pa.Array | pa.ChunkedArray) -> pa.Array:
    return col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col


def texts_of(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """A text column, nulls as empty."""
    col = one_array(batch.column(name)).cast(pa.string())
    return col.fill_null("") if col.null_count else col


def sizes_of(texts: pa.Array) -> np.ndarray:
    """UTF-8 bytes of each text."""
    import pyarrow.compute as pc

    return pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)


def per_row(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``values``; a run may be empty."""
    ends = np.cumsum(lengths)
    sums = np.concatenate(([0], np.cumsum(values)))
    return sums[ends] - sums[ends - lengths]


def run_sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``per_row`` with each run summed by itself, so that equal runs have equal sums wherever they lie."""
    out = np.zeros(len(lengths), dtype=values.dtype)
    some = lengths > 0
    if some.any():
        out[some] = np.add.reduceat(values, (np.cumsum(lengths) - lengths)[some])
    return out


def gather_runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``starts[i] .. starts[i] + lengths[i] - 1`` of every i, one after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total, dtype=np.int64)


def passing(docs: DataFrame, function) -> DataFrame:
    """``mapInArrow`` that keeps the columns of ``docs``."""
    return docs.mapInArrow(function, docs.schema)
