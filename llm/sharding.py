"""Shards along a Hilbert curve over metadata.

Each dimension is quantised into cells of about equal weight: numbers by ``approx_percentile``, texts by the
share of rows that sort before them (distinct values are counted, range-sorted whole, and their counts summed up range
by range). The cells give an index on the Hilbert curve, and rows are range-sorted by that index. Runs of the sorted rows are the shards: neighbours on the curve are alike in all dimensions
at once, so each file covers a small box and a filter on any dimension skips most files.

The law is ``rows``: shard sizes differ by one row at most. Rows with equal texts are a group: they take
the dimensions of the group's smallest values and lie side by side, so a group is cut only where a shard ends.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import Stored, column

SALTS = 16


def hilbert_index(cells: list[np.ndarray], bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with coordinates below ``2 ** bits`` (Skilling's transform)."""
    x = [np.array(c, dtype=np.int64) for c in cells]
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        p = q - 1
        for i in range(len(x)):
            on = (x[i] & q) != 0
            t = np.where(on, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(on, x[0] ^ p, x[0]) ^ t
            if i:
                x[i] ^= t
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = top
    while q > 1:
        t = np.where((x[-1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for c in x:
            index = (index << 1) | (((c ^ t) >> b) & 1)
    return index


def as_number(frame: DataFrame, name: str) -> Column:
    """A dimension that is no text as a number in the same order; null below everything."""
    kind, value = frame.schema[name].dataType.simpleString(), column(name)
    number = F.unix_timestamp(value.cast("timestamp")).cast("double") if kind in ("date", "timestamp") else value.cast("double")
    return F.coalesce(number, F.lit(float("-inf")))


def text_cells(frame: DataFrame, name: str, parts: int) -> DataFrame:
    """``key`` (MD5 of the value, empty for null) and ``cell`` of each distinct text: where the middle of its rows
    lies among all rows in order of the text, null first, in ``parts`` equal parts."""
    value = column(name)
    counted = frame.groupBy(F.coalesce(F.md5(value), F.lit("")).alias("key")).agg(F.first(value).alias("value"), F.count("*").alias("n"))
    ranged = counted.repartitionByRange("value", "key").sortWithinPartitions("value", "key").select("key", "n")

    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column("n").to_numpy()
            upto = seen + np.cumsum(n)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(upto - n / 2), batch.column("n"), pa.array(np.full(len(n), part, dtype=np.int64))], ["key", "middle", "n", "part"])
            seen = int(upto[-1]) if len(n) else seen

    summed = Stored(ranged.mapInArrow(add_up, "key string, middle double, n long, part long"), "sharding-values").frame
    # One row a range.
    sums = sorted((r["part"], r["n"]) for r in summed.groupBy("part").agg(F.sum("n").alias("n")).collect())
    begin, total = {}, 0
    for part, n in sums:
        begin[part] = total
        total += n

    def cell(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before = np.array([begin[x] for x in batch.column("part").to_pylist()], dtype=np.float64)
            cells_ = np.floor((before + batch.column("middle").to_numpy()) * parts / max(1, total))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(np.clip(cells_, 0, parts - 1))], ["key", "cell"])

    return summed.mapInArrow(cell, "key string, cell double")


def cells(frame: DataFrame, names: list[str], bits: int) -> list[Column]:
    """Cell of each numeric dimension, by cuts of equal weight over all rows; one row of cuts comes to the driver."""
    parts = 1 << bits
    share = ",".join(str(i / parts) for i in range(1, parts))
    row = frame.agg(*[F.expr(f"approx_percentile(`{n}`, array({share}), 1000)").alias(n) for n in names]).first()
    out = []
    for n in names:
        number, cell = F.col(n), F.lit(0)
        for cut in sorted(set(row[n] or [])):
            cell = cell + (number > cut).cast("int")
        out.append(cell.cast("int"))
    return out


def shard(docs: DataFrame, dimensions: tuple[str, ...] = ("lang", "source"), shards: int = 8, bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard and curve.

    The text's size is a dimension besides ``dimensions``; values of a text dimension count whole. Null texts have size 1 and the checksum of
    the empty text; null dimensions come first; repeated rows take a slot each; an empty table gives no
    rows. Texts are not shuffled."""
    text = column(text_col).cast("string")
    names = [f"d{i}" for i in range(len(dimensions))]
    texts = [docs.schema[c].dataType.simpleString() == "string" for c in dimensions]
    # A text stands as the key of its value here, and as its cell from the next table on.
    own = [(F.coalesce(F.md5(column(c)), F.lit("")) if is_text else as_number(docs, c)).alias(n) for c, n, is_text in zip(dimensions, names, texts, strict=True)]
    meta = docs.select(
        column(id_col).alias("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("bytes"), F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"), F.xxhash64(text).alias("hash"), *own
    )
    meta = Stored(meta, "sharding-meta").frame
    for c, n, is_text in zip(dimensions, names, texts, strict=True):
        if is_text:
            # One value may stand in a third of all rows: they are dealt over SALTS tasks, and its one cell goes to each.
            values = text_cells(docs, c, 1 << bits).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumnRenamed("key", n)
            meta = meta.withColumn("salt", F.pmod(F.xxhash64("doc_id", "hash"), F.lit(SALTS)).cast("int")).join(values, [n, "salt"])
            meta = meta.withColumn(n, F.col("cell")).select("doc_id", "bytes", "text_crc32", "hash", *names)
    if any(texts):
        meta = Stored(meta, "sharding-cells").frame
    group = ["hash", "text_crc32", "bytes"]
    least = meta.groupBy(*group).agg(F.count("*").alias("copies"), *[F.min(n).alias(f"g_{n}") for n in names])
    # A group may hold a third of all rows: its rows are dealt over SALTS tasks, and its one row goes to each.
    several = least.where("copies > 1").drop("copies").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = meta.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    joined = salted.join(several, [*group, "salt"], "left").select("doc_id", *group, *[F.coalesce(f"g_{n}", n).alias(n) for n in names])
    # Read twice: for the cuts and for the cells.
    grouped = Stored(joined, "sharding-groups").frame
    numeric = [n for n, is_text in zip(names, texts, strict=True) if not is_text] + ["bytes"]
    cell_of = dict(zip(numeric, cells(grouped, numeric, bits), strict=True))
    coded = grouped.select("doc_id", *group, *[cell_of.get(n, F.col(n).cast("int")).alias(f"c{i}") for i, n in enumerate([*names, "bytes"])])
    coordinates = [f"c{i}" for i in range(len(names) + 1)]
    kind = meta.schema["doc_id"].dataType.simpleString()

    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            curve = hilbert_index([batch.column(c).to_numpy() for c in coordinates], bits)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(curve)], ["doc_id", *group, "curve"])

    order = ["curve", *group, "doc_id"]
    ranged = coded.mapInArrow(index, f"doc_id {kind}, hash long, text_crc32 long, bytes long, curve long").repartitionByRange(*order).sortWithinPartitions(*order)

    def numbered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, dtype=np.int64)), pa.array(np.arange(seen, seen + n, dtype=np.int64))], [*batch.schema.names, "part", "local"])
            seen += n

    placed = Stored(ranged.mapInArrow(numbered, f"doc_id {kind}, hash long, text_crc32 long, bytes long, curve long, part long, local long"), "sharding-order").frame
    # One row a range: where it begins in the whole order.
    counts = sorted((r["part"], r["n"]) for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect())
    parts, sizes = [p for p, _ in counts], [n for _, n in counts]
    begin = np.zeros(max(parts, default=0) + 1, dtype=np.int64)
    begin[parts] = np.cumsum(sizes) - np.array(sizes, dtype=np.int64) if parts else 0
    total = sum(sizes)

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = begin[batch.column("part").to_numpy()] + batch.column("local").to_numpy()
            number = rank * shards // max(1, total)
            slot = rank - -(-number * total // shards)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(batch.column("bytes").to_numpy() + 1), batch.column("text_crc32"), pa.array(["rows"] * n, pa.string()), pa.array(number.astype(np.int32)), pa.array(slot), pa.nulls(n, pa.int32()), batch.column("curve")],
                ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "curve"],
            )

    return placed.select("doc_id", "bytes", "text_crc32", "curve", "part", "local").mapInArrow(assign, f"doc_id {kind}, size long, text_crc32 long, law string, shard int, slot long, grown_shard int, curve long")


def write_shards(docs: DataFrame, path: str, dimensions: tuple[str, ...] = ("lang", "source"), shards: int = 8, bits: int = 4, text_col: str = "text") -> None:
    """Every row of ``docs`` once, in one folder a shard, files in curve order.

    Rows are told apart by a number that they get when they are stored on the way, not by their id: ids may be null or
    repeated, and equal rows are written as often as they occur. An empty table writes no shard."""
    number = "_row"
    while number in docs.columns:
        number += "_"
    rows = Stored(docs.withColumn(number, F.monotonically_increasing_id()), "sharding-rows")
    place = shard(rows.frame, dimensions, shards, bits, id_col=number, text_col=text_col).select(F.col("doc_id").alias(number), F.col("shard").alias("_to"), F.col("slot").alias("_slot"))
    placed = rows.frame.join(place, number).drop(number).repartitionByRange("_to", "_slot").sortWithinPartitions("_to", "_slot").drop("_slot")
    placed.withColumnRenamed("_to", "shard").write.partitionBy("shard").parquet(path)
    rows.drop()
