"""Hard negatives by exact integer scores, looked up in subset-sum tables (the method of the Four Russians).

A component x becomes the integer floor(scale * x); a score is the inner product of two integer vectors.

1. A candidate is cut into bit planes: bit k of eight neighbouring dimensions makes a byte, so a vector
   of D dimensions and B bits is B * D / 8 bytes. That is all that is stored of it.
2. For each group of eight dimensions an anchor has a table of its 256 subset sums, built by doubling:
   the sum of a byte's dimensions is one lookup.
3. A candidate's bytes of one plane index the tables, the lookups of the groups add up, and planes are joined by
   shift and add from the highest, which has negative weight (two's complement). The sum is the full score, exact.

Anchors are taken in blocks of about ``block`` rows, which bounds what is broadcast; every block meets every row. A
first pass scores rows against the anchors of their own label and keeps each anchor's positives, a second
scores them against all anchors and keeps, for each positive, the best rows of another label in its window.
Each task keeps the best of its rows alone; Spark ranks what the tasks have kept.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import Stored, column, one_array
from noticelake.workspace import fresh_dir, path_exists

GROUP = 8
#: Rows and anchors scored at a time: tables and scores stay in the processor's cache.
ROWS, ANCHORS = 1024, 512

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def whole_numbers(vectors: pa.Array, dims: int, scale: int) -> np.ndarray:
    """A row per vector of floor(scale * x); dimensions that a vector does not have are zero."""
    vectors = one_array(vectors)
    lengths = np.diff(vectors.offsets.to_numpy()).astype(np.int64)
    flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale).astype(np.int64)
    out = np.zeros((len(lengths), dims), dtype=np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def bit_planes(numbers: np.ndarray, bits: int) -> np.ndarray:
    """Bytes of each row: plane by plane from the lowest, group by group."""
    planes = [np.packbits(((numbers >> k) & 1).astype(np.uint8), axis=1, bitorder="little") for k in range(bits)]
    return np.concatenate(planes, axis=1) if planes else np.zeros((len(numbers), 0), dtype=np.uint8)


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """``[group, byte, anchor]``: the sum of the anchor's dimensions in the group whose bits the byte has."""
    groups = anchors.shape[1] // GROUP
    bound = int(np.abs(anchors).sum(axis=1).max(initial=0))
    kind = np.int16 if bound < 1 << 15 else np.int32 if bound < 1 << 31 else np.int64
    tables = np.zeros((groups, 1 << GROUP, len(anchors)), dtype=kind)
    for g in range(groups):
        for j in range(GROUP):
            half = 1 << j
            tables[g, half : 2 * half] = tables[g, :half] + anchors[:, GROUP * g + j].astype(kind)
    return tables


def scores(planes: np.ndarray, tables: np.ndarray, bits: int) -> np.ndarray:
    """``[row, anchor]``: inner products, by lookups and shifts."""
    groups, _, many = tables.shape
    total = np.zeros((len(planes), many), dtype=np.int64)
    found = np.empty((len(planes), many), dtype=tables.dtype)
    plane = np.empty_like(found)
    for k in range(bits - 1, -1, -1):
        for g in range(groups):
            np.take(tables[g], planes[:, k * groups + g], axis=0, out=found if g else plane)
            if g:
                plane += found
        total <<= 1
        if k == bits - 1:
            total -= plane
        else:
            total += plane
    return total


class Best:
    """The ``most`` best rows of each slot so far: higher scores first, ties by smaller id."""

    def __init__(self, slots: int, most: int):
        self.most = most
        self.slot = self.score = self.id = np.zeros(0, dtype=np.int64)
        #: Below this score nothing enters a slot.
        self.floor = np.full(slots, np.iinfo(np.int64).min)

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, ids = np.concatenate((self.slot, slot)), np.concatenate((self.score, score)), np.concatenate((self.id, ids))
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        begin = np.flatnonzero(np.concatenate(([True], slot[1:] != slot[:-1])))
        place = np.arange(len(slot)) - np.repeat(begin, np.diff(np.append(begin, len(slot))))
        last = place == self.most - 1
        self.floor[slot[last]] = score[last]
        keep = place < self.most
        self.slot, self.score, self.id = slot[keep], score[keep], ids[keep]


@dataclass
class Anchors:
    """A block of anchors; ``positives`` of the second pass are (place of the anchor, id, score), best first."""

    ids: np.ndarray
    labels: np.ndarray
    numbers: np.ndarray
    bits: int

    def positives(self, batches: Iterable[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
        """Rows of an anchor's own label, the ``most`` best of this task."""
        own: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for label in np.unique(self.labels).tolist():
            at = np.flatnonzero(self.labels == label)
            own[label] = [(part, subset_sums(self.numbers[part])) for part in np.split(at, range(ANCHORS, len(at), ANCHORS))]
        best = Best(len(self.ids), most)
        for ids, labels, planes in rows_of(batches):
            for label in np.unique(labels).tolist():
                here = np.flatnonzero(labels == label)
                for at, tables in own.get(label, ()):
                    found = scores(planes[here], tables, self.bits)
                    row, anchor = np.nonzero((found >= best.floor[at]) & (ids[here][:, None] != self.ids[at]))
                    best.add(at[anchor], found[row, anchor], ids[here][row])
        yield pa.RecordBatch.from_arrays([pa.array(self.ids[best.slot]), pa.array(best.id), pa.array(best.score)], ["anchor_id", "row_id", "score"])

    def negatives(self, batches: Iterable[pa.RecordBatch], pairs: pa.Table, most: int, least_share: int, most_share: int) -> Iterator[pa.RecordBatch]:
        """For each (anchor, positive): the ``most`` best rows of another label, of this task, whose score
        lies between the two shares (in hundredths) of the positive's."""
        place = np.argsort(self.ids)
        anchor = place[np.searchsorted(self.ids[place], pairs["anchor_id"].to_numpy())]
        score = pairs["score"].to_numpy()
        low, high = -(-least_share * score // 100), most_share * score // 100
        best = Best(len(pairs), most)
        parts = []
        for at in np.split(np.arange(len(self.ids)), range(ANCHORS, len(self.ids), ANCHORS)):
            mine = np.flatnonzero((anchor >= at[0]) & (anchor <= at[-1])) if len(at) else at
            if len(mine):
                turn = np.zeros(len(mine), dtype=np.int64)  # how many of the anchor's pairs come before
                order = np.argsort(anchor[mine], kind="stable")
                begin = np.flatnonzero(np.diff(anchor[mine][order], prepend=-1))
                turn[order] = np.arange(len(mine)) - np.repeat(begin, np.diff(np.append(begin, len(mine))))
                parts.append((at, subset_sums(self.numbers[at]), [mine[turn == t] for t in range(int(turn.max()) + 1)]))
        for ids, labels, planes in rows_of(batches):
            for at, tables, turns in parts:
                found = scores(planes, tables, self.bits)
                other = labels[:, None] != self.labels[at]
                for slots in turns:
                    col = anchor[slots] - at[0]
                    seen = found[:, col]
                    row, k = np.nonzero((seen <= high[slots]) & (seen >= np.maximum(low[slots], best.floor[slots])) & other[:, col])
                    best.add(slots[k], seen[row, k], ids[row])
        yield pa.RecordBatch.from_arrays([pairs["anchor_id"].to_numpy()[best.slot], pairs["row_id"].to_numpy()[best.slot], score[best.slot], best.id, best.score], ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):
            part = batch.slice(i, ROWS)
            packed = part.column("planes").to_pylist()
            yield part.column("id").to_numpy(), part.column("label").to_numpy(), np.frombuffer(b"".join(packed), dtype=np.uint8).reshape(len(packed), -1)


def mine(
    vectors: DataFrame, anchor: Column, label: Column, scale: int = 256, positives: int = 5, negatives: int = 10, least_share: int = 30, most_share: int = 90,
    block: int = 8192, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """One row per anchor, positive and negative: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` says which rows are anchors, ``label`` is the label by which rows count as alike; both are
    expressions over ``vectors``. Positives are an anchor's first ``positives`` other rows of its label, negatives the
    first ``negatives`` rows of another label whose score is at least ``least_share`` and at most ``most_share``
    hundredths of the positive's. Higher scores come first, ties by the smaller id.

    Rows without id, label or vector, or with a null or non-finite component, take no part; an empty vector
    is all zeros, and a shorter one has zeros at its end. Rows that share an id are one row (the one with the
    smallest label, then the smallest bit planes), which is an anchor if any of them is. An anchor without positives, or
    a positive without negatives, gives no rows, nor does an empty table. Other columns are not read. Components so
    large that scores would not fit a long raise ValueError."""
    spark = vectors.sparkSession
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    chosen = vectors.select(column(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), column(vector_col).alias("vector"))
    chosen = chosen.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ~odd)
    found = chosen.agg(F.max(F.size("vector")), F.max(F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double")))))).first()
    dims, top = -(-max(1, found[0] or 0) // GROUP) * GROUP, (found[1] or 0.0) * scale + 1
    if dims * top * top >= 2.0**62:
        raise ValueError(f"components up to {top / scale:g} in {dims} dimensions give scores that do not fit a long")
    bits = int(top).bit_length() + 1

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                planes = bit_planes(whole_numbers(part.column("vector"), dims, scale), bits)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("id", "label", "anchor")), pa.array([p.tobytes() for p in planes], pa.binary())], ["id", "label", "anchor", "planes"])

    packed = chosen.mapInArrow(pack, "id long, label long, anchor boolean, planes binary")
    rows = Stored(packed.groupBy("id").agg(F.max("anchor").alias("anchor"), F.min(F.struct("label", "planes")).alias("row")).select("id", "anchor", "row.label", "row.planes"), "negatives-rows").frame
    blocks = -(-rows.where("anchor").count() // block)
    path = fresh_dir(spark, "negatives-found")
    candidates = rows.select("id", "label", "planes")
    for number in range(blocks):
        # at most about ``block`` rows: by hash of the id, as a running number would need one task
        own = rows.where("anchor").where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == number).select("id", "label", "planes").orderBy("id").toArrow()
        if not own.num_rows:
            continue
        planes = np.frombuffer(b"".join(own["planes"].to_pylist()), dtype=np.uint8).reshape(own.num_rows, -1)
        sent = spark.sparkContext.broadcast(Anchors(own["id"].to_numpy(), own["label"].to_numpy(), numbers_of(planes, bits), bits))
        near = candidates.mapInArrow(lambda batches, sent=sent: sent.value.positives(batches, positives), "anchor_id long, row_id long, score long")
        best = Window.partitionBy("anchor_id").orderBy(F.col("score").desc(), "row_id")
        pairs = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= positives).select("anchor_id", "row_id", "score").orderBy("anchor_id", F.col("score").desc(), "row_id").toArrow()
        if pairs.num_rows:
            wanted = spark.sparkContext.broadcast(pairs)
            far = candidates.mapInArrow(
                lambda batches, sent=sent, wanted=wanted: sent.value.negatives(batches, wanted.value, negatives, least_share, most_share),
                "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long",
            )
            best = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
            far = far.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
            far.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score").write.mode("append").parquet(path)
            wanted.destroy()
        sent.destroy()
    return spark.read.schema(RESULT).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], RESULT)


def numbers_of(planes: np.ndarray, bits: int) -> np.ndarray:
    """The integers that bit planes stand for."""
    groups = planes.shape[1] // max(1, bits)
    out = np.zeros((len(planes), groups * GROUP), dtype=np.int64)
    for k in range(bits):
        bit = np.unpackbits(planes[:, k * groups : (k + 1) * groups], axis=1, bitorder="little").astype(np.int64)
        out += (-bit if k == bits - 1 else bit) << k
    return out
