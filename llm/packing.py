"""Best-fit packing of tokenised documents into sequences.

Bulk-synchronous best-fit, decreasing:

1. documents are tokenised; only those longer than a sequence are cut;
2. pieces are range-sorted by length, and each gets its rank among the pieces of its length;
3. sweeps over the sorted lengths and the sorted gaps: each length goes to its successor, the
   smallest gap that holds it. Pieces that want the same gaps are told apart by rank: rank r takes
   the r-th gap. The gaps are updated and the sweep is repeated until the length has no piece left;
   a length without a gap opens new sequences;
4. every piece looks its place up by its rank.

Pieces of one length and gaps of one size are alike, so the sweeps work on runs (length, ranks from,
to) and (gap, sequences from, to). There are at most ``max_tokens`` lengths and gaps, however many
documents: the runs are the only thing that leaves the executors, and the pieces are sorted once.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import Stored, ids_and_texts, sizes_of, sliced, texts_of
from llm.tokens import token_ids

#: Bytes of text tokenised at a time: the larger, the fewer distinct parts in all.
BATCH_BYTES = 16 << 20


def pieces_of(docs: DataFrame, tokenizer: str, max_tokens: int, end: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece. An empty text is the end id alone."""
    chosen = ids_and_texts(docs, id_col, text_col)
    kind = chosen.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch)
            for a, b in sliced(sizes_of(texts), BATCH_BYTES):
                ids, counts = token_ids(texts.slice(a, b - a), tokenizer, end)
                ids = np.ascontiguousarray(ids, dtype="<u4")
                n_pieces = -(-counts // max_tokens)
                row = np.repeat(np.arange(b - a), n_pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
                start = piece * max_tokens
                length = np.minimum(counts[row] - start, max_tokens)
                first = (np.cumsum(counts) - counts)[row] + start
                crc = [zlib.crc32(ids[f : f + n]) for f, n in zip(first.tolist(), length.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start.astype(np.int64)), pa.array(length.astype(np.int64)), pa.array(crc, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return chosen.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def sweep(counts: dict[int, int], max_tokens: int) -> tuple[pd.DataFrame, int]:
    """Places for ``counts[length]`` pieces of each length: runs (length, rank, n, sequence, offset) and
    the number of sequences. The i-th piece of a run goes to the i-th sequence from ``sequence`` on."""
    gaps: dict[int, list[tuple[int, int]]] = {}
    sizes: list[int] = []
    runs, opened = [], 0

    def put(gap: int, first: int, n: int) -> None:
        if gap:
            if gap not in gaps:
                gaps[gap] = []
                insort(sizes, gap)
            gaps[gap].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(sizes, length)
            if at < len(sizes):
                gap = sizes[at]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], sizes[at]
                took = min(n, left)
                if took < n:
                    put(gap, first + took, n - took)
            else:
                gap, first, took = max_tokens, opened, -(-left // (max_tokens // length))
                opened += took
            runs.append((length, rank, took, first, max_tokens - gap))
            put(gap - length, first, took)
            rank, left = rank + took, left - took
    return pd.DataFrame(runs, columns=["length", "rank", "n", "sequence", "offset"], dtype="int64"), opened


def pack(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", max_tokens: int = 2048, end: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are the end id alone; repeated rows are packed each; null ids sort first;
    an empty table gives no rows; other columns are not read. A sequence is gapless from offset 0."""
    pieces = Stored(pieces_of(docs, tokenizer, max_tokens, end, id_col, text_col), "packing-pieces")
    order = ["length", "doc_id", "piece"]
    frame = pieces.frame
    ranged = frame.repartitionByRange(F.col("length").desc(), F.col("doc_id"), F.col("piece")).sortWithinPartitions(F.col("length").desc(), *order[1:])
    kind = frame.schema["doc_id"].dataType.simpleString()

    def numbered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Ranks within a length, counted in this range alone."""
        from pyspark import TaskContext

        part, last, seen = TaskContext.get().partitionId(), -1, 0
        for batch in batches:
            length = batch.column("length").to_numpy()
            if not len(length):
                continue
            new = np.concatenate(([True], length[1:] != length[:-1]))
            begin = np.flatnonzero(new)
            local = np.arange(len(length)) - np.repeat(begin, np.diff(np.append(begin, len(length))))
            if length[0] == last:
                head = begin[1] if len(begin) > 1 else len(length)
                local[:head] += seen
            last, seen = int(length[-1]), int(local[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(length), part, dtype=np.int64)), pa.array(local.astype(np.int64))], [*batch.schema.names, "part", "local"])

    ranked = Stored(ranged.mapInArrow(numbered, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part long, local long"), "packing-ranked")
    pieces.drop()
    # Ranges are sorted by length: at most as many rows here as there are ranges and lengths together.
    ranges = ranked.frame.groupBy("part", "length").agg(F.count("*").alias("n")).toPandas().sort_values(["length", "part"])
    ranges["before"] = ranges.groupby("length")["n"].cumsum() - ranges["n"]
    before = {(int(p), int(k)): int(b) for p, k, b in zip(ranges["part"], ranges["length"], ranges["before"], strict=True)}
    runs, _ = sweep({int(k): int(n) for k, n in ranges.groupby("length")["n"].sum().items()}, max_tokens)
    runs = runs.sort_values(["length", "rank"])
    starts = runs["length"].to_numpy() * (1 << 45) + runs["rank"].to_numpy()
    values = {c: runs[c].to_numpy() for c in ("rank", "sequence", "offset")}

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            part, length = batch.column("part").to_numpy(), batch.column("length").to_numpy()
            keys, index = np.unique(part * (max_tokens + 1) + length, return_inverse=True)
            add = np.array([before[divmod(int(k), max_tokens + 1)] for k in keys], dtype=np.int64)
            rank = batch.column("local").to_numpy() + add[index]
            at = np.searchsorted(starts, length * (1 << 45) + rank, side="right") - 1
            sequence = values["sequence"][at] + rank - values["rank"][at]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(values["offset"][at])], [*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.frame.select("doc_id", "piece", "start", "length", "ids_crc32", "part", "local").mapInArrow(place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
