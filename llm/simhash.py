"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints are made per document in one pass; from there on only distinct fingerprints count, so
exact copies cost nothing. Fingerprints within ``radius`` bits agree in one of ``radius + 1`` blocks of
bits, so there is one order for each block: the word is turned until the block leads, and the turned
words are range-sorted by Gray rank (neighbours differ in few bits) and cut into slices of about equal
size. A node of the index covers consecutive words and holds the bits that all of them share (mask and
pattern); a node's differences add to those of the nodes above it, and a whole group is left as soon
as the sum exceeds the radius or the leading block differs.

* Upper nodes: one pattern for each slice, made with ``bit_and`` and ``bit_or``; at most about
  ``MAX_SLICES``, so their size is bounded. Every word descends them in its own task and goes to the
  slices that may hold a word within the radius: its own, and others only where many words share a block.
* Lower nodes: inside a slice, down to the words. What is found there is reduced to a spanning forest
  at once, so a dense ball of near copies gives as many links as it has members, not pairs.

The forests are joined to components by rounds of star contraction.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import Stored, column, ids_and_texts, one_array

SEED = 42
#: Fingerprints of a slice, and the most slices there are (which bounds the upper nodes: 24 bytes each).
SLICE, MAX_SLICES = 4096, 1 << 16
#: Nodes under one node.
FAN = 16
#: Queries searched at a time.
CHUNK = 512

_U = np.uint64


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """XXH64 of every word shingle, in order; a text of fewer words is one shingle, one without words none."""
    import xxhash

    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype="<u8")
    joined = b" ".join(words)
    view, digest = memoryview(joined), xxhash.xxh64_intdigest
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = max(1, len(words) - width + 1)
    bounds = zip(starts[:n].tolist(), ends[min(width, len(words)) - 1 :].tolist(), strict=True)
    return np.fromiter((digest(view[a:b], SEED) for a, b in bounds), dtype="<u8", count=n)


def fingerprint(text: bytes, width: int = 3) -> int:
    """SimHash of the word shingles; zero for a text without words."""
    hashes = shingle_hashes(text, width)
    n = len(hashes)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, 8192):
        ones += np.unpackbits(hashes[i : i + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp (the 64 bits as a long) of every row."""
    chosen = ids_and_texts(docs, id_col, text_col)
    kind = chosen.schema["doc_id"].dataType.simpleString()

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = one_array(batch.column("text")).cast(pa.binary())
            fps = np.fromiter((fingerprint(t, width) for t in texts.to_pylist()), dtype=np.uint64, count=len(texts))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return chosen.mapInArrow(make, f"doc_id {kind}, fp long")


def gray_rank(fp):
    """Place of a 64-bit word in the Gray sequence, as a column that sorts like the unsigned number."""
    rank = fp
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


def levels_of(patterns: np.ndarray, masks: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels of the index from the top to the given nodes: (pattern, mask) of each node."""
    levels = [(patterns & masks, masks)]
    while len(levels[0][0]) > FAN:
        pattern, mask = levels[0]
        cuts = np.arange(0, len(pattern), FAN)
        shared = np.bitwise_and.reduceat(mask, cuts)
        same_one = np.bitwise_and.reduceat(pattern, cuts)
        same_zero = ~np.bitwise_or.reduceat(pattern, cuts)
        shared &= same_one | same_zero
        levels.insert(0, (same_one & shared, shared))
    return levels


def search(queries: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray]], radius: int, lead: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """(query, node of the last level) pairs that agree in the bits of ``lead`` and whose accumulated
    differences stay within the radius."""
    n = len(levels[0][0])
    q = np.repeat(np.arange(len(queries)), n)
    node = np.tile(np.arange(n), len(queries))
    above = np.zeros(len(q), dtype=np.uint64)
    seen = np.zeros(len(q), dtype=np.int64)
    for depth, (pattern, mask) in enumerate(levels):
        if depth:
            size = len(pattern)
            first = node * FAN
            count = np.minimum(first + FAN, size) - first
            above = np.repeat(levels[depth - 1][1][node], count)
            q, seen = np.repeat(q, count), np.repeat(seen, count)
            node = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        # Bits that the node above has settled are not counted again.
        differs = (queries[q] ^ pattern[node]) & mask[node] & ~above
        seen = seen + np.bitwise_count(differs)
        kept = (seen <= radius) & ((differs & lead) == 0)
        q, node, seen = q[kept], node[kept], seen[kept]
    return q, node


def turned(words: np.ndarray, by: int) -> np.ndarray:
    """The words turned left by so many bits."""
    return words if by % 64 == 0 else (words << _U(by % 64)) | (words >> _U(64 - by % 64))


def blocks(radius: int) -> list[tuple[int, np.uint64]]:
    """For each order: by how much words are turned, and the bits of the block that then leads."""
    edges = [round(64 * i / (radius + 1)) for i in range(radius + 2)]
    return [(a, _U(((1 << (b - a)) - 1) << (64 - (b - a)))) for a, b in zip(edges, edges[1:], strict=False)]


def merge(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the trees of ``a[i]`` and ``b[i]`` for every i; the smallest number is the root."""
    while True:
        ra, rb = parent[a], parent[b]
        differs = ra != rb
        if not differs.any():
            return
        a, b, ra, rb = a[differs], b[differs], ra[differs], rb[differs]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent[:] = up


def links(fps: DataFrame, radius: int = 2) -> tuple[DataFrame, list[Stored]]:
    """Links (a, b) that connect exactly the distinct ``fp`` within ``radius`` bits, at most one a
    word and slice; and the tables to drop once they are read."""
    spark = fps.sparkSession
    orders = blocks(radius)
    slices = min(MAX_SLICES, max(1, -(-fps.count() * len(orders) // SLICE)))
    each = F.array(*[F.struct(F.lit(j).alias("turn"), (F.shiftleft("fp", by).bitwiseOR(F.shiftrightunsigned("fp", 64 - by)) if by else F.col("fp")).alias("word")) for j, (by, _) in enumerate(orders)])
    ranked = fps.select(F.explode(each).alias("o")).select("o.turn", "o.word", gray_rank(F.col("o.word")).alias("rank"))
    leaf = Stored(ranked.repartitionByRange(slices, "turn", "rank").sortWithinPartitions("turn", "rank").withColumn("slice", F.spark_partition_id() * len(orders) + F.col("turn")), "simhash-slices")
    nodes = leaf.frame.groupBy("slice", "turn").agg(F.expr("bit_and(word)").alias("ones"), F.expr("bit_or(word)").alias("some"), F.min("rank").alias("rank")).toPandas().sort_values(["turn", "rank"])
    tops = []
    for j in range(len(orders)):
        own = nodes[nodes["turn"] == j]
        ones, some = (own[c].to_numpy(dtype=np.int64).view(np.uint64) for c in ("ones", "some"))
        tops.append((ones, ~(ones ^ some), own["slice"].to_numpy(dtype=np.int64)))
    top = spark.sparkContext.broadcast(tops)

    def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A word goes to its own slice and to later ones; earlier ones send theirs here."""
        ready = []
        for pattern, mask, number in top.value:
            by_number = np.argsort(number)
            ready.append((levels_of(pattern, mask) if len(pattern) else [], number, by_number, number[by_number]))
        for batch in batches:
            words, turns, slices_ = (batch.column(c).to_numpy() for c in ("word", "turn", "slice"))
            for j in np.unique(turns).tolist():
                levels, number, by_number, ordered = ready[j]
                mine = turns == j
                word, own = words[mine], by_number[np.searchsorted(ordered, slices_[mine])]
                for i in range(0, len(word), CHUNK):
                    q, node = search(word[i : i + CHUNK].view(np.uint64), levels, radius, orders[j][1])
                    here = own[i : i + CHUNK][q]
                    later = node >= here
                    q, node, here = q[later], node[later], here[later]
                    yield pa.RecordBatch.from_arrays([pa.array(number[node].astype(np.int32)), pa.array(np.full(len(q), j, dtype=np.int32)), pa.array(word[i : i + CHUNK][q]), pa.array(node == here)], ["slice", "turn", "word", "member"])

    routed = leaf.frame.select("slice", "turn", "word").mapInArrow(route, "slice int, turn int, word long, member boolean")

    def inside(table: pa.Table) -> pa.Table:
        word, member = table["word"].to_numpy(), table["member"].to_numpy()
        by, lead = orders[table["turn"][0].as_py()]
        own = word[member].view(np.uint64)
        rank = own.copy()
        for shift in (1, 2, 4, 8, 16, 32):
            rank ^= rank >> _U(shift)
        own = own[np.argsort(rank)]
        points = np.concatenate((own, word[~member].view(np.uint64)))
        levels = levels_of(own, np.full(len(own), ~_U(0)))
        parent = np.arange(len(points))
        for i in range(0, len(points), CHUNK):
            q, node = search(points[i : i + CHUNK], levels, radius, lead)
            merge(parent, q + i, node)
        low = np.flatnonzero(parent != np.arange(len(points)))
        back = turned(points, 64 - by)
        return pa.table({"a": back[low].view(np.int64), "b": back[parent[low]].view(np.int64)})

    found = routed.groupBy("slice").applyInArrow(inside, "a long, b long")
    return found, [leaf]


def components(edges: DataFrame) -> tuple[DataFrame, list[Stored]]:
    """node and root of every node of ``edges`` (a, b), by large-star and small-star contraction; the
    root is the smallest node. Each round ends in a stored table."""
    current = Stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "simhash-edges")
    before = None
    while True:
        both = current.frame.union(current.frame.select(F.col("v"), F.col("u")))
        near = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(near, "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = Stored(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "simhash-edges")
        state = after.frame.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        current.drop()
        current = after
        if state == before:
            return current.frame.select(F.col("u").alias("node"), F.col("v").alias("root")), [current]
        before = state


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Documents are linked if their fingerprints differ in at most ``radius`` bits; component_id is the
    smallest doc_id that links lead to. Null, empty and blank texts have fingerprint zero and are
    linked like others. Repeated rows give a row each; a null doc_id is never a component's id unless
    it has no other; an empty table gives no rows; other columns are not read."""
    printed = Stored(fingerprints(docs, width, id_col, text_col), "simhash-documents")
    distinct = Stored(printed.frame.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    found, used = links(distinct.frame.select("fp"), radius)
    roots, _ = components(found)
    for table in used:
        table.drop()
    rooted = distinct.frame.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(smallest, "root").select(F.col("fp").alias("of"), "component_id")
    return printed.frame.join(named, F.col("fp") == F.col("of")).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, width: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, the one with the smallest id; columns as given.

    Rows that repeat that id are one document: one of them stays. A row without an id cannot be told
    from others of its group and stays."""
    return firsts(docs, near_duplicates(docs, width, radius, id_col, text_col), id_col)


def firsts(docs: DataFrame, found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id is the component_id that ``found`` gives it, one row an id, and those without an id."""
    kept = Stored(found.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("n")).withColumnRenamed("doc_id", "_kept"), "simhash-kept").frame
    own = column(id_col)
    # The ids that stay grow with the input, so they are shuffled to the documents at every size, never sent to all;
    # the smaller side is hashed, texts are not sorted.
    single = docs.join(kept.where("n = 1").hint("shuffle_hash"), own == F.col("_kept"), "left_semi")
    repeated = docs.join(kept.where("n > 1"), own == F.col("_kept"), "left_semi").dropDuplicates([id_col])
    return single.union(repeated).union(docs.where(own.isNull()))
