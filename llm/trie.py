"""The prefix trie of conversations, by truncation peeling.

A node is a distinct sequence of first turns. From the maximum depth down, the conversations that end at a depth are
merged with the nodes that survive from the depth below, grouped, and become that depth's nodes with all their
figures; then the last turn is stripped and what is left is grouped again. Nodes are found and aggregated in the same
pass.

How that is distributed:

* A turn is an MD5 sum of role and text, and the number of its words; texts are never shuffled. Places in a
  conversation come from one range sort. A conversation is one row for each ``band`` turns, so no row grows with it.
* Bands of depths are peeled from the deepest up. In a band, paths are range-sorted, so a node is a run of neighbours,
  and each task peels its range whole, level by level. Only the nodes on the paths of a range's first and last row can
  go on in another range. They are left open: what was found below them becomes one item each. The open items of all
  ranges (at most two paths a range) are sorted and peeled again, in ever fewer ranges, until one is enough.
  However many conversations share their first turns, or all turns, they are spread over the ranges.
* A conversation that ends at an open node goes to a list of ids in order, one row a range; a node's
  SHA-256 is fed from these rows in a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import Stored, column, gather_runs

#: Bytes of a turn's MD5 sum.
STEP = 16
SALTS = 16
#: Ranges whose open items are one range of the next round.
FEWER = 8
NO_ENDS = hashlib.sha256(b"").hexdigest()

#: What a task returns: a finished node, an open node's item, or a list of ids of conversations that end at an open node.
NODE, ITEM, ENDS = 0, 1, 2
FOUND = "kind int, key binary, parent binary, start binary, path binary, words binary, conv_id long, depth long, parent_conv_id long, n long, children long, leaves long, saved long, ends binary"
ITEMS = ("start", "path", "words", "conv_id", "n", "children", "leaves", "saved", "ended")


# Turns and rebuilt conversations


def turns_of(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv, place (from 0, by turn, null first), digest, words."""
    role, text = (F.coalesce(column(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    rows = conversations.select(column(conv_col).cast("long").alias("conv"), column(turn_col).alias("turn"), F.unhex(digest).alias("digest"), words.cast("int").alias("words")).where("conv is not null")
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("digest")]

    def numbered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Places counted in this range alone."""
        from pyspark import TaskContext

        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            conv = batch.column("conv").to_numpy()
            if not len(conv):
                continue
            begin = np.flatnonzero(np.concatenate(([True], conv[1:] != conv[:-1])))
            place = np.arange(len(conv)) - np.repeat(begin, np.diff(np.append(begin, len(conv))))
            if conv[0] == last:
                place[: begin[1] if len(begin) > 1 else len(conv)] += seen
            last, seen = int(conv[-1]), int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(conv), part, dtype=np.int64)), *(batch.column(c) for c in ("conv", "digest", "words")), pa.array(place)], ["part", "conv", "digest", "words", "place"])

    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "digest", "words")
    ranked = Stored(sorted_.mapInArrow(numbered, "part long, conv long, digest binary, words int, place long"), "trie-turns").frame
    # One row a range: a conversation may begin in one range and go on in the next ones.
    edges = sorted(tuple(r) for r in ranked.groupBy("part").agg(F.min("conv").alias("first"), F.max("conv").alias("last"), F.max_by(F.col("place"), F.struct("conv", "place")).alias("place")).collect())
    before, conv, so_far = {}, None, 0
    for part, first, last, place in edges:
        if first == conv:
            before[part] = (first, so_far)
        so_far = (so_far if first == last == conv else 0) + place + 1
        conv = last

    def shifted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv, place = batch.column("conv").to_numpy(), batch.column("place").to_numpy().copy()
            parts = batch.column("part").to_numpy()
            for part in np.unique(parts).tolist():
                if part in before:
                    place[(parts == part) & (conv == before[part][0])] += before[part][1]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv", "digest", "words")), pa.array(place)], ["conv", "digest", "words", "place"])

    return ranked.mapInArrow(shifted, "conv long, digest binary, words int, place long")


def rebuilt(turns: DataFrame, base: Column, shared: Column, most_shared: int) -> DataFrame:
    """Conversations that take their first turns from another one.

    ``base`` is the id it takes them from and ``shared`` how many, both expressions over ``conv``, the latter at most
    ``most_shared``: the first ``shared`` turns of the base (all if it has fewer, none if there is none), then its own
    ones from there on. A conversation that is left without turns has one row with place -1."""
    convs = Stored(turns.groupBy("conv").agg(F.count("*").alias("length")).withColumns({"base": base.cast("long"), "shared": shared.cast("long")}), "trie-conversations").frame
    lengths = convs.select(F.col("conv").alias("base"), F.col("length").alias("has"))
    wanted = convs.join(lengths, "base", "left").select("conv", "base", "length", "shared", F.least("shared", F.coalesce("has", F.lit(0))).alias("taken"))
    wanted = Stored(wanted, "trie-wanted").frame
    heads = turns.where(F.col("place") < most_shared).withColumnRenamed("conv", "base")
    taken = wanted.where("taken > 0").join(heads, "base").where("place < taken").select("conv", "place", "digest", "words")
    # A base that has fewer turns than wanted lets the rest move up; such a conversation may hold a third of all rows.
    moved = wanted.where("taken < shared").select("conv", (F.col("shared") - F.col("taken")).alias("up"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    own = turns.where(F.col("place") >= shared.cast("long")).withColumn("salt", F.pmod("place", F.lit(SALTS)).cast("int"))
    own = own.join(moved, ["conv", "salt"], "left").select("conv", (F.col("place") - F.coalesce("up", F.lit(0))).alias("place"), "digest", "words")
    bare = wanted.where("taken = 0 and length <= shared").select("conv", F.lit(-1).cast("long").alias("place"), F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("int").alias("words"))
    return taken.union(own).union(bare)


def bands_of(turns: DataFrame, band: int) -> DataFrame:
    """conv, band, start, path, words, last: a row for each ``band`` turns of a conversation. ``start`` stands for
    all turns before."""
    number = F.greatest(F.expr(f"place div {band}"), F.lit(0)).cast("int")
    each = turns.groupBy("conv", number.alias("band")).agg(F.sort_array(F.collect_list(F.when(F.col("place") >= 0, F.struct("place", F.hex("digest").alias("digest"), "words")))).alias("own"))
    return each.select("conv", "band", F.unhex(F.array_join(F.transform("own", lambda x: x.digest), "")).alias("path"), F.transform("own", lambda x: x.words).alias("words"))


# Peeling a range


@dataclass
class Items:
    """Sorted by start, path, conversation. ``n`` conversations at or below the end of the path; those that end there and
    are rows of their own are ``ended``."""

    start: np.ndarray
    digests: np.ndarray
    words: np.ndarray
    length: np.ndarray
    conv: np.ndarray
    n: np.ndarray
    children: np.ndarray
    leaves: np.ndarray
    saved: np.ndarray
    ended: np.ndarray

    def shared(self) -> np.ndarray:
        """How many turns each item shares with the one before it; -1 if not even the start."""
        size = len(self.length)
        out = np.zeros(size, dtype=np.int64)
        same = np.concatenate(([False], self.start[1:] == self.start[:-1]))
        out[~same] = -1
        first = np.cumsum(self.length) - self.length
        left = np.flatnonzero(same)
        depth = 0
        while len(left):
            left = left[(self.length[left] > depth) & (self.length[left - 1] > depth)]
            left = left[(self.digests[first[left] + depth] == self.digests[first[left - 1] + depth]).all(axis=1)]
            depth += 1
            out[left] = depth
        return out


@dataclass
class Level:
    """Nodes of one depth, in order of their first item."""

    depth: int
    begin: np.ndarray
    conv: np.ndarray
    n: np.ndarray
    children: np.ndarray
    leaves: np.ndarray
    saved: np.ndarray
    open: np.ndarray
    parent: np.ndarray | None = None


def peel(items: Items, closed: bool) -> Iterator[Level]:
    """Levels from the deepest up, each with the places of its nodes' parents in the next level (-1 for starts).

    A node that may go on in another range is open: it has only what was found outside of open nodes below it. With
    ``closed`` there is no other range."""
    size, shared = len(items.length), items.shared()
    first = np.cumsum(items.length) - items.length
    by_length = np.argsort(items.length, kind="stable")
    ends = np.searchsorted(items.length[by_length], np.arange(items.length.max(initial=0) + 2))
    below: Level | None = None
    for depth in range(int(items.length.max(initial=0)), -1, -1):
        new = by_length[ends[depth] : ends[depth + 1]]
        live = np.zeros(0, dtype=np.int64) if below is None else below.begin
        kept = np.ones(len(live), dtype=bool) if below is None else ~below.open
        begin = np.concatenate((new, live))
        order = np.argsort(begin, kind="stable")

        begin = begin[order]
        # The longest item passes through every depth, so there is a node at least.
        at = np.flatnonzero(shared[begin] < depth)

        def grouped(own: np.ndarray, survivors: np.ndarray, add=np.add, order=order, new=new, at=at) -> np.ndarray:
            return add.reduceat(np.concatenate((own[new], survivors))[order], at)

        conv = grouped(items.conv, live if below is None else below.conv, np.minimum)
        children = grouped(items.children, kept.astype(np.int64))
        n, leaves, saved = (grouped(getattr(items, c), live if below is None else getattr(below, c) * kept) for c in ("n", "leaves", "saved"))
        node_begin = begin[at]
        is_open = np.zeros(len(at), dtype=bool)
        if not closed:
            is_open[0] = node_begin[0] == 0
            is_open[-1] |= items.length[size - 1] >= depth
        done = ~is_open
        leaves = leaves + (done & (children == 0))
        if depth:
            saved = saved + np.where(done, (n - 1) * items.words[first[node_begin] + depth - 1], 0)
        level = Level(depth, node_begin, conv, n, children, leaves, saved, is_open)
        if below is not None:
            of = np.empty(len(begin), dtype=np.int64)
            of[order] = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(begin))))
            below.parent = of[len(new) :]
            yield below, level
        below = level
    if below is not None:
        yield below, None


def items_of(batches: Iterable[pa.RecordBatch]) -> Items | None:
    read = [b for b in batches if b.num_rows]
    if not read:
        return None
    table = pa.Table.from_batches(read).combine_chunks()
    paths, words = (b"".join(table[c].to_pylist()) for c in ("path", "words"))
    digests = np.frombuffer(paths, dtype="<u8").reshape(-1, 2)
    length = pc.binary_length(table["path"]).to_numpy().astype(np.int64) // STEP
    numbers = (table[c].to_numpy() for c in ("conv_id", "n", "children", "leaves", "saved", "ended"))
    return Items(np.array(table["start"].to_pylist(), dtype=object), digests, np.frombuffer(words, dtype=">i4").astype(np.int64), length, *numbers)


def peeled(batches: Iterable[pa.RecordBatch], band: int, width: int, closed: bool, first_round: bool) -> Iterator[pa.RecordBatch]:
    items = items_of(batches)
    if items is None:
        return
    first = np.cumsum(items.length) - items.length
    raw = np.ascontiguousarray(items.digests).view(np.uint8).reshape(-1, STEP)
    names = [x.split()[0] for x in FOUND.split(", ")]
    kinds = dict(zip(names, (pa.int32(), *[pa.binary()] * 5, *[pa.int64()] * 7, pa.binary()), strict=True))

    def path_of(row: int, depth: int) -> bytes:
        return raw[first[row] : first[row] + depth].tobytes()

    def key_of(row: int, depth: int) -> bytes:
        """The first node of a lower band has its start as key, which is the key of the last node above."""
        return hashlib.md5(items.start[row] + hashlib.md5(path_of(row, depth)).digest()).digest() if depth or not band else items.start[row]

    def batch(**columns) -> pa.RecordBatch:
        size = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([pa.array(columns[c], kinds[c]) if c in columns else pa.nulls(size, kinds[c]) for c in names], names)

    ended = np.concatenate(([0], np.cumsum(items.ended)))
    # Where the run of items that end exactly at an item's path ends: those with the same path follow each other.
    shared = items.shared()
    fresh = np.concatenate(((shared[1:] < items.length[1:]) | (items.length[1:] != items.length[:-1]), [True]))
    run_end = np.empty(len(fresh), dtype=np.int64)
    run_end[:] = np.flatnonzero(fresh)[np.searchsorted(np.flatnonzero(fresh), np.arange(len(fresh)))] + 1

    def ids(row: int, depth: int) -> bytes:
        if items.length[row] != depth:
            return b""
        end = run_end[row]
        return ",".join(map(str, items.conv[row:end][items.ended[row:end]].tolist())).encode() if ended[end] > ended[row] else b""

    for level, above in peel(items, closed):
        done, depth = np.flatnonzero(~level.open), level.depth
        if len(done):
            rows = level.begin[done].tolist()
            # Of a lower band's first nodes, the members that end there are in the band above.
            parent_open = np.zeros(len(done), dtype=bool) if above is None else above.open[level.parent[done]] | (band > 0 and depth == 1)
            parents = [None] * len(done) if above is None else above.conv[level.parent[done]].tolist()
            parent_key = [key_of(r, depth - 1) if o else None for r, o in zip(rows, parent_open.tolist(), strict=True)]
            yield batch(
                kind=np.full(len(done), NODE, dtype=np.int32), conv_id=level.conv[done], depth=np.full(len(done), band * width + depth), parent=parent_key,
                parent_conv_id=[None if o else p for o, p in zip(parent_open.tolist(), parents, strict=True)],
                key=[None if first_round and depth < width else key_of(r, depth) for r in rows], start=[items.start[r] if not depth else None for r in rows],
                ends=[hashlib.sha256(ids(r, depth)).hexdigest().encode() if first_round else None for r in rows],
                n=level.n[done], children=level.children[done], leaves=level.leaves[done], saved=level.saved[done],
            )
        for k in np.flatnonzero(level.open).tolist():
            row = int(level.begin[k])
            own = {c: [getattr(level, c)[k]] for c in ("n", "children", "leaves", "saved")}
            if not any(own["n"] + own["children"]):
                continue  # an open node further down says that this one is there
            words = items.words[first[row] : first[row] + depth].astype(">i4").tobytes()
            yield batch(kind=[ITEM], start=[items.start[row]], path=[path_of(row, depth)], words=[words], conv_id=[level.conv[k]], **own)
            if first_round and (some := ids(row, depth)):
                yield batch(kind=[ENDS], key=[key_of(row, depth)], conv_id=[items.conv[row]], ends=[some])


def digests(lists: DataFrame) -> DataFrame:
    """key and SHA-256 of its lists of ids, joined in order; the lists of a key are read one after the other."""

    def feed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                here, more = batch.column("key")[i].as_py(), batch.column("ends")[i].as_py()
                if here != key:
                    if key is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest().encode()], pa.binary())], ["key", "sha"])
                    key, state = here, hashlib.sha256(more)
                else:
                    state.update(b"," + more)
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest().encode()], pa.binary())], ["key", "sha"])

    return lists.repartition("key").sortWithinPartitions("key", "conv_id").select("key", "ends").mapInArrow(feed, "key binary, sha binary")


def prefix_trie(
    conversations: DataFrame, base: Column | None = None, shared: Column | None = None, most_shared: int = 3, band: int = 1024, per_range: int = 10_000,
    conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    The root has depth 0 and no parent; conv_id is a node's smallest member, n_leaves and saved_tokens are summed over
    its subtree, itself included, and ends_sha256 is of the ids of the conversations that end at it. With ``base`` and
    ``shared`` conversations are rebuilt first (see ``rebuilt``); a conversation without turns ends at the root.

    Turns are ordered by turn, null first; equal ones by the digest of role and text, so the result does not depend on
    the order of rows; repeated rows are turns each. Null roles and texts are empty; rows without a conversation id take no
    part; an empty table gives no rows; other columns are not read. ``per_range``: rows that one task peels at a time."""
    spark = conversations.sparkSession
    turns = turns_of(conversations, conv_col, turn_col, role_col, text_col)
    if base is not None:
        turns = rebuilt(turns, base, shared, most_shared)
    cut = Stored(bands_of(turns, band), "trie-bands").frame
    bands = cut.agg(F.max("band")).first()[0]
    if bands is None:
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    start = F.lit(b"")
    if bands:
        # Only conversations longer than a band have more than one row here.
        before = Window.partitionBy("conv").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
        start = F.aggregate(F.collect_list(F.unhex(F.md5("path"))).over(before), F.lit(b""), lambda so_far, path: F.unhex(F.md5(F.concat(so_far, path))))
    last = F.lead("band").over(Window.partitionBy("conv").orderBy("band")).isNull() if bands else F.lit(True)
    packed = F.unhex(F.array_join(F.transform("words", lambda w: F.lpad(F.hex(w), 8, "0")), ""))
    zero = F.lit(0).cast("long")
    cut = cut.select("conv", "band", start.alias("start"), "path", packed.alias("words"), last.alias("last"))
    if bands:
        cut = Stored(cut, "trie-starts").frame
    found, lists = None, None
    for number in range(bands, -1, -1):
        here = cut.where(F.col("band") == number)
        items = here.where("last").select("start", "path", "words", F.col("conv").alias("conv_id"), F.lit(1).cast("long").alias("n"), zero.alias("children"), zero.alias("leaves"), zero.alias("saved"), F.lit(True).alias("ended"))
        if found is not None:
            alive = found.where(F.col("start").isNotNull() & (F.col("band") == number + 1)).select("conv_id", "n", "children", "leaves", "saved")
            places = here.select(F.col("conv").alias("conv_id"), "start", "path", "words")
            items = items.union(alive.join(places, "conv_id").select("start", "path", "words", "conv_id", "n", "children", "leaves", "saved", F.lit(False).alias("ended")))
        nodes, ends = _band(items, number, band, per_range)
        nodes = nodes.withColumn("band", F.lit(number))
        found = nodes if found is None else found.union(nodes)
        lists = ends if lists is None else lists.union(ends)
    return _finish(found, lists)


def _band(items: DataFrame, number: int, width: int, per_range: int) -> tuple[DataFrame, DataFrame]:
    """Finished nodes of one band, and lists of ids for those that were open at first."""
    items = Stored(items, "trie-items").frame
    nodes, ends, first_round = None, None, True
    ranges, order = -(-items.count() // per_range), ["start", "path", "conv_id"]
    while True:
        closed = ranges <= 1
        ranged = items.coalesce(1) if closed else items.repartitionByRange(ranges, *order)
        run = lambda batches, closed=closed, first_round=first_round: peeled(batches, number, width, closed, first_round)
        out = Stored(ranged.sortWithinPartitions(*order).select(*ITEMS).mapInArrow(run, FOUND), "trie-found", by=("kind",)).frame
        done = out.where(F.col("kind") == NODE).drop("kind")
        nodes = done if nodes is None else nodes.union(done)
        if first_round:
            ends = out.where(F.col("kind") == ENDS).select("key", "conv_id", "ends")
        if closed:
            return nodes, ends
        items = out.where(F.col("kind") == ITEM).select(*[c for c in ITEMS if c != "ended"], F.lit(False).alias("ended"))
        # A range leaves two paths at most, so the items of FEWER ranges fit one task.
        first_round, ranges = False, ranges // FEWER


def _finish(found: DataFrame, lists: DataFrame) -> DataFrame:
    """Parents and lists of ids of nodes that were open in some round."""
    # A lower band's first nodes are nodes of the band above as well.
    nodes = found.where(F.col("start").isNull() | (F.col("band") == 0))
    named = nodes.where("key is not null").select(F.col("key").alias("parent"), F.col("conv_id").alias("above"))
    # The root may be the parent of a third of all nodes.
    salted = named.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    waiting = nodes.where("parent is not null").withColumn("salt", F.pmod(F.xxhash64("conv_id"), F.lit(SALTS)).cast("int"))
    waiting = waiting.join(salted, ["parent", "salt"]).withColumn("parent_conv_id", F.col("above")).drop("above", "salt")
    whole = nodes.where("parent is null").unionByName(waiting)
    sha = F.coalesce(F.col("ends").cast("string"), F.col("sha").cast("string"), F.lit(NO_ENDS))
    told = digests(lists)
    late = whole.where("key is not null").join(told, "key", "left")
    early = whole.where("key is null").withColumn("sha", F.lit(None).cast("binary"))
    return late.unionByName(early).select("conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), sha.alias("ends_sha256"))
