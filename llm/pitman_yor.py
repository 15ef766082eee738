"""Language-model scores from a hierarchical Pitman-Yor model.

A token's context is the word before it, hashed to one of 16383 restaurants; the first token of a text is in restaurant
0. All context restaurants share one parent, the unigram restaurant, over a uniform base of the vocabulary and one
unknown word. A customer who opens a table in a context restaurant is a customer of the parent.

Seats are sampled by Gibbs rounds. The seating starts with one table a dish and restaurant, and is carried from round to
round. In a round a dish's customers in a restaurant leave it together and are seated anew given everybody else:
their number of tables t has the conditional probability a^t S(c, t), where c is their number, a the weight of a new
table, and S a generalised Stirling number, and is drawn from it exactly up to 256 customers; larger parties are seated
an eighth at a time. Then the dish's tables are customers of the parent, and are seated there in the same way. All
restaurants' customers of one word lie together, so this takes place within a task; what words share are totals:
customers and tables of each restaurant, summed up after a round. Within a round the totals stand still (the usual form
of a distributed sampler). Draws are hashes of (word, restaurant, round): a task derives the seating of a round again
from the totals of the rounds before, so none is stored and a task that runs again seats the same. The predictive
probabilities of the last rounds are averaged.

Data flow. Texts are encoded in blocks of about 16 MB. A block's distinct words, with their (context, count) pairs, are
cut by hash into shards of the vocabulary, one row per block and shard; its documents are rows of pair numbers. A
shard gathers its words from all blocks, one row per shard, and does all the seating; then it answers each block
with the probabilities it asked for, and the block adds up its documents. The number of shards follows the amount of
text, so a shard's size does not; no vocabulary is ever broadcast or collected.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.classifier import split_words
from llm.common import Stored, column, per_row, sizes_of, texts_of

CONTEXTS = 1 << 14
#: Up to so many customers of a dish their tables are drawn exactly.
EXACT = 256
BLOCK_BYTES = 16 << 20
#: Bytes of text for each shard of the vocabulary.
SHARD_BYTES = 8 << 20
#: The token that ends a text; no word is empty.
END = ""

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _times(number: np.uint64, n: int) -> np.uint64:
    """``number * n`` modulo 2 ** 64."""
    return np.uint64(int(number) * n % (1 << 64))


# Encoding


def packed(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A binary column: the bytes of consecutive runs of ``values``."""
    offsets = np.concatenate(([0], np.cumsum(lengths))) * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def unpacked(col: pa.Array | pa.ChunkedArray, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """Values of all rows, one after the other, and how many each row has; a null row has none."""
    col = (col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col).cast(pa.large_binary()).fill_null(b"")
    size = np.dtype(dtype).itemsize
    lengths = pc.binary_length(col).to_numpy(zero_copy_only=False).astype(np.int64) // size
    _, ends, data = col.buffers()
    if not len(col) or data is None:
        return np.zeros(0, dtype=dtype), lengths
    offsets = np.frombuffer(ends, dtype=np.int64)[col.offset : col.offset + len(col) + 1]
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]].view(dtype), lengths


def to_bytes(columns: dict[str, pa.Array | np.ndarray]) -> bytes:
    """A small table as one value."""
    batch = pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns.values()], list(columns))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def from_bytes(value: bytes) -> pa.Table:
    return pa.ipc.open_stream(value).read_all()


@dataclass
class Block:
    """A block's distinct words by shard, their hashes, their (context, count) pairs by word and context, and the
    pair of each token of each text."""

    words: pa.Array
    hashes: np.ndarray
    shard: np.ndarray
    contexts: np.ndarray
    counts: np.ndarray
    pairs: np.ndarray
    per_word: np.ndarray
    per_text: np.ndarray


def encode(texts: pa.Array, held_out: np.ndarray, shards: int) -> Block:
    coded, counts = split_words(pc.ascii_lower(texts))
    words = pa.concat_arrays([coded.dictionary.cast(pa.string()), pa.array([END], pa.string())])
    hashes = np.fromiter(map(zlib.crc32, words.cast(pa.binary()).to_pylist()), dtype=np.int64, count=len(words))
    order = np.argsort(hashes % shards, kind="stable")
    words, hashes = words.take(pa.array(order)), hashes[order]
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.arange(len(order))
    ids = np.insert(number[coded.indices.to_numpy()], np.cumsum(counts), number[-1])
    counts = counts + 1
    del coded, order, number
    opens = 1 + hashes % (CONTEXTS - 1)
    # Restaurant of the word before, if that is in the same text.
    context = np.concatenate((np.zeros(min(1, len(ids)), dtype=np.int64), opens[ids[:-1]]))
    context[np.cumsum(counts) - counts] = 0
    del opens
    key = ids * CONTEXTS + context
    del ids, context
    order = key * 2
    order += np.repeat(~held_out, counts)
    order.sort()
    pair = order >> 1
    first = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1]))) if len(pair) else np.zeros(0, dtype=np.int64)
    distinct = pair[first]
    del pair
    seen = np.add.reduceat(order & 1, first) if len(first) else np.zeros(0, dtype=np.int64)
    del order
    return Block(words, hashes, hashes % shards, (distinct % CONTEXTS).astype("<u2"), seen.astype("<u4"), np.searchsorted(distinct, key).astype("<i4"), np.bincount(distinct // CONTEXTS, minlength=len(words)).astype(np.int64), counts)


def steps(pairs: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's pairs in ascending order, as differences (the first as it is): lower and upper halves, of which
    the upper are nearly all zero. A text's score doesn't depend on the order."""
    row = np.repeat(np.arange(len(per_text)), per_text)
    ordered = (row << 32) | pairs
    ordered.sort()
    ordered &= (1 << 32) - 1
    step = np.diff(ordered, prepend=0)
    first = np.cumsum(per_text) - per_text
    step[first] = ordered[first]
    return (step & 0xFFFF).astype("<u2"), (step >> 16).astype("<u2")


def pairs_of(low: np.ndarray, high: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """The pairs of all texts, from ``steps``."""
    step = low.astype(np.int64) + (high.astype(np.int64) << 16)
    total = np.cumsum(step)
    first = np.cumsum(per_text) - per_text
    return total - np.repeat(total[first] - step[first], per_text)


def encoded(docs: DataFrame, shards: int) -> DataFrame:
    """Rows of both kinds: a shard of a block's words (``words``), or (``shard`` null) a document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["block", "shard", "words", "doc_id", "held_out", "low", "high"]

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        waiting, size = [], 0
        for batch in batches:
            for piece in (batch.slice(i, 2000) for i in range(0, batch.num_rows, 2000)):
                waiting.append(piece)
                size += int(sizes_of(texts_of(piece)).sum())
                if size >= BLOCK_BYTES:
                    yield from rows((part << 24) + number, waiting)
                    waiting, size, number = [], 0, number + 1
                    pa.default_memory_pool().release_unused()
        if waiting:
            yield from rows((part << 24) + number, waiting)

    def rows(block: int, waiting: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(waiting).combine_chunks()
        held, ids = table["held_out"].to_numpy(), table["doc_id"].combine_chunks()
        b = encode(table["text"].combine_chunks().cast(pa.string()).fill_null(""), held, shards)
        n = len(held)
        halves = [packed(half, b.per_text) for half in steps(b.pairs, b.per_text)]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, block)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), ids, pa.array(held), *halves], names)
        ends = np.concatenate(([0], np.cumsum(b.per_word)))
        own = np.unique(b.shard)
        for some in (own[i : i + 64] for i in range(0, len(own), 64)):
            values = []
            for s in some.tolist():
                i, j = np.searchsorted(b.shard, (s, s + 1))
                lengths = b.per_word[i:j]
                values.append(to_bytes({"word": b.words.slice(i, j - i), "h": b.hashes[i:j], "contexts": packed(b.contexts[ends[i] : ends[j]], lengths), "counts": packed(b.counts[ends[i] : ends[j]], lengths)}))
            m = len(some)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m, block)), pa.array(some.astype(np.int32)), pa.array(values, pa.binary()), pa.nulls(m, ids.type), pa.nulls(m, pa.bool_()), *[pa.nulls(m, pa.binary())] * 2], names)

    return docs.mapInArrow(blocks, f"block long, shard int, words binary, doc_id {kind}, held_out boolean, low binary, high binary")


# A shard's words over all blocks


def merged(table: pa.Table) -> pa.Table:
    """All blocks' rows of one shard become one: its distinct words' training customers by context (``seats``), and
    for each block which words and contexts it asks for (``asks``). The words' texts are needed no longer."""
    parts = [from_bytes(w) for w in table["words"].to_pylist()]
    sizes = [len(p) for p in parts]
    whole = pa.concat_tables(parts).combine_chunks()
    coded = whole["word"].combine_chunks().dictionary_encode()
    ids = coded.indices.to_numpy().astype(np.int64)
    hashes = np.zeros(len(coded.dictionary), dtype=np.int64)
    hashes[ids] = whole["h"].to_numpy()
    contexts, many = unpacked(whole["contexts"], "<u2")
    counts, _ = unpacked(whole["counts"], "<u4")
    key = np.repeat(ids, many) * CONTEXTS + contexts
    order = np.argsort(key, kind="stable")
    key, counts = key[order], counts[order].astype("<i8")
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    total, key = np.add.reduceat(counts, first), key[first]
    key, total = key[total > 0], total[total > 0]
    per_word = np.bincount(key // CONTEXTS, minlength=len(hashes))
    seats = to_bytes({"h": hashes, "contexts": packed((key % CONTEXTS).astype("<u2"), per_word), "counts": packed(total.astype("<i8"), per_word)})
    sums = per_row(many, np.array(sizes))
    asks = to_bytes({"block": table["block"].combine_chunks(), "ids": packed(ids.astype("<i4"), np.array(sizes)), "many": packed(many.astype("<u2"), np.array(sizes)), "contexts": packed(contexts, sums)})
    return pa.table({"shard": table["shard"].slice(0, 1), "seats": pa.array([seats], pa.binary()), "asks": pa.array([asks], pa.binary())})


# Seating


@dataclass(frozen=True)
class Totals:
    """What all words share: sizes of the restaurants and the discounts. ``tables`` of the parent are
    ``parent_tables``; its customers are the tables of all contexts."""

    customers: np.ndarray
    tables: np.ndarray
    parent_tables: float
    vocabulary: int
    discount: float
    parent_discount: float
    strength: float = 1.0
    parent_strength: float = 1.0

    @property
    def unknown(self) -> float:
        """The parent's probability of one word that nobody has ordered."""
        return (self.parent_strength + self.parent_discount * self.parent_tables) / (self.vocabulary + 1) / (self.parent_strength + self.tables.sum())

    @property
    def back_off(self) -> np.ndarray:
        """Share of each context restaurant that goes to its parent."""
        return (self.strength + self.discount * self.tables) / (self.strength + self.customers)


def draw(key: np.ndarray, step: int) -> np.ndarray:
    """Numbers in [0, 1) by hash."""
    x = key + _times(_A, step)
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) * 2.0**-53


def seat(customers: np.ndarray, opening: np.ndarray, discount: float, key: np.ndarray) -> np.ndarray:
    """Tables that each dish's customers take, one customer after the other; ``opening`` is the weight of a new
    table. From 32 on customers come in parties of an eighth of those seated, and a party opens its expected
    number of tables, rounded at random."""
    tables = (customers > 0).astype(np.float64)
    left = np.flatnonzero(customers > 1)
    seated, step = np.ones(len(left)), 0
    while len(left):
        step += 1
        party = np.minimum(np.where(seated < 32, 1, seated // 8), customers[left] - seated)
        new = opening[left] / (opening[left] + seated - discount * tables[left])
        tables[left] += np.floor(party * new + draw(key[left], step))
        seated = seated + party
        more = customers[left] > seated
        left, seated = left[more], seated[more]
    return tables


@functools.lru_cache(maxsize=4)
def log_stirling(discount: float) -> np.ndarray:
    """``[c, t]``: logarithms of the generalised Stirling numbers up to EXACT customers."""
    out = np.full((EXACT + 1, EXACT + 1), -np.inf)
    out[0, 0] = 0.0
    t = np.arange(1, EXACT + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        for c in range(EXACT):
            stay = np.where(t <= c, np.log(np.maximum(c - discount * t, 1e-300)) + out[c, 1:], -np.inf)
            out[c + 1, 1:] = np.logaddexp(out[c, :-1], stay)
    return out


def seat_anew(customers: np.ndarray, opening: np.ndarray, discount: float, key: np.ndarray) -> np.ndarray:
    """Tables of each dish's customers, drawn given everybody else; ``opening`` is the weight of a new table."""
    tables = (customers > 0).astype(np.float64)
    large = np.flatnonzero(customers > EXACT)
    tables[large] = seat(customers[large], opening[large], discount, key[large])
    some = np.flatnonzero((customers > 1) & (customers <= EXACT))
    some = some[np.argsort(customers[some], kind="stable")]
    log_opening, u, stirling = np.log(opening[some]), draw(key[some], 1), log_stirling(discount)
    sizes, first, times = np.unique(customers[some], return_index=True, return_counts=True)
    for c, i, j in zip(sizes.astype(int).tolist(), first.tolist(), (first + times).tolist(), strict=True):
        for k in range(i, j, max(1, (1 << 20) // c)):
            here = slice(k, min(j, k + max(1, (1 << 20) // c)))
            logs = log_opening[here, None] * np.arange(1, c + 1) + stirling[c, 1 : c + 1]
            share = np.cumsum(np.exp(logs - logs.max(axis=1, keepdims=True)), axis=1)
            tables[some[here]] = 1 + (share < (u[here] * share[:, -1])[:, None]).sum(axis=1)
    return tables


def first_seating(counts: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One table a dish and restaurant."""
    return (counts > 0).astype(np.float64), (many > 0).astype(np.float64), many.astype(np.float64)


def gibbs(hashes: np.ndarray, contexts: np.ndarray, counts: np.ndarray, many: np.ndarray, history: Sequence[Totals]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tables of each (word, context), tables of each word in the parent, and the parent's customers, after a round
    for each of the totals in ``history``."""
    tables, above, parent = first_seating(counts, many)
    row = np.repeat(np.arange(len(many)), many)
    words = hashes.astype(np.uint64)
    for round_, totals in enumerate(history, 1):
        salt = _times(_C, round_)
        # A dish's customers leave a restaurant, and with them the customers that its tables are to the parent.
        others = np.maximum(parent[row] - tables, 0.0)
        base = (totals.parent_strength + totals.parent_discount * np.maximum(totals.parent_tables - (others <= 0), 0.0)) / (totals.vocabulary + 1)
        p = (np.maximum(others - totals.parent_discount * np.minimum(above[row], others), 0.0) + base) / (totals.parent_strength + np.maximum(totals.tables.sum() - tables, 0.0))
        weight = totals.strength + totals.discount * np.maximum(totals.tables[contexts] - tables, 0.0)
        tables = seat_anew(counts, weight * p, totals.discount, (words[row] * _A ^ (contexts.astype(np.uint64) * _B)) + salt)
        parent = np.bincount(row, tables, minlength=len(many))
        free = np.maximum(totals.parent_tables - above, 0.0)
        above = seat_anew(parent, (totals.parent_strength + totals.parent_discount * free) / (totals.vocabulary + 1), totals.parent_discount, words * _A + salt)
    return tables, above, parent


Seats = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def seats_of(value: bytes) -> Seats:
    """Hashes, contexts, counts of a shard's words, and how many contexts each word has."""
    table = from_bytes(value)
    contexts, many = unpacked(table["contexts"], "<u2")
    return table["h"].to_numpy(), contexts, unpacked(table["counts"], "<i8")[0], many


def summed(words: DataFrame, size: int, function: Callable[[Seats], np.ndarray]) -> np.ndarray:
    """Sum over all shards of a vector of ``size`` numbers, which is all that comes to the driver."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(size)
        for batch in batches:
            for value in batch.column("seats").to_pylist():
                out += function(seats_of(value))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(out)], ["at", "n"])

    rows = words.select("seats").mapInArrow(run, "at int, n double").groupBy("at").agg(F.sum("n").alias("n")).collect()
    sums = {r["at"]: r["n"] for r in rows}
    return np.array([sums.get(i, 0.0) for i in range(size)])


def first_totals(words: DataFrame) -> tuple[Totals, int]:
    """Customers, vocabulary, discounts from the numbers of things seen once and twice; and all tokens."""

    def count(seats: Seats) -> np.ndarray:
        _, contexts, counts, many = seats
        rest = [(counts == 1).sum(), (counts == 2).sum(), (many == 1).sum(), (many == 2).sum(), (many > 0).sum(), counts.sum()]
        return np.concatenate((np.bincount(contexts, counts, minlength=CONTEXTS), np.bincount(contexts, minlength=CONTEXTS), rest))

    n = summed(words, 2 * CONTEXTS + 6, count)
    customers, dishes, (one, two, alone, pair, vocabulary, tokens) = n[:CONTEXTS], n[CONTEXTS : 2 * CONTEXTS], n[2 * CONTEXTS :].tolist()
    share = lambda a, b: min(0.95, max(0.1, a / max(1, a + 2 * b)))
    return Totals(customers, dishes, vocabulary, int(vocabulary), share(one, two), share(alone, pair)), int(tokens)


def next_totals(words: DataFrame, history: Sequence[Totals]) -> Totals:
    """The totals after a Gibbs round more over all words."""

    def run(seats: Seats) -> np.ndarray:
        tables, above, _ = gibbs(*seats, history)
        return np.append(np.bincount(seats[1], tables, minlength=CONTEXTS), above.sum())

    n = summed(words, CONTEXTS + 1, run)
    return replace(history[-1], tables=n[:CONTEXTS], parent_tables=n[CONTEXTS])


def predictive(seats: Seats, history: Sequence[Totals], samples: int) -> tuple[np.ndarray, np.ndarray]:
    """Each word's parent probability in each of the last ``samples`` states, and the averaged probability of each
    seated (word, context). ``history``: the totals at first and after each round."""
    _, contexts, counts, many = seats
    row = np.repeat(np.arange(len(many)), many)
    mean, parents = np.zeros(len(counts)), np.zeros((len(many), samples))
    for i, last in enumerate(range(len(history) - samples, len(history))):
        after = history[last]
        tables, above, parent = gibbs(*seats, history[:last])
        base = (after.parent_strength + after.parent_discount * after.parent_tables) / (after.vocabulary + 1)
        parents[:, i] = (parent - after.parent_discount * above + base) / (after.parent_strength + after.tables.sum())
        own = (counts - after.discount * tables) / (after.strength + after.customers)[contexts]
        mean += (own + after.back_off[contexts] * parents[row, i]) / samples
    return parents, mean


# Scores


def answers(words: DataFrame, history: Sequence[Totals], samples: int) -> DataFrame:
    """A row per block and shard: training tokens of each word asked for, how many contexts it was asked in, and the
    log10 probabilities there."""
    back_off = np.array([after.back_off for after in history[-samples:]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, value, asked in zip(*(batch.column(c).to_pylist() for c in ("shard", "seats", "asks")), strict=True):
                yield from answer(shard, seats_of(value), from_bytes(asked))

    def answer(shard: int, seats: Seats, asks: pa.Table) -> Iterator[pa.RecordBatch]:
        parents, mean = predictive(seats, history, samples)
        _, contexts, counts, has = seats
        n = per_row(counts, has)
        keys = np.repeat(np.arange(len(has)), has) * CONTEXTS + contexts
        for block, ids, many, asked in zip(*(asks[c].to_pylist() for c in ("block", "ids", "many", "contexts")), strict=True):
            ids, many, asked = (np.frombuffer(x, dtype=t) for x, t in ((ids, "<i4"), (many, "<u2"), (asked, "<u2")))
            row = np.repeat(ids.astype(np.int64), many)
            p = (back_off[:, asked] * parents[row].T).mean(axis=0)
            key = row * CONTEXTS + asked
            if len(keys):
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = keys[at] == key
                p[hit] = mean[at[hit]]
            values = [n[ids].astype("<i8"), many, np.log10(p).astype("<f4")]
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([shard], pa.int32()), *[pa.array([v.tobytes()], pa.binary()) for v in values]], ["block", "shard", "n", "many", "logs"])

    return words.select("shard", "seats", "asks").mapInArrow(run, "block long, shard int, n binary, many binary, logs binary")


def score(docs: DataFrame, parts: int = 10, part: int = 0, rounds: int = 3, samples: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Rows whose crc32 of the id leaves ``part`` when divided by ``parts`` are held out of learning; a null
    id isn't. Null and empty texts are the end token alone. Repeated rows are learnt from and scored
    each; an empty table gives no rows; other columns are not read."""
    held = F.coalesce(F.crc32(column(id_col).cast("string")) % parts == part, F.lit(False))
    chosen = docs.select(column(id_col).alias("doc_id"), held.alias("held_out"), F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"))
    text_bytes = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    coded = Stored(encoded(chosen, max(1, -(-text_bytes // SHARD_BYTES))), "lm-blocks").frame
    words = Stored(coded.where("shard is not null").select("block", "shard", "words").groupBy("shard").applyInArrow(merged, "shard int, seats binary, asks binary"), "lm-shards").frame
    totals, tokens = first_totals(words)
    history = [totals]
    for _ in range(rounds):
        history.append(next_totals(words, history))
    told = answers(words, history, samples)
    vocabulary = totals.vocabulary
    texts = coded.where("shard is null").select("block", "doc_id", "held_out", "low", "high")
    kind = chosen.schema["doc_id"].dataType.simpleString()

    def add_up(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("shard")
        n, many, logs = (np.frombuffer(b"".join(right[c].to_pylist()), dtype=t) for c, t in (("n", "<i8"), ("many", "<u2"), ("logs", "<f4")))
        logs = logs.astype(np.float64)
        base = np.log10((n + 0.1) / (tokens + 0.1 * (vocabulary + 1)))
        word = np.repeat(np.arange(len(many)), many)
        (low, lengths), (high, _) = (unpacked(left[c], "<u2") for c in ("low", "high"))
        pairs = pairs_of(low, high, lengths)
        own = word[pairs]
        return pa.table(
            {
                "doc_id": left["doc_id"], "held_out": left["held_out"], "n_tokens": lengths, "n_known": per_row((n > 0).astype(np.int64)[own], lengths),
                "train_tokens": np.full(len(lengths), tokens, dtype=np.int64), "base_score": per_text(base[own], lengths), "score": per_text(logs[pairs], lengths),
            }
        )

    out = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return texts.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(add_up, out)


def per_text(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs, each run summed by itself; no run is empty."""
    return np.add.reduceat(values, np.cumsum(lengths) - lengths) if len(lengths) else np.zeros(0)
