"""Benchmark decontamination with one Aho-Corasick automaton.

The items (questions and answers) are normalised to lower-case words; every ten consecutive words
of an item, or all of a shorter one, is a pattern. A document is normalised the same way and scanned
once; matches are mapped back to words and to places in the original text.

The item table is a benchmark, not a corpus: it is read whole up to ``max_items_bytes`` of text,
the documented bound; beyond it the items are scanned in blocks of that size, one automaton after
the other, so that none is left out.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import column, ids_and_texts, one_array

#: Bytes that are no part of a word become spaces, letters lower case; bytes over 0x7F are word bytes.
_NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


class Matcher:
    """Aho-Corasick over the windows of a block of items, words joined by spaces."""

    def __init__(self, items: tuple[tuple[str, bytes], ...], window: int):
        import ahocorasick

        owners: dict[bytes, set[str]] = {}
        for item, text in items:
            words = normal_words(text)
            for i in range(max(1, len(words) - window + 1) if words else 0):
                owners.setdefault(b" " + b" ".join(words[i : i + window]) + b" ", set()).add(item)
        self._automaton = ahocorasick.Automaton()
        for pattern, names in owners.items():
            # One character a byte: bytes of UTF-8 match as they stand.
            self._automaton.add_word(pattern.decode("latin-1"), (len(pattern), pattern.count(b" ") - 1, frozenset(names)))
        self._some = bool(owners)
        if self._some:
            self._automaton.make_automaton()

    def find(self, joined: str) -> list[tuple[int, int, int, frozenset[str]]]:
        """(begin, end, words, items) of the matches in `` w1 w2 ... ``."""
        if not self._some:
            return []
        return [(end + 1 - size, end + 1, n, names) for end, (size, n, names) in self._automaton.iter(joined)]


@functools.lru_cache(maxsize=4)
def _matcher(items: tuple[tuple[str, bytes], ...], window: int) -> Matcher:
    return Matcher(items, window)


def item_blocks(items: DataFrame, item_col: str, text_col: str, max_items_bytes: int) -> list[list[tuple[str, bytes]]]:
    """The items in blocks of at most about ``max_items_bytes``; equal texts of an item once, null texts none."""
    rows = items.select(column(item_col).cast("string").alias("item"), column(text_col).cast("string").alias("text")).where("item is not null and text is not null").distinct()
    blocks: list[list[tuple[str, bytes]]] = []
    size = max_items_bytes
    for row in rows.sort("item", "text").toLocalIterator():
        text = row["text"].encode()
        if size >= max_items_bytes:
            blocks.append([])
            size = 0
        blocks[-1].append((row["item"], text))
        size += len(text)
    return blocks


def scan(text: bytes, matchers: list[Matcher]) -> tuple[int, np.ndarray, list[str]]:
    """Words of a text, a flag for each word inside a match, and the items found, sorted."""
    words = normal_words(text)
    joined = (b" " + b" ".join(words) + b" ").decode("latin-1") if words else ""
    hit, names, starts = np.zeros(len(words), dtype=bool), set(), None
    for matcher in matchers:
        for begin, _, n, found in matcher.find(joined) if words else ():
            if starts is None:
                starts = np.cumsum([0, *(len(w) + 1 for w in words)])[:-1]
            at = int(np.searchsorted(starts, begin))
            hit[at : at + n] = True
            names |= found
    return len(words), hit, sorted(names)


def spans_of(text: bytes, hit: np.ndarray) -> list[tuple[int, int]]:
    """Code-point spans of the hit words' runs in the original text."""
    if not hit.any():
        return []
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))).reshape(-1, 2)
    places = [m.span() for m in _WORD.finditer(text)]
    return [(len(text[: places[a][0]].decode()), len(text[: places[b - 1][1]].decode())) for a, b in edges.tolist()]


def _broadcast(docs: DataFrame, items: DataFrame, item_col: str, text_col: str, max_items_bytes: int):
    blocks = item_blocks(items, item_col, text_col, max_items_bytes)
    return docs.sparkSession.sparkContext.broadcast([tuple(b) for b in blocks])


def _matchers(blocks, window: int) -> list[Matcher]:
    return [_matcher(block, window) for block in blocks.value]


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, max_items_bytes: int = 16 << 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items
    (sorted as strings) and spans (begin and end in code points of the text as given).

    Null and empty texts have no words and no hit; items without words, text or id have no window;
    repeated rows give a row each; other columns are not read. No shuffle."""
    blocks = _broadcast(docs, items, item_col, item_text_col, max_items_bytes)
    chosen = ids_and_texts(docs, id_col, text_col)
    kind = chosen.schema["doc_id"].dataType.simpleString()
    span = pa.struct([("begin", pa.int64()), ("end", pa.int64())])

    def match(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matchers = _matchers(blocks, window)
        for batch in batches:
            n_words, n_hit, names, spans = [], [], [], []
            for data in one_array(batch.column("text")).cast(pa.binary()).to_pylist():
                n, hit, found = scan(data, matchers)
                n_words.append(n)
                n_hit.append(int(hit.sum()))
                names.append(found)
                spans.append([{"begin": a, "end": b} for a, b in spans_of(data, hit)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array([len(x) for x in names], pa.int64()), pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in names], pa.string()), pa.array([n > 0 for n in n_hit], pa.bool_()), pa.array(names, pa.list_(pa.string())), pa.array(spans, pa.list_(span))],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items", "spans"],
            )

    return chosen.mapInArrow(match, f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<string>, spans array<struct<begin:long,end:long>>")


def without_contaminated(docs: DataFrame, items: DataFrame, window: int = 10, max_items_bytes: int = 16 << 20, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a window of an item; columns as given, no shuffle."""
    blocks = _broadcast(docs, items, item_col, item_text_col, max_items_bytes)
    at = docs.columns.index(text_col)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matchers = _matchers(blocks, window)
        for batch in batches:
            texts = one_array(batch.column(at)).cast(pa.binary()).to_pylist()
            yield batch.filter(pa.array([not scan(t or b"", matchers)[1].any() for t in texts], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
