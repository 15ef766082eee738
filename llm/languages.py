"""Language of a text: known words first, then ever shorter character n-grams.

A word is a run of letters and the marks on them, lower-cased. A word seen in learning is scored by the logarithm of its
frequency in each language. An unseen word falls back to its n-grams of five characters (the word being read as
``<word>``), scored the same way; if none of them was seen either, to four, and so on to one. A word that has nothing
known in it says nothing. A text's evidence is the mean over its words times the square root of their number, as
words of one text are not independent; with the languages' shares of all training rows that makes the posterior.

Learning uses a bounded sample: of each language the training rows with the smallest hash of id and text, whole, until
its part of ``train_rows`` or of ``train_bytes`` is used up (by 64ths, of which the first is always taken). So the model that is sent to the tasks is bounded by
``train_bytes``, however many documents there are. Spark counts words and n-grams; frequencies are made of the counts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import column, gather_runs, one_array, sizes_of, sliced, texts_of

#: Lengths of n-grams in the order in which an unseen word tries them.
GRAMS = (5, 4, 3, 2, 1)
#: Added to every count.
SMALL = 0.1
#: Bytes of text worked on at a time.
BATCH_BYTES = 2 << 20
#: Parts that a language's quota of training rows is taken in.
SHARES = 64
UNKNOWN = "und"
NO_LETTERS = r"[^\p{L}\p{M}]+"

_P, _MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


def words_of(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words, coded, and how many each text has."""
    split = pc.split_pattern(pc.replace_substring_regex(pc.utf8_lower(texts), NO_LETTERS, " "), " ")
    words, counts = split.flatten(), np.diff(split.offsets.to_numpy()).astype(np.int64)
    some = pc.greater(pc.binary_length(words), 0)
    row = np.repeat(np.arange(len(counts)), counts)[some.to_numpy(zero_copy_only=False)]
    return words.filter(some).dictionary_encode(), np.bincount(row, minlength=len(counts))


def grams_of(words: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of all words, one word after the other, and how many each word has."""
    wrapped = pc.binary_join_element_wise(pa.scalar("<"), words, pa.scalar(">"), "")
    lengths = pc.utf8_length(wrapped).to_numpy(zero_copy_only=False).astype(np.int64)
    points = np.frombuffer("".join(wrapped.to_pylist()).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    many = np.maximum(lengths - n + 1, 0)
    at = gather_runs(np.cumsum(lengths) - lengths, many)
    h = np.full(len(at), np.uint64(n))
    for k in range(n):
        h = (h ^ (points[at + k] + np.uint64(1))) * _MIX
        h ^= h >> np.uint64(31)
    return (h * _P).view(np.int64), many


def counted(words: pa.DictionaryArray) -> Iterator[tuple[int, pa.Array, np.ndarray, np.ndarray]]:
    """(n, words, hashes, counts) of the words (n = 0, hashes zero) and of each length of n-gram (words null)."""
    seen = np.bincount(words.indices.to_numpy(), minlength=len(words.dictionary))
    distinct = words.dictionary.cast(pa.string())
    yield 0, distinct, np.zeros(len(distinct), dtype=np.int64), seen
    for n in GRAMS:
        hashes, many = grams_of(distinct, n)
        values, back = np.unique(hashes, return_inverse=True)
        yield n, pa.nulls(len(values), pa.string()), values, np.bincount(back, np.repeat(seen, many), minlength=len(values)).astype(np.int64)


@dataclass
class Table:
    """Log frequencies by language of the entries of one kind: those that differ from ``rest``, the row of a
    language in which the entry was not seen."""

    keys: pa.Array | np.ndarray
    begin: np.ndarray
    language: np.ndarray
    log: np.ndarray
    rest: np.ndarray

    @cached_property
    def places(self) -> pd.Index:
        """Hashed once in a worker, when the first text is answered."""
        return pd.Index(self.keys.to_pylist(), dtype=object)

    def of(self, entries: np.ndarray) -> np.ndarray:
        out = np.tile(self.rest, (len(entries), 1))
        begin = self.begin[entries].astype(np.int64)
        many = self.begin[entries + 1] - begin
        at = gather_runs(begin, many)
        out[np.repeat(np.arange(len(entries)), many), self.language[at]] = self.log[at]
        return out


@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray
    words: Table
    grams: dict[int, Table]

    def word_scores(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """A row of log frequencies per word, and whether the word says anything."""
        out = np.zeros((len(words), len(self.languages)))
        at = self.words.places.get_indexer(np.array(words.to_pylist(), dtype=object))
        known = at >= 0
        out[known] = self.words.of(at[known])
        left = np.flatnonzero(~known)
        for n in GRAMS:
            table = self.grams[n]
            if not len(left) or not len(table.keys):
                continue
            hashes, many = grams_of(words.take(pa.array(left)), n)
            at = np.minimum(np.searchsorted(table.keys, hashes), len(table.keys) - 1)
            hit = table.keys[at] == hashes
            row = np.repeat(np.arange(len(left)), many)[hit]
            found, first, times = np.unique(row, return_index=True, return_counts=True)
            if len(found):
                out[left[found]] = np.add.reduceat(table.of(at[hit]), first, axis=0) / times[:, None]
                known[left[found]] = True
                left = np.delete(left, found)
        return out, known

    def predict(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of the language of each text, and its posterior; -1 and 0 for a text without letters."""
        letters = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
        best, score = np.full(len(texts), -1), np.zeros(len(texts))
        if not self.languages:
            return best, score
        coded, counts = words_of(texts)
        logs, known = self.word_scores(coded.dictionary.cast(pa.string()))
        ids = coded.indices.to_numpy()
        row = np.repeat(np.arange(len(texts)), counts)
        says = known[ids]
        ids, row = ids[says], row[says]
        filled, first, many = np.unique(row, return_index=True, return_counts=True)
        evidence = np.tile(self.prior, (len(texts), 1))
        if len(filled):
            for k in range(len(self.languages)):
                evidence[filled, k] += np.add.reduceat(logs[ids, k], first) / np.sqrt(many)
        evidence -= evidence.max(axis=1, keepdims=True)
        share = np.exp(evidence)
        share /= share.sum(axis=1, keepdims=True)
        best[letters] = share.argmax(axis=1)[letters]
        score[letters] = share.max(axis=1)[letters]
        return best, score


def table_of(keys: np.ndarray, language: np.ndarray, count: np.ndarray, languages: int, as_text: bool) -> Table:
    """``keys``: which entry each (entry, language, count) is of; sorted by entry and language."""
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, dtype=np.int64)
    whole = np.bincount(language, count, minlength=languages) + SMALL * (len(first) + 1)
    entries = keys[first]
    logs = np.log((count + SMALL) / whole[language]).astype(np.float32)
    return Table(pa.array(entries, pa.string()) if as_text else entries, np.append(first, len(keys)).astype(np.int32), language.astype(np.int32), logs, np.log(SMALL / whole))


def fit(docs: DataFrame, train_rows: int, train_bytes: int) -> Model:
    """``docs``: training rows as (key, lang, text)."""
    rows = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    rows_each, bytes_each = max(1, train_rows // max(1, len(rows))), train_bytes // max(1, len(rows))
    spark = docs.sparkSession
    # A share of a language's rows holds rows_each / SHARES of them, however many there are: the hash of a row says which.
    scale = spark.createDataFrame([(lang, SHARES * n / rows_each) for lang, n in rows.items()], "lang string, scale double")
    share = F.floor((F.col("key") / 2.0**64 + 0.5) * F.col("scale")).alias("share")
    told = docs.join(F.broadcast(scale), "lang").select("lang", "key", share, "text")
    once = told.where(F.col("share") < 4 * SHARES).groupBy("lang", "share", "key").agg(F.min(F.octet_length("text")).alias("bytes"))
    last: dict[str, int] = {}
    used: dict[str, tuple[int, int]] = {}
    for r in once.groupBy("lang", "share").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).orderBy("lang", "share").collect():
        n, size = used.get(r["lang"], (0, 0))
        used[r["lang"]] = n, size = n + r["n"], size + r["bytes"]
        if r["lang"] not in last or (n <= rows_each and size <= bytes_each):
            last[r["lang"]] = r["share"]
    cut = spark.createDataFrame(list(last.items()), "lang string, last long")
    sample = told.join(F.broadcast(cut), "lang").where(F.col("share") <= F.col("last")).groupBy("lang", "key").agg(F.first("text").alias("text"))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch)
            langs = one_array(batch.column("lang"))
            for a, b in sliced(sizes_of(texts), BATCH_BYTES):
                part, own = texts.slice(a, b - a), langs.slice(a, b - a)
                for lang in pc.unique(own).to_pylist():
                    coded, _ = words_of(part.filter(pc.equal(own, lang)))
                    for n, words, hashes, counts in counted(coded):
                        yield pa.RecordBatch.from_arrays([pa.array([n] * len(counts), pa.int32()), pa.array([lang] * len(counts), pa.string()), words, pa.array(hashes), pa.array(counts, pa.int64())], ["n", "lang", "word", "h", "count"])

    counts = sample.select("lang", "text").mapInArrow(count, "n int, lang string, word string, h long, count long").groupBy("n", "lang", "word", "h").agg(F.sum("count").alias("count")).toArrow()
    languages = sorted(pc.unique(counts["lang"]).to_pylist())
    number = {lang: i for i, lang in enumerate(languages)}
    tables = {}
    for n in (0, *GRAMS):
        own = counts.filter(pc.equal(counts["n"], n)).sort_by([("word", "ascending"), ("h", "ascending"), ("lang", "ascending")])
        language = np.array([number[x] for x in own["lang"].to_pylist()], dtype=np.int64)
        keys = own["h"].to_numpy() if n else np.array(own["word"].to_pylist(), dtype=object)
        tables[n] = table_of(keys, language, own["count"].to_numpy(), len(languages), as_text=not n)
    seen = np.array([rows[x] for x in languages], dtype=float)
    return Model(languages, np.log(seen / seen.sum()) if languages else seen, tables.pop(0), tables)


def identify(docs: DataFrame, parts: int = 4, part: int = 2, train_rows: int = 16_000, train_bytes: int = 32 << 20, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score.

    Learns from the text and the non-null language of rows whose crc32 of the id does not leave ``part``
    when divided by ``parts``; a null id is not held out. ``score`` is the posterior of ``lang_pred``. A null text and one
    without a letter are ``und`` with score 0, as is every text if there is nothing to learn from; languages whose
    training texts have no word are not learnt. Equal texts get equal answers; repeated rows are answered each and
    learnt from once; a tie goes to the language that sorts first; an empty table gives no rows; other columns are not
    read."""
    own = column(id_col)
    held = F.coalesce(F.crc32(own.cast("string")) % parts == part, F.lit(False))
    chosen = docs.select(own.alias("doc_id"), held.alias("held_out"), column(text_col).cast("string").alias("text"), column(lang_col).cast("string").alias("lang"))
    train = chosen.where(~F.col("held_out") & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.xxhash64(F.col("doc_id").cast("string"), "text").alias("key"), "lang", "text")
    model = docs.sparkSession.sparkContext.broadcast(fit(train, train_rows, train_bytes))
    kind = chosen.schema["doc_id"].dataType.simpleString()

    def answer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array([*model.value.languages, UNKNOWN], pa.string())
        for batch in batches:
            texts = texts_of(batch)
            for a, b in sliced(sizes_of(texts), BATCH_BYTES):
                best, score = model.value.predict(texts.slice(a, b - a))
                told = names.take(pa.array(np.where(best < 0, len(names) - 1, best)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), batch.column("held_out").slice(a, b - a), told, pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])
            pa.default_memory_pool().release_unused()

    return chosen.select("doc_id", "held_out", "text").mapInArrow(answer, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
