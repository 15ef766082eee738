"""Supervised subword embeddings: a quality score for every text.

A text is a bag of features: each word, the word's character n-grams, and two marks, "same as the word
before" and "these three words again in this text". Features are hashed to vectors, the vectors are
averaged, and a softmax over the average gives the label's probability. Vectors and output are
learnt by stochastic gradient descent in numpy.

Learning takes place in one task on a bounded sample: the ``train_rows`` labelled ids with the smallest hash, as
far as their texts come to ``train_bytes`` together. Each text of the sample is used whole, and one for each id. As the output is linear in the average, a fitted
model is one number for each bucket, which is all that scoring needs; its size is fixed by ``buckets``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import column, gather_runs, per_row, run_sums, sizes_of, sliced, texts_of

#: Lengths of the character n-grams; a word is read as ``<word>``.
GRAMS = (3, 4, 5)
BUCKETS = 1 << 18
#: Bytes of text scored at a time.
BATCH_BYTES = 8 << 20
#: Marks, in the first two buckets.
SAME, AGAIN, FIRST_BUCKET = 0, 1, 2

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return (FIRST_BUCKET + ((h >> np.uint64(33)) % np.uint64(buckets - FIRST_BUCKET))).astype(np.int64)


def split_words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words of the texts (between ASCII white space), coded, and how many each text has."""
    for space in ("\n", "\t", "\r", "\x0b", "\x0c"):
        texts = pc.replace_substring(texts, space, " ")
    split = pc.split_pattern(texts, " ")
    words, counts = split.flatten(), np.diff(split.offsets.to_numpy())
    some = pc.greater(pc.binary_length(words), 0)
    flags = some.to_numpy(zero_copy_only=False).astype(np.int64)
    return words.filter(some).dictionary_encode(), per_row(flags, counts)


def word_features(words: pa.Array, buckets: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Buckets of the words and of each length of n-gram; for each, how many a word has."""
    wrapped = pc.binary_join_element_wise(pa.scalar("<"), words, pa.scalar(">"), "")
    lengths = pc.utf8_length(wrapped).to_numpy(zero_copy_only=False).astype(np.int64)
    points = np.frombuffer("".join(wrapped.to_pylist()).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    starts = np.cumsum(lengths) - lengths
    powers = np.concatenate(([np.uint64(1)], np.cumprod(np.full(max(1, int(lengths.max(initial=1))), np.uint64(1000003)))))
    place = np.arange(len(points)) - np.repeat(starts, lengths)
    weighted = (points + np.uint64(1)) * powers[place]
    totals = np.concatenate(([np.uint64(0)], np.cumsum(weighted)))
    whole = totals[starts + lengths] - totals[starts]
    found, counts = [_bucket(whole + np.uint64(77), buckets)], [np.ones(len(lengths), dtype=np.int64)]
    for n in GRAMS:
        many = np.maximum(lengths - n + 1, 0)
        at = gather_runs(starts, many)
        h = np.full(len(at), np.uint64(n))
        for k in range(n):
            h = h * np.uint64(1000003) + points[at + k]
        found.append(_bucket(h, buckets))
        counts.append(many)
    return found, counts


def marks(coded: pa.DictionaryArray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word: whether it equals the one before it; whether the three words from it on have come before."""
    ids = coded.indices.to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(counts)), counts)
    same = np.zeros(len(ids), dtype=bool)
    again = np.zeros(len(ids), dtype=bool)
    if len(ids) > 1:
        same[1:] = (ids[1:] == ids[:-1]) & (row[1:] == row[:-1])
    if len(ids) > 2:
        u = ids.astype(np.uint64)
        h = ((u[:-2] * _MIX + u[1:-1]) * _MIX + u[2:]) * _MIX + row[:-2].astype(np.uint64)
        inside = row[2:] == row[:-2]
        first = np.zeros(len(h), dtype=bool)
        first[np.unique(h, return_index=True)[1]] = True
        again[:-2] = inside & ~first
    return same, again


def scores(texts: pa.Array, values: np.ndarray, bias: float) -> np.ndarray:
    """Probability of label 1 for each text."""
    coded, counts = split_words(texts)
    found, many = word_features(coded.dictionary, len(values))
    total = sum(run_sums(values[f], c) for f, c in zip(found, many, strict=True))
    number = sum(many)
    ids = coded.indices.to_numpy()
    same, again = marks(coded, counts)
    words = total[ids] + same * values[SAME] + again * values[AGAIN]
    features = number[ids] + same + again
    logit = run_sums(words, counts) / np.maximum(per_row(features, counts), 1) + bias
    return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def train(texts: pa.Array, labels: np.ndarray, buckets: int, width: int, epochs: int, rate: float, seed: int) -> tuple[np.ndarray, float]:
    """One number a bucket and a bias, from stochastic gradient descent on vectors and softmax output."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / width, 1 / width, (buckets, width)).astype(np.float32)
    out, bias = np.zeros((2, width), dtype=np.float32), np.zeros(2, dtype=np.float32)
    coded, counts = split_words(texts)
    found, many = word_features(coded.dictionary, buckets)
    starts = [np.cumsum(c) - c for c in many]
    same, again = marks(coded, counts)
    ids = coded.indices.to_numpy().astype(np.int64)
    ends = np.cumsum(counts)
    bags = []
    for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True):
        own = ids[a:b]
        parts = [f[gather_runs(s[own], c[own])] for f, s, c in zip(found, starts, many, strict=True)]
        parts += [np.full(int(same[a:b].sum()), SAME), np.full(int(again[a:b].sum()), AGAIN)]
        bucket, n = np.unique(np.concatenate(parts), return_counts=True)
        bags.append((bucket.astype(np.int32), (n / max(1, n.sum())).astype(np.float32)))
    steps, done = epochs * len(bags), 0
    for _ in range(epochs):
        for i in rng.permutation(len(bags)):
            bucket, share = bags[i]
            step = rate * (1 - done / steps)
            done += 1
            hidden = share @ vectors[bucket]
            logits = out @ hidden + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[int(labels[i])] -= 1
            back = p @ out
            out -= step * np.outer(p, hidden)
            bias -= step * p
            vectors[bucket] -= (step * share)[:, None] * back
    return (vectors @ (out[1] - out[0])).astype(np.float64), float(bias[1] - bias[0])


def fit(docs: DataFrame, labelled: DataFrame, train_rows: int, train_bytes: int, buckets: int, width: int, epochs: int, rate: float, seed: int, id_col: str, text_col: str) -> tuple[np.ndarray, float]:
    """``labelled``: doc_id, label (0 or 1), the rows to learn from."""
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = labelled.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(*order).limit(train_rows)
    texts = docs.select(column(id_col).alias("doc_id"), F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"))
    # Sizes first: at most train_rows of them are summed up in one task, and no text that is left out travels. Both
    # lists of ids have at most train_rows rows, so they are sent to the texts.
    sized = texts.select("doc_id", F.octet_length("text").alias("bytes")).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.max("bytes").alias("bytes"))
    so_far = F.sum("bytes").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    within = sized.withColumn("so_far", so_far).where(F.col("so_far") <= train_bytes).select("doc_id", "label")
    # One text an id, however often the id is repeated.
    sample = texts.join(F.broadcast(within), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")).orderBy("doc_id").coalesce(1)

    def learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if got:
            table = pa.Table.from_batches(got)
            values, bias = train(table["text"].combine_chunks().cast(pa.string()), table["label"].to_numpy(), buckets, width, epochs, rate, seed)
            yield pa.RecordBatch.from_arrays([pa.array([values.astype("<f4").tobytes()], pa.binary()), pa.array([bias])], ["values", "bias"])

    row = sample.select("text", F.col("label").cast("int").alias("label")).mapInArrow(learn, "values binary, bias double").first()
    if row is None:
        return np.zeros(buckets), 0.0
    return np.frombuffer(row["values"], dtype="<f4").astype(np.float64), row["bias"]


def held_out_of(doc_id: Column, parts: int = 4, part: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, label_col: str = "quality", threshold: float = 0.7, train_rows: int = 6000, train_bytes: int = 64 << 20, buckets: int = BUCKETS, width: int = 16, epochs: int = 10, rate: float = 2.0, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Rows whose crc32 of the id leaves 2 when divided by 4 are held out of learning. Null and empty texts
    have no features and get the bias's score; a null id isn't held out; labels that are null or neither
    0 nor 1, or without a document, teach nothing; without any label every score is 0.5. Repeated rows
    give a row each, with equal scores for equal texts, and an id that is repeated teaches once; other columns are not read."""
    known = labels.select(column(label_id_col).alias("doc_id"), column(label_col).cast("int").alias("label"))
    values, bias = fit(docs, known.where(~held_out_of(F.col("doc_id"))), train_rows, train_bytes, buckets, width, epochs, rate, seed, id_col, text_col)
    model = docs.sparkSession.sparkContext.broadcast((values.astype(np.float32), bias))
    chosen = docs.select(column(id_col).alias("doc_id"), held_out_of(column(id_col)).alias("held_out"), F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, offset = model.value
        numbers = numbers.astype(np.float64)
        for batch in batches:
            texts = texts_of(batch)
            got = [scores(texts.slice(a, b - a), numbers, offset) for a, b in sliced(sizes_of(texts), BATCH_BYTES)]
            p = np.concatenate(got) if got else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return chosen.mapInArrow(score, f"doc_id {kind}, held_out boolean, score double, predicted int")
