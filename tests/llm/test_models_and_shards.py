"""Classifier, language model and shards."""

from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter

import numpy as np
from tests.llm.fixtures import WORD, awkward, empty, frame, lower_ascii, prose

from llm.classifier import classify
from llm.pitman_yor import CONTEXTS, Totals, first_totals, pairs_of, seat, seat_anew, steps
from llm.pitman_yor import score as lm_score
from llm.sharding import hilbert_index, shard, text_cells, write_shards


def labelled(spark):
    texts = [(i, prose(i, 60)) for i in range(120)] + [(1000 + i, " ".join(w.upper() + "!!" for w in prose(i, 60).split())) for i in range(120)]
    labels = [(i, int(i < 1000)) for i, _ in texts] + [(None, 1), (5, None), (9999, 0), (6, 7)]
    return frame(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int")


def test_classifier_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    got = classify(docs, labels, epochs=4, buckets=1 << 14).collect()
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {r["doc_id"] for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2} and held
    assert all((r["score"] >= 0.7) == (r["predicted"] == 1) for r in got)
    assert np.mean([(r["score"] > 0.5) == (r["doc_id"] < 1000) for r in held]) > 0.97


def test_classifier_does_not_read_held_out_labels(spark):
    docs, labels = labelled(spark)
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 4 = 2, 1 - quality, quality) as quality")
    a, b = (sorted((r["doc_id"], r["score"]) for r in classify(docs, x, epochs=1, buckets=1 << 12).collect()) for x in (labels, flipped))
    assert a == b


def test_classifier_on_awkward_rows(spark):
    _, labels = labelled(spark)
    rows = classify(frame(spark), labels, epochs=1, buckets=1 << 12).collect()
    assert len(rows) == len(awkward()) and all(0 <= r["score"] <= 1 for r in rows)
    assert classify(empty(spark), labels).count() == 0
    assert {r["score"] for r in classify(frame(spark), labels.limit(0), buckets=1 << 12).collect()} == {0.5}


def test_classifier_learns_from_a_bounded_sample(spark):
    """A repeated id teaches once; a text beyond the bound teaches nothing, as if it had no label."""
    from pyspark.sql import functions as F

    docs, labels = labelled(spark)
    once = sorted((r["doc_id"], r["score"]) for r in classify(docs, labels, epochs=1, buckets=1 << 12).collect())
    again = docs.where("doc_id = 7").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(300)))).drop("n")
    hot = classify(docs.union(again), labels, epochs=1, buckets=1 << 12)
    assert sorted({(r["doc_id"], r["score"]) for r in hot.collect()}) == once
    assert {r["score"] for r in classify(docs, labels, train_bytes=10, buckets=1 << 12).collect()} == {0.5}


def test_equal_texts_score_alike(spark):
    docs, labels = labelled(spark)
    many = docs.union(docs).union(docs).repartition(5)
    by_text = {}
    for r in classify(many, labels, epochs=1, buckets=1 << 12).collect():
        by_text.setdefault(r["doc_id"], set()).add(r["score"])
    assert all(len(x) == 1 for x in by_text.values())


def test_language_model_counts(spark):
    texts = awkward()
    rows = lm_score(frame(spark, texts), rounds=2, samples=1).collect()
    tokens = [[*WORD.findall(lower_ascii(t or "")), ""] for _, t in texts]
    held = [i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in texts]
    c = Counter(w for ws, h in zip(tokens, held) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    expected = sorted((str(i), h, len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 6)) for (i, _), h, ws in zip(texts, held, tokens))
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows) == expected
    assert all(r["score"] < 0 for r in rows)
    assert lm_score(empty(spark)).count() == 0


def test_predictive_probabilities_sum_to_one(spark):
    from pyspark.sql import functions as F

    from llm.pitman_yor import encoded, merged, next_totals, predictive, seats_of

    docs = frame(spark, [(i, prose(i, 50)) for i in range(1, 9)]).select("doc_id", F.lit(False).alias("held_out"), "text")
    words = encoded(docs, 5).where("shard is not null").groupBy("shard").applyInArrow(merged, "shard int, seats binary, asks binary").cache()
    before, tokens = first_totals(words)
    history = [before, next_totals(words, [before])]
    history.append(next_totals(words, history))
    after = history[-1]
    assert tokens == 8 * 51 == before.customers.sum()
    shards = [seats_of(r["seats"]) for r in words.collect()]
    assert len(shards) > 1
    made = [predictive(s, history, 1) for s in shards]
    assert abs(sum(parents.sum() for parents, _ in made) + after.unknown - 1) < 1e-9
    for u in np.flatnonzero(after.customers).tolist():
        if after.customers[u]:
            total = after.back_off[u]
            for (_, contexts, _, many), (parents, mean) in zip(shards, made):
                row = np.repeat(np.arange(len(many)), many)
                total += mean[contexts == u].sum() - after.back_off[u] * parents[row[contexts == u]].sum()
            assert abs(total - 1) < 1e-9


def test_drawn_tables_have_their_conditional_distribution():
    """Against all seatings of a few customers, each weighted by the restaurant's rule."""
    for c, a, d in ((2, 0.3, 0.5), (5, 0.7, 0.3), (6, 0.05, 0.8)):
        weight = {(): 1.0}
        for _ in range(c):
            grown: dict[tuple, float] = {}
            for sizes, w in weight.items():
                grown[(*sizes, 1)] = grown.get((*sizes, 1), 0) + w * a
                for k, n in enumerate(sizes):
                    more = (*sizes[:k], n + 1, *sizes[k + 1 :])
                    grown[more] = grown.get(more, 0) + w * (n - d)
            weight = grown
        whole = sum(weight.values())
        exact = [sum(w for s, w in weight.items() if len(s) == t) / whole for t in range(1, c + 1)]
        key = np.arange(60_000, dtype=np.uint64) * np.uint64(7919)
        drawn = seat_anew(np.full(60_000, c), np.full(60_000, a), d, key)
        assert np.abs(np.bincount(drawn.astype(int), minlength=c + 1)[1:] / 60_000 - exact).max() < 0.01
    few = seat_anew(np.array([0, 1, 300, 256]), np.full(4, 0.2), 0.5, np.arange(4, dtype=np.uint64))
    assert few[0] == 0 and few[1] == 1 and 1 <= few[2] <= 300 and 1 <= few[3] <= 256


def test_word_order_counts(spark):
    """A held-out text in the order of the training texts scores far better than its words shuffled."""
    import random

    r = random.Random(1)
    words = [f"word{k}longer" for k in range(150)]
    held = next(i for i in range(10_000) if zlib.crc32(str(i).encode()) % 10 == 0)
    mixed = r.sample(words, 150)
    texts = [(i, " ".join(words[i % 50 : i % 50 + 100])) for i in range(20_000, 20_600)]
    docs = spark.createDataFrame([*texts, (held, " ".join(words[:100])), (held, " ".join(w for w in mixed if w in words[:100]))], "doc_id long, text string")
    straight, shuffled = sorted((x["score"] for x in lm_score(docs).where(f"doc_id = {held}").collect()), reverse=True)
    base = lm_score(docs).where(f"doc_id = {held}").first()["base_score"]
    assert straight > -60 and shuffled < base + 30 and straight - shuffled > 120


def test_steps_and_back():
    r = np.random.default_rng(1)
    lengths = np.array([1, 5, 300, 1])
    pairs = r.integers(0, 1 << 22, lengths.sum())
    back = pairs_of(*steps(pairs, lengths), lengths)
    ends = np.cumsum(lengths)
    for a, b in zip(ends - lengths, ends):
        assert sorted(pairs[a:b].tolist()) == back[a:b].tolist()


def test_seats():
    c = np.array([0, 1, 2, 40, 10_000])
    key = np.arange(5, dtype=np.uint64) * np.uint64(7919)
    tables = seat(c, np.full(5, 0.5), 0.5, key)
    assert tables[0] == 0 and tables[1] == 1 and (tables <= np.maximum(c, 0)).all() and (np.diff(tables) >= 0).all()
    mean = np.mean([seat(np.array([5]), np.array([0.5]), 0.5, np.array([k * 7919], dtype=np.uint64))[0] for k in range(4000)])
    # Exact expectation by following the distribution over numbers of tables.
    p = {1: 1.0}
    for seated in range(1, 5):
        q: dict[int, float] = {}
        for t, x in p.items():
            new = 0.5 / (0.5 + seated - 0.5 * t)
            q[t + 1] = q.get(t + 1, 0) + x * new
            q[t] = q.get(t, 0) + x * (1 - new)
        p = q
    assert abs(mean - sum(t * x for t, x in p.items())) < 0.06
    assert Totals(np.zeros(CONTEXTS), np.zeros(CONTEXTS), 0.0, 0, 0.5, 0.5).unknown == 1.0


def test_hilbert_curve_is_a_walk():
    for dims, bits in ((2, 3), (3, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        order = hilbert_index([cells[:, k] for k in range(dims)], bits)
        assert sorted(order.tolist()) == list(range(len(cells)))
        steps = np.abs(np.diff(cells[np.argsort(order)], axis=0)).sum(axis=1)
        assert (steps == 1).all()


def test_shards(spark, tmp_path):
    rows = shard(frame(spark), shards=8).collect()
    expected = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in awkward())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == expected
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) <= set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n))
    assert shard(empty(spark)).count() == 0
    docs = frame(spark, [(i, prose(i, 20)) for i in range(30)])
    write_shards(docs, str(tmp_path / "out"), shards=3)
    assert spark.read.parquet(str(tmp_path / "out")).groupBy("shard").count().where("count = 10").count() == 3


def test_written_shards_have_every_row_once(spark, tmp_path):
    docs = frame(spark, awkward() + [(7, prose(3, 200))] * 5 + [(None, None)] * 3)
    write_shards(docs, str(tmp_path / "out"), shards=4)
    written = spark.read.parquet(str(tmp_path / "out"))
    key = lambda df: sorted(map(str, df.select(*docs.columns).collect()))
    assert key(written) == key(docs)
    assert max(r["count"] for r in written.groupBy("shard").count().collect()) <= -(-docs.count() // 4)


def test_long_values_of_one_prefix_are_told_apart(spark):
    """Each shard holds few of the sources, though they begin alike; one of them has a third of all rows."""
    names = [f"common-crawl-{k % 16 if k % 3 else 0}" for k in range(1600)]
    docs = spark.createDataFrame([(k, prose(k % 40, 5) + f" {k}", names[k]) for k in range(1600)], "doc_id long, text string, source string")
    rows = shard(docs, dimensions=("source",), shards=16).join(docs.select("doc_id", "source"), "doc_id").collect()
    held = [len({r["source"] for r in rows if r["shard"] == s}) for s in range(16)]
    assert sum(held) / 16 <= 5
    cut = {r["cell"] for r in text_cells(docs, "source", 16).collect()}
    assert len(cut) >= 10


def test_cells_of_texts(spark):
    rows = [None] * 4 + ["a" * 60 + "1"] * 4 + ["a" * 60 + "2"] * 4 + ["b"] * 4
    found = {r["key"]: r["cell"] for r in text_cells(spark.createDataFrame([(x,) for x in rows], "s string"), "s", 4).collect()}
    assert sorted(found.values()) == [0, 1, 2, 3] and found[""] == 0
