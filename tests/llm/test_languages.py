"""Answers against a plain model, the order of falling back, and held-out accuracy."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import pytest
from tests.llm.fixtures import CLASHING, awkward, empty, frame, rows, SCHEMA

from llm.languages import GRAMS, SMALL, identify

WORD = re.compile(r"[^\W\d_]+")
EN = ["the river runs over the stones", "a house in the garden", "the quiet morning light", "what a winter it was", "the stones in the garden"]
DE = ["der Fluss fließt über die Steine", "ein Haus in dem Garten", "das stille Licht am Morgen", "was für ein Winter es war", "die Steine in dem Garten"]


def held(i) -> bool:
    return i is not None and zlib.crc32(str(i).encode()) % 4 == 2


def corpus(n=40):
    return [(i, (EN if i % 2 else DE)[i // 2 % 5], "en" if i % 2 else "de") for i in range(n)]


def docs(spark, texts):
    return spark.createDataFrame([(i, t, lang, None, None, *["x"] * len(CLASHING)) for i, t, lang in texts], SCHEMA)


def plain(texts):
    """Every training row once an id, words and n-grams counted in dictionaries."""
    train = [(t, lang) for i, t, lang in dict.fromkeys(texts) if not held(i) and t is not None and lang is not None]
    langs = sorted({lang for t, lang in train if WORD.search(t)})
    counts = {n: {lang: Counter() for lang in langs} for n in (0, *GRAMS)}
    cut = lambda w, n: [f"<{w}>"[k : k + n] for k in range(len(w) + 3 - n)]
    for t, lang in train:
        for w in WORD.findall(t.lower()):
            counts[0][lang][w] += 1
            for n in GRAMS:
                counts[n][lang].update(cut(w, n))
    log = {}
    for n, by_lang in counts.items():
        known = set().union(*by_lang.values())
        for lang, c in by_lang.items():
            whole = sum(c.values()) + SMALL * (len(known) + 1)
            log[n, lang] = {k: math.log((c[k] + SMALL) / whole) for k in known}
    rows_of = Counter(lang for i, t, lang in texts if not held(i) and t is not None and lang is not None)
    out = []
    for i, t, _ in texts:
        if t is None or not WORD.search(t) or not langs:
            out.append((i, held(i), "und", 0.0))
            continue
        said = []
        for w in WORD.findall(t.lower()):
            for n in (0, *GRAMS):
                known = [g for g in ([w] if n == 0 else cut(w, n)) if g in log[n, langs[0]]]
                if known:
                    said.append([sum(log[n, lang][g] for g in known) / len(known) for lang in langs])
                    break
        total = [math.log(rows_of[lang] / sum(rows_of[x] for x in langs)) + sum(s[k] for s in said) / math.sqrt(len(said) or 1) for k, lang in enumerate(langs)]
        share = [math.exp(x - max(total)) for x in total]
        out.append((i, held(i), langs[share.index(max(share))], max(share) / sum(share)))
    return out


def same(got, expected):
    key = lambda r: (str(r[0]), r[2], round(r[3], 3))
    got, expected = sorted(map(tuple, got), key=key), sorted(expected, key=key)
    assert [r[:3] for r in got] == [r[:3] for r in expected]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in expected], abs=1e-5)


def test_answers(spark):
    texts = corpus() + [(100, "the unseenable riverstone", None), (101, "Flussgarten Übermorgen", None), (102, "zzz qqq", None), (103, "1234 ... !!", "en"), (104, "", "de"), (105, None, "de"), (None, "the garden", "en"), (106, "é", None), (107, "Garten " * 20_000, "fr")]
    texts += [(7, EN[0], "en")] * 5  # a repeated row
    same(identify(docs(spark, texts)).collect(), plain(texts))


def test_fallback_finds_inflected_words(spark):
    found = {r["doc_id"]: r["lang_pred"] for r in identify(docs(spark, corpus() + [(200, "riverlight stonegarden", None), (201, "Gartensteine fließtest", None)])).collect()}
    assert found[200] == "en" and found[201] == "de"


def test_sample_is_bounded_and_equal_texts_agree(spark):
    texts = [(i, t, lang) for i, (_, t, lang) in enumerate(corpus(60) * 4)]
    got = identify(docs(spark, texts).repartition(7), train_rows=12, train_bytes=200).collect()
    by_text = {}
    for r in got:
        by_text.setdefault(texts[r["doc_id"]][1], set()).add((r["lang_pred"], r["score"]))
    assert all(len(v) == 1 for v in by_text.values())


def test_awkward_rows(spark):
    got = identify(frame(spark)).collect()
    assert len(got) == len(awkward()) and {r["lang_pred"] for r in got} == {"en", "und"}
    letters = {i: bool(WORD.search(t or "")) for i, t in awkward()}
    assert all((r["lang_pred"] == "und") != letters[r["doc_id"]] or r["doc_id"] is None for r in got)
    assert identify(empty(spark)).count() == 0


def test_nothing_to_learn_from(spark):
    untold = spark.createDataFrame([r[:2] + (None,) + r[3:] for r in rows(awkward())], SCHEMA)
    assert {(r["lang_pred"], r["score"]) for r in identify(untold).collect()} == {("und", 0.0)}


def test_held_out_accuracy(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    told = identify(given).join(given.select("doc_id", "lang"), "doc_id").where("held_out and lang_pred <> 'und'")
    right, n = told.where("lang = lang_pred").count(), told.count()
    assert n > 200 and right >= 0.98 * n
