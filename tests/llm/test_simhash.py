"""Fingerprints, the index and components against brute force."""

from __future__ import annotations

import random

import numpy as np
import xxhash
from tests.llm.fixtures import WORD, awkward, empty, frame, lower_ascii, prose

from llm.simhash import CHUNK, blocks, components, fingerprint, levels_of, near_duplicates, one_of_each, search, turned


def plain_fingerprint(text: str) -> int:
    words = WORD.findall(lower_ascii(text))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(points: list[int], radius: int) -> list[int]:
    parent = list(range(len(points)))

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(points):
        for j in range(i):
            if (a ^ points[j]).bit_count() <= radius:
                a_, b_ = root(i), root(j)
                parent[max(a_, b_)] = min(a_, b_)
    return [root(i) for i in range(len(points))]


def test_fingerprints():
    for _, text in awkward():
        if len(text or "") < 5000:
            assert fingerprint((text or "").encode()) == plain_fingerprint(text or "")


def test_search_finds_what_brute_force_finds():
    r = random.Random(1)
    words = {r.getrandbits(64) for _ in range(300)}
    centre = r.getrandbits(64)
    words |= {centre ^ sum(1 << b for b in r.sample(range(64), r.randrange(4))) for _ in range(400)}
    points = np.array(sorted(words, key=lambda x: x ^ x >> 1), dtype=np.uint64)
    found = set()
    for by, lead in blocks(2):
        t = turned(points, by)
        q, node = search(t, levels_of(t, np.full(len(t), ~np.uint64(0))), 2, lead)
        found |= set(zip(q.tolist(), node.tolist()))
    expected = {(i, j) for i in range(len(points)) for j in range(len(points)) if int(points[i] ^ points[j]).bit_count() <= 2}
    assert found == expected
    assert CHUNK > 0


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 130)] + [(7, 7)]
    random.Random(2).shuffle(chain)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain, "a long, b long"))[0].collect()}
    assert all(got[i] == 0 for i in range(1, 41)) and all(got[i] == 100 for i in range(101, 130))


def expected_components(texts):
    points = [plain_fingerprint(t or "") if len(t or "") < 5000 else fingerprint(t.encode()) for _, t in texts]
    root = classes(points, 2)
    least = {}
    for (i, _), c in zip(texts, root):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    return sorted(((i, format(p, "016x"), least.get(c)) for (i, _), p, c in zip(texts, points, root)), key=str)


def test_near_duplicates(spark):
    texts = awkward() + [(100 + k, prose(9, 400) + f" end{k}") for k in range(30)]
    got = sorted((tuple(r) for r in near_duplicates(frame(spark, texts)).collect()), key=str)
    assert got == expected_components(texts)
    assert near_duplicates(empty(spark)).count() == 0


def test_one_of_each(spark):
    docs = frame(spark)
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    expected = {c for _, _, c in expected_components(awkward()) if c is not None}
    assert sorted(i for i in ids if i is not None) == sorted(expected)
    assert ids.count(None) == 2
    assert one_of_each(empty(spark)).count() == 0
