"""Nodes against a plain dictionary of prefixes."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from llm.trie import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, place long, words string, start string, kind int"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, rows):
    return spark.createDataFrame([(*r, 9, "x", None, 1) for r in rows], SCHEMA)


def plain(rows, base=None, shared=None):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            digest = hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, digest, role or "", text or ""))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    built = {c: own.get(base(c), [])[: shared(c)] + ts[shared(c) :] if base else ts for c, ts in own.items()}
    members, ends = {}, {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
        ends.setdefault(tuple(ts), []).append(c)
    leaf = {k: 1 for k in members}
    leaf.update({k[:-1]: 0 for k in members if k})
    kids, leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for k, m in members.items():
        if k:
            kids[k[:-1]] += 1
        cost = (len(m) - 1) * len(WORDS.findall(k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += leaf[k]
            saved[k[:d]] += cost
    return sorted(
        (min(m), len(k), min(members[k[:-1]]) if k else -1, len(m), kids[k], leaves[k], saved[k], hashlib.sha256(",".join(map(str, sorted(ends.get(k, [])))).encode()).hexdigest())
        for k, m in members.items()
    )


def got(frame):
    return sorted((*r[:2], -1 if r[2] is None else r[2], *r[3:]) for r in map(tuple, frame.collect()))


def random_rows(n, seed=1, deepest=6, hot=True):
    r = random.Random(seed)
    rows = []
    for c in range(0, n * 3, 3):
        if hot and c % 2:
            turns = [("user", "hello there"), ("assistant", "hi")]
        else:
            turns = [(r.choice(("user", "assistant", None)), r.choice(("a b", "c", "", None, " d\te f "))) for _ in range(r.randrange(deepest))]
        if c % 9 == 0:
            turns = [("system", "you are  kind"), *turns, *[("user", f"long {i}") for i in range(40 if c == 18 else 0)]]
        rows += [(c, None if i == 0 and c % 4 == 0 else 10 * i, *t) for i, t in enumerate(turns)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize(("band", "per_range"), [(1024, 10_000), (1024, 7), (8, 5)])
def test_nodes(spark, band, per_range):
    rows = random_rows(150)
    assert got(prefix_trie(table(spark, rows), band=band, per_range=per_range)) == plain(rows)


@pytest.mark.parametrize(("band", "per_range"), [(1024, 10_000), (3, 9)])
def test_rebuilt_conversations(spark, band, per_range):
    rows = [(c + 7, *t) for c, *t in random_rows(80, seed=5)] + [(20, 1, "user", "only one"), (40, 1, "a", "x"), (40, 2, "b", "y")] + [(-3, 0, "user", "negative")]
    base, shared = (lambda c: c - (c % 20 if c >= 0 else -(-c % 20))), (lambda c: zlib.crc32(str(c).encode()) % 4)
    conv = F.col("conv")
    frame = prefix_trie(table(spark, rows), base=conv - conv % 20, shared=F.crc32(conv.cast("string")) % 4, band=band, per_range=per_range)
    assert got(frame) == plain(rows, base, shared)


def test_awkward_rows(spark):
    rows = [(1, 1, "user", "same")] * 3 + [(2, 1, "user", "same"), (None, 1, "user", "nobody"), (3, None, None, None), (4, 2, "user", "w " * 50_000), (5, 1, "us", "ersame")]
    rows += [(6, 7, "user", "tie one"), (6, 7, "user", "tie two")]
    assert got(prefix_trie(table(spark, rows))) == plain(rows)


def test_hot_node(spark):
    """Half of all conversations are the same one, over many ranges."""
    rows = [(c, t, "user", f"turn {t}") for c in range(300) for t in range(3)] + [(1000 + c, t, "user", f"turn {t if t < 2 else c}") for c in range(300) for t in range(4)]
    assert got(prefix_trie(table(spark, rows), per_range=20)) == plain(rows)


def test_no_conversations(spark):
    assert prefix_trie(table(spark, [])).count() == 0
    assert prefix_trie(table(spark, [(None, 1, "user", "nobody")])).count() == 0
