"""Token counts and packing against the libraries on whole texts."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tests.llm.fixtures import awkward, empty, frame

from llm.packing import pack, sweep
from llm.tokens import count_tokens, token_counts

NAMES = ["piece_bpe_32k.model", "word_bpe_49k.json", "byte_bpe_50k.json"]


def whole(name: str, text: str) -> list[int]:
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=path).encode(text)
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", NAMES)
def test_counts_equal_the_library(name):
    r = random.Random(5)
    letters = "ab Z.,;:!?'s12 \n\t\r▁♥<|é́ 　#_-ſK"
    texts = ["".join(r.choice(letters) for _ in range(r.randrange(60))) for _ in range(400)] + [t or "" for _, t in awkward()]
    assert token_counts(pa.array(texts), name).tolist() == [len(whole(name, t)) for t in texts]


def test_count_rows(spark):
    got = Counter((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in count_tokens(frame(spark), limit=100, batch_bytes=5000).collect())
    expected = Counter()
    for i, t in awkward():
        n = len(whole(NAMES[0], t or ""))
        expected[(i, len((t or "").encode()), n, n > 100)] += 1
    assert got == expected
    assert count_tokens(empty(spark)).count() == 0


def test_packing_is_whole_and_gapless(spark):
    limit = 64
    pieces = pack(frame(spark), max_tokens=limit).collect()
    by_row = Counter((p["doc_id"], p["piece"], p["start"], p["length"], p["ids_crc32"]) for p in pieces)
    expected = Counter()
    for i, t in awkward():
        ids = np.array([*whole("word_bpe_49k.json", t or ""), 0], dtype="<u4")
        for k, at in enumerate(range(0, len(ids), limit)):
            expected[(i, k, at, len(ids[at : at + limit]), zlib.crc32(ids[at : at + limit].tobytes()))] += 1
    assert by_row == expected
    ends: dict[int, int] = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == ends.get(p["sequence_id"], 0)
        ends[p["sequence_id"]] = p["offset"] + p["length"]
    assert max(ends.values()) <= limit
    assert pack(empty(spark)).count() == 0


def best_fit(counts: dict[int, int], size: int) -> int:
    """One document after the other, each into the fullest sequence that holds it."""
    gaps: list[int] = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fits = [g for g in gaps if g >= length]
            if fits:
                gaps.remove(min(fits))
                gaps.append(min(fits) - length)
            else:
                gaps.append(size - length)
    return len(gaps)


def test_sweeps_are_as_good_as_best_fit_one_by_one():
    r = random.Random(3)
    for _ in range(40):
        counts = {r.randrange(1, 101): r.randrange(1, 12) for _ in range(r.randrange(1, 15))}
        runs, opened = sweep(counts, 100)
        assert runs.groupby("length")["n"].sum().to_dict() == counts
        assert opened <= best_fit(counts, 100)
        used: dict[int, int] = {}
        for run in runs.sort_values("offset").itertuples():
            for s in range(run.sequence, run.sequence + run.n):
                assert used.get(s, 0) == run.offset
                used[s] = run.offset + run.length
        assert max(used.values()) <= 100 and len(used) == opened
