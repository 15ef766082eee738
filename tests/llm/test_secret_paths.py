"""Random keys inside paths and options."""

from __future__ import annotations

import random

from tests.llm.fixtures import frame, prose

from llm.secrets import ENCODINGS, redact, scan_secrets


def paths() -> list[tuple[int, str, str]]:
    r = random.Random(21)
    key = "".join(r.choice(ENCODINGS["base62"]) for _ in range(48))
    url = "".join(r.choice(ENCODINGS["base62"]) for _ in range(24)) + "-_" + "".join(r.choice(ENCODINGS["base62"]) for _ in range(24))
    std = "".join(r.choice(ENCODINGS["base62"]) for _ in range(24)) + "+/" + "".join(r.choice(ENCODINGS["base62"]) for _ in range(24))
    other = "".join(r.choice(ENCODINGS["base62"]) for _ in range(40))
    return [(70, f"see /api-v1/keys/{key} there", key), (71, f"☃ /reset_password/{url} é", url), (72, f"run --key/{other}", other), (73, f"x sk-{std} y", std)]


def test_keys_in_paths_are_found_and_masked(spark):
    texts = [(i, prose(i, 300)) for i in range(20)] + [(30 + i, f"of /api-v1/keys/river_and_stone/winter-{i}/reset_password/sk-light --key/house") for i in range(20)] + [(i, t) for i, t, _ in paths()]
    spans = {r["doc_id"]: r["spans"] for r in scan_secrets(frame(spark, texts)).collect()}
    left = {r["doc_id"]: r["text"] for r in redact(frame(spark, texts)).collect()}
    for i, text, key in paths():
        assert spans[i] == f"random:{text.index(key)}:{text.index(key) + len(key)}"
        assert left[i] == text.replace(key, "[secret]")
    assert all(spans[i] == "" for i in [*range(20), *range(30, 50)])
