"""Decontamination and secrets against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

from tests.llm.fixtures import awkward, empty, frame, lower_ascii, prose

from llm.decontaminate import decontaminate, without_contaminated
from llm.secrets import ENCODINGS, cuts, masked, randomness, redact, scan_secrets

NORMAL = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = [(1, prose(50, 25)), (2, prose(50, 25)), (3, "Three words, only!"), (4, ""), (5, None), (None, "lost item of three"), (10, prose(51, 10)), (3, "Three words, only!")]


def documents():
    inside = prose(50, 25)
    return awkward() + [(50, "x " + inside.upper().replace(" ", ", ") + " y"), (51, " ".join(inside.split()[:12])), (52, " ".join(inside.split()[:9])), (53, "ÄThree words only three words only"), (54, prose(51, 10) + " " + prose(51, 10))]


def brute(text: str | None):
    windows = defaultdict(set)
    for i, t in ITEMS:
        w = NORMAL.findall(lower_ascii(t or "")) if i is not None else []
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k : k + 10])].add(str(i))
    words, hit, items = NORMAL.findall(lower_ascii(text or "")), set(), set()
    for window, names in windows.items():
        for k in range(len(words) - len(window) + 1):
            if tuple(words[k : k + len(window)]) == window:
                hit |= set(range(k, k + len(window)))
                items |= names
    return len(words), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)


def test_decontamination(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for block in (16 << 20, 1):
        rows = decontaminate(frame(spark, documents()), items, max_items_bytes=block).collect()
        assert Counter(tuple(r)[:6] for r in rows) == Counter((i, *brute(t)) for i, t in documents())
    texts = dict(documents())
    for r in rows:
        words = [w for s in r["spans"] for w in NORMAL.findall(texts[r["doc_id"]][s["begin"] : s["end"]])]
        assert len(words) == r["n_hit"]
    left = without_contaminated(frame(spark, documents()), items)
    assert Counter(r["doc_id"] for r in left.collect()) == Counter(i for i, t in documents() if not brute(t)[4])
    assert decontaminate(empty(spark), items).count() == 0
    assert decontaminate(frame(spark), items.limit(0)).where("contaminated").count() == 0


def base(text: str) -> list[tuple[int, int, int, str]]:
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def secrets():
    r = random.Random(8)
    hexes = "".join(r.choice("0123456789abcdef") for _ in range(40))
    key = "".join(r.choice(ENCODINGS["base62"]) for _ in range(48))
    return [
        (60, f"é API_KEY = '{hexes}' and token=token: abcdefgh"), (61, "AKIA" + "Q7" * 10 + " AKIA12"), (62, f"☃ {hexes} x {hexes[:23]}"), (63, f"see {key} there"), (64, "passwd:abc secret :  longer_value"),
        (65, f"{hexes}{hexes.upper()} ſecret=abcdefgh toKen=abcdefgh"), (66, prose(70, 30).replace(" ", "")),
    ]


def test_base_spans(spark):
    texts = awkward() + secrets()
    rows = scan_secrets(frame(spark, texts)).collect()
    expected = Counter()
    for i, t in texts:
        s = base(t or "")
        n = Counter(k for *_, k in s)
        expected[(i, n["assign"], n["access"], n["hex"], hashlib.sha256(",".join(f"{k}:{a}:{z}" for a, _, z, k in s).encode()).hexdigest())] += 1
    assert Counter(tuple(r)[:5] for r in rows) == expected
    for r in rows:
        own = base(dict((i, t) for i, t in secrets()).get(r["doc_id"]) or "")
        assert {f"{k}:{a}:{z}" for a, _, z, k in own} <= set(r["spans"].split(","))
    assert scan_secrets(empty(spark)).count() == 0


def test_battery_finds_a_random_key_and_leaves_words(spark):
    texts = [(i, prose(i, 300)) for i in range(20)] + secrets()
    spans = {r["doc_id"]: r["spans"] for r in scan_secrets(frame(spark, texts)).collect()}
    assert "random:4:52" in spans[63]
    assert spans[66] == "" and all(spans[i] == "" for i in range(20))


def test_randomness_is_near_uniform_for_random_strings():
    r = random.Random(4)
    for name in ("hex", "base36", "base64"):
        low = sum(randomness("".join(r.choice(ENCODINGS[name]) for _ in range(60)))[1] < 0.01 for _ in range(400))
        assert low <= 16
    assert randomness("a" * 40)[1] < 1e-3 and randomness("ab" * 30)[1] < 1e-3


def test_false_discovery_rule_by_hand():
    # One length class: the k smallest p-values are kept for the greatest k with p <= fdr * k / n.
    histogram = [(5, 200, 2), (5, 60, 3), (5, 20, 5), (5, -1, 90)]
    assert abs(cuts(histogram, 0.05)[5] - 60 * 0.05) < 1e-9
    assert cuts([(5, 0, 10)], 0.05) == {} and cuts([], 0.05) == {}
    both = cuts([(4, 100, 50), (8, 100, 50)], 0.05)
    assert both[8] < both[4]


def test_redaction(spark):
    docs = frame(spark, awkward() + secrets())
    left = redact(docs)
    assert left.columns == docs.columns and left.count() == docs.count()
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in left.collect()}
    assert texts[60][0] == "é [secret]' and token=token: abcdefgh" and texts[60][1] == len(texts[60][0])
    assert texts[4] == (None, None) and texts[5] == ("", 0)
    assert texts[8] == ("ein", 3)
    assert masked("abcdef", [(1, 3), (2, 4), (5, 6)], "*") == "a*e*"
    assert redact(empty(spark)).count() == 0


def test_spans_apart_are_found_as_by_comparing_all(monkeypatch):
    """Candidates beside base spans, and the strongest of overlapping ones, against every pair compared."""
    import random

    from llm import secrets as s

    r = random.Random(5)
    key = lambda n: "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_") for _ in range(n))
    for _ in range(30):
        text = " ".join(key(r.randrange(5, 60)) for _ in range(40))
        taken = sorted((a, a + r.randrange(1, 30), "hex") for a in (r.randrange(len(text)) for _ in range(r.randrange(6))))
        every = s.candidates(text, [])
        assert s.candidates(text, taken) == [(a, b) for a, b in every if not any(c < b and a < d for c, d, _ in taken)]
        strength = {span: r.choice((None, 1.0, 2.0, r.random())) for span in every}
        detector = s.Detector.__new__(s.Detector)
        monkeypatch.setattr(s.Detector, "judge", lambda self, run, by={text[a:b]: p for (a, b), p in strength.items()}: by[run])
        by_text = {text[a:b]: p for (a, b), p in strength.items()}
        chosen = []
        for _, _, a, b in sorted(((p, b - a, a, b) for a, b in every if (p := by_text[text[a:b]]) is not None), key=lambda j: (-j[0], -j[1], j[2])):
            if not any(a < d and c < b for c, d in chosen):
                chosen.append((a, b))
        assert detector.finds(text, every) == sorted(chosen)
