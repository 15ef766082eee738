"""Secret scan: fixed patterns, and a battery of randomness tests on what else looks encoded.

Base kinds are ``assign`` (a key word, a separator, a value), ``access`` (access key ids) and ``hex``.
The battery looks at every other run of 20 or more characters of an encoding, and where separators make it
a path or mix encodings also at its parts; of finds that overlap the strongest is told:

1. the narrowest encoding is inferred whose alphabet holds the run (hex, base32, base36, base62, base64);
2. chi-squared uniformity over the alphabet, a runs test around its middle and lag-one serial
   correlation ask whether the run could be drawn at random; Fisher's method combines the three;
3. a run that passes could still be an ordinary long word. The likelihood ratio of a random draw
   against the corpus's own characters (a chain of character classes counted over all documents)
   gives a p-value under "ordinary text" of at most one over the ratio, by Markov's inequality. Longer runs
   can reach smaller values and are compared within length classes;
4. Benjamini and Hochberg's rule, over all runs of all documents and weighted by length class, keeps the
   expected share of ordinary strings among the additional finds at ``fdr`` or less.

The second look needs one pass over the texts for candidates and character counts and two numbers per
length class; only a bounded histogram of p-values comes to the driver.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import Stored, ids_and_texts, texts_of

ASSIGN = re.compile("(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]+")
KINDS = ("assign", "access", "hex", "random")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX, LEAST_RANDOM = 6, 20, 24, 20

#: What RE2 looks for before Python's engine looks at a text.
_MAYBE_ASSIGN = "(?i)(password|passwd|secret|token|api_?key)[\"']? *[:=]"
_MAYBE_HEX = "[0-9a-f]{24}"
_MAYBE_RANDOM = "[A-Za-z0-9+/_-]{20}"
_RANDOM = re.compile("[A-Za-z0-9+/_-]{20,}={0,2}")
#: What may be a key inside such a run: its longest parts in base64, in base64url, and between all separators.
_PARTS = [re.compile(f"[A-Za-z0-9{more}]{{20,}}={{0,2}}") for more in ("+/", "_-", "")]

#: Encodings from the narrowest; the first that holds every character of a run is taken.
ENCODINGS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
_TABLES = {name: np.array([letters.find(chr(i)) if i else -1 for i in range(128)]) for name, letters in ENCODINGS.items()}

#: Characters counted in the corpus's chain: ASCII as it is, anything else as one.
CHARS = 129
#: Steps of -log10 p in the histogram, and its end.
STEP, STEPS = 0.05, 6000


def base_spans(text: str, assign: bool = True, found_hex: bool = True) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, by start, then kind as listed."""
    spans = []
    if assign:
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    if found_hex:
        spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if m.end() - m.start() >= LEAST_HEX]
    return in_order(spans)


def in_order(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def written(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def candidates(text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Runs of an encoding's characters, whole and in parts, that no base span touches; they may overlap."""
    starts = sorted(a for a, _, _ in taken)
    # How far the spans reach that begin before a place.
    reach = list(itertools.accumulate((b for _, b, _ in sorted(taken)), max))
    found = set()
    for m in _RANDOM.finditer(text):
        for part in _PARTS:
            for p in part.finditer(text, m.start(), m.end()):
                before = bisect_left(starts, p.end())
                if not before or reach[before - 1] <= p.start():
                    found.add(p.span())
    return sorted(found)


def _upper_tail(chi2: float, dof: int) -> float:
    """P(chi-squared >= chi2), by Wilson and Hilferty's normal approximation."""
    z = ((max(chi2, 0.0) / dof) ** (1 / 3) - (1 - 2 / (9 * dof))) / math.sqrt(2 / (9 * dof))
    return 0.5 * math.erfc(z / math.sqrt(2))


def randomness(run: str) -> tuple[str, float]:
    """Inferred encoding, and the combined p-value of "drawn at random from its alphabet"."""
    codes = np.frombuffer(run.rstrip("=").encode("ascii"), dtype=np.uint8)
    for name, table in _TABLES.items():
        x = table[codes]
        if (x >= 0).all():
            break
    else:
        return "", 0.0
    n, size = len(x), len(ENCODINGS[name])
    counts = np.bincount(x, minlength=size)
    chi2 = float(((counts - n / size) ** 2).sum() * size / n)
    # With few characters a cell, chi-squared has this variance rather than 2 * (size - 1).
    mean, variance = size - 1, 2 * (size - 1) * (n - 1) / n
    uniform = 0.5 * math.erfc((chi2 - mean) / math.sqrt(2 * variance)) if n < 5 * size else _upper_tail(chi2, size - 1)
    high = x >= size / 2
    up, runs = int(high.sum()), 1 + int((high[1:] != high[:-1]).sum())
    down = n - up
    if up and down:
        expected = 1 + 2 * up * down / n
        spread = max(1e-9, (expected - 1) * (expected - 2) / (n - 1))
        in_runs = math.erfc(abs(runs - expected) / math.sqrt(2 * spread))
    else:
        in_runs = 2.0 ** (1 - n)
    centred = x - (size - 1) / 2
    lag = float((centred[1:] * centred[:-1]).sum() / max(1e-9, (centred**2).sum()))
    serial = math.erfc(abs(lag) * math.sqrt(n) / math.sqrt(2))
    total = -2 * sum(math.log(max(p, 1e-300)) for p in (uniform, in_runs, serial))
    half = total / 2
    return name, math.exp(-half) * (1 + half + half * half / 2)


def _classes(text: np.ndarray) -> np.ndarray:
    return np.minimum(text, CHARS - 1)


def pair_counts(data: np.ndarray) -> np.ndarray:
    """Counts of adjacent bytes; bytes over 0x7F are one class."""
    x = _classes(data).astype(np.int64)
    return np.bincount(x[:-1] * CHARS + x[1:], minlength=CHARS * CHARS) if len(x) > 1 else np.zeros(CHARS * CHARS, dtype=np.int64)


def _scan(texts: pa.Array) -> Iterator[tuple[int, list[tuple[int, int, str]], list[tuple[int, int]], str]]:
    """Rows with anything to tell: number, base spans, candidates, text."""
    flags = [pc.match_substring_regex(texts, p).to_numpy(zero_copy_only=False) for p in (_MAYBE_ASSIGN, _MAYBE_HEX, _MAYBE_RANDOM)]
    access = pc.match_substring(texts, "AKIA").to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(flags[0] | flags[1] | flags[2] | access)
    for i, text in zip(rows.tolist(), texts.take(pa.array(rows)).to_pylist(), strict=True):
        base = base_spans(text, bool(flags[0][i]), bool(flags[1][i]))
        yield i, base, candidates(text, base) if flags[2][i] else [], text


@dataclass(frozen=True)
class Detector:
    """What the battery has learnt: log10 of the corpus's transitions, and the least -log10 p for each length class."""

    transitions: np.ndarray
    cut: dict[int, float]
    alpha: float

    def judge(self, run: str) -> float | None:
        """The strength of a run that is kept."""
        p = strength(run, self.transitions, self.alpha)
        return p if p is not None and p >= self.cut.get(length_class(len(run)), math.inf) else None

    def finds(self, text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """The candidates that are kept, by start; of those that overlap the strongest."""
        judged = [(p, b - a, a, b) for a, b in spans if (p := self.judge(text[a:b])) is not None]
        chosen: list[tuple[int, int]] = []
        for _, _, a, b in sorted(judged, key=lambda j: (-j[0], -j[1], j[2])):
            # The chosen ones are apart, so only the two next to a place can touch it.
            at = bisect_left(chosen, (a, b))
            if not (at and chosen[at - 1][1] > a) and not (at < len(chosen) and chosen[at][0] < b):
                chosen.insert(at, (a, b))
        return chosen


def length_class(n: int) -> int:
    return min(10, int(math.log2(n)))


def strength(run: str, transitions: np.ndarray, alpha: float) -> float | None:
    """-log10 of the p-value under "ordinary text"; none if the run isn't random by the battery."""
    name, p = randomness(run)
    if p < alpha:
        return None
    x = np.frombuffer(run.rstrip("=").encode("ascii"), dtype=np.uint8)
    ordinary = float(transitions[x[:-1], x[1:]].sum())
    return max(0.0, -(len(x) - 1) * math.log10(len(ENCODINGS[name])) - ordinary)


def fit(docs: DataFrame, fdr: float, alpha: float, text_col: str) -> Detector:
    """Candidates and character counts of all texts, then the false-discovery rule. Bounded results only
    come to the driver: one matrix of character pairs and one histogram for each length class."""

    def collect(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("run", pa.string()), ("pair", pa.int32()), ("n", pa.int64())])
        counts = np.zeros(CHARS * CHARS, dtype=np.int64)
        for batch in batches:
            texts = texts_of(batch)
            _, ends, data = texts.buffers()
            if len(texts) and data is not None:
                offsets = np.frombuffer(ends, dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1]
                data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
                for i in range(0, len(data), 1 << 20):
                    counts += pair_counts(data[i : i + (1 << 20) + 1])
            runs = [text[a:b] for _, _, more, text in _scan(texts) for a, b in more]
            yield pa.RecordBatch.from_arrays([pa.array(runs, pa.string()), pa.nulls(len(runs), pa.int32()), pa.nulls(len(runs), pa.int64())], schema=schema)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(seen), pa.string()), pa.array(seen.astype(np.int32)), pa.array(counts[seen])], schema=schema)

    gathered = Stored(docs.select(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")).mapInArrow(collect, "run string, pair int, n long"), "secrets-runs")
    counts = np.ones((CHARS, CHARS)) * 0.5
    for row in gathered.frame.where("pair is not null").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        counts[divmod(row["pair"], CHARS)] += row["n"]
    transitions = np.log10(counts / counts.sum(axis=1, keepdims=True))

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(length_class(len(r)), strength(r, transitions, alpha)) for r in batch.column("run").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in rows], pa.int32()), pa.array([-1 if s is None else min(STEPS, int(s / STEP)) for _, s in rows], pa.int32())], ["class", "step"])

    table = gathered.frame.where("run is not null").select("run").mapInArrow(measure, "class int, step int").groupBy("class", "step").agg(F.count("*").alias("n")).collect()
    gathered.drop()
    return Detector(transitions, cuts([(r["class"], r["step"], r["n"]) for r in table], fdr), alpha)


def cuts(histogram: list[tuple[int, int, int]], fdr: float) -> dict[int, float]:
    """Benjamini and Hochberg's step-up rule over weighted p-values.

    A class has the weight that its length gives (long runs can bring more evidence), scaled so that
    the mean over all candidates is one. Returns the least -log10 p a class must reach."""
    total = sum(n for _, _, n in histogram)
    if not total:
        return {}
    raw = {c: float(c) for c in {c for c, _, _ in histogram}}
    scale = total / sum(raw[c] * n for c, _, n in histogram)
    weight = {c: w * scale for c, w in raw.items()}
    points = sorted(((step * STEP + math.log10(weight[c]), n) for c, step, n in histogram if step >= 0), reverse=True)
    rank, best = 0, math.inf
    for value, n in points:
        rank += n
        if value >= math.log10(total / (fdr * rank)):
            best = value
    return {c: best - math.log10(w) for c, w in weight.items()} if best < math.inf else {}


def scan_secrets(docs: DataFrame, fdr: float = 0.01, alpha: float = 0.001, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random.

    ``spans`` lists kind:start:end of all spans by start, then kind. Null and empty texts have none
    (base_sha256 is that of the empty string). Repeated rows give a row each; other columns are not
    read. No shuffle of texts."""
    detector = fit(docs, fdr, alpha, text_col)
    chosen = ids_and_texts(docs, id_col, text_col)
    kind = chosen.schema["doc_id"].dataType.simpleString()
    nothing = hashlib.sha256(b"").hexdigest()

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch)
            n = {k: np.zeros(len(texts), dtype=np.int64) for k in KINDS}
            digests, spans = [nothing] * len(texts), [""] * len(texts)
            for i, base, more, text in _scan(texts):
                every = in_order(base + [(a, b, "random") for a, b in detector.finds(text, more)])
                for _, _, k in every:
                    n[k][i] += 1
                digests[i] = hashlib.sha256(written(base).encode()).hexdigest()
                spans[i] = written(every)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(n[k]) for k in KINDS[:3]], pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(n["random"])],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"],
            )

    return chosen.mapInArrow(find, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long")


def redact(docs: DataFrame, fdr: float = 0.01, alpha: float = 0.001, text_col: str = "text", length_col: str = "n_chars", mask: str = "[secret]") -> DataFrame:
    """``docs`` with every span replaced by ``mask`` (spans that overlap by one) and, where there is such a
    column, ``length_col`` set to the new length. Rows without spans are as they were; no shuffle."""
    detector = fit(docs, fdr, alpha, text_col)
    at = docs.columns.index(text_col)
    size_at = docs.columns.index(length_col) if length_col in docs.columns else -1

    def change(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.rename_columns([f"c{i}" for i in range(batch.num_columns)]), f"c{at}")
            new: dict[int, str] = {}
            for i, base, more, text in _scan(texts):
                spans = sorted([(a, b) for a, b, _ in base] + detector.finds(text, more))
                if spans:
                    new[i] = masked(text, spans, mask)
            if not new:
                yield batch
                continue
            columns = list(batch.columns)
            old = columns[at].to_pylist()
            columns[at] = pa.array([new.get(i, t) for i, t in enumerate(old)], columns[at].type)
            if size_at >= 0:
                sizes = columns[size_at].to_pylist()
                columns[size_at] = pa.array([len(new[i]) if i in new else n for i, n in enumerate(sizes)], columns[size_at].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(change, docs.schema)


def masked(text: str, spans: list[tuple[int, int]], mask: str) -> str:
    out, end = [], 0
    for a, b in spans:
        if a >= end or not out:
            out += [text[end:a], mask]
        end = max(end, b)
    return "".join([*out, text[end:]])
