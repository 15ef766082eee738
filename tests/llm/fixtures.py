"""Small awkward tables, and brute-force helpers."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Names that operators use inside; here they are columns of the input.
CLASHING = ("fingerprint", "part", "length", "n_words", "rank", "word", "block", "host", "kept", "_w", "fp", "posterior")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)


def lower_ascii(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    words = ["the", "of", "and", "river", "stone", "über", "été", "winter", "garden", "a", "light", "in", "house", "quiet", "morning", "Bird"]
    return " ".join(r.choice(words) + str(r.randrange(40) or "") for _ in range(n))


def rows(texts: list[tuple[int | None, str | None]]) -> list[tuple]:
    return [(i, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else f"src{k % 5}", None if t is None else len(t), *["x"] * len(CLASHING)) for k, (i, t) in enumerate(texts)]


def awkward() -> list[tuple[int | None, str | None]]:
    base = prose(1, 120)
    return [
        (1, base), (2, base), (3, base.upper()), (4, None), (5, ""), (6, " \n\t "), (None, prose(2, 80)), (7, prose(3, 200)), (7, prose(3, 200)),
        (8, "ein"), (9, "zwei Wörter"), (10, prose(4, 30_000)), (11, "x" * 50_000), (12, "☃▁ ▁ a  b c d " + base), (13, " lead" + base + " "), (14, "<|endoftext|> ♥ <s> a,b. c's <|ENDOFTEXT|>"),
        (15, base[:-5] + "change"), (16, "!!! ### $$$ " * 60), (17, "same line here\n" * 40), (None, None),
    ]


def frame(spark, texts=None):
    return spark.createDataFrame(rows(awkward() if texts is None else texts), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
