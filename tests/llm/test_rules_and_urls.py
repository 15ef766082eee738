"""Quality rules and URL filter against plain Python."""

from __future__ import annotations

import re
from collections import Counter

from tests.llm.fixtures import WORD, awkward, empty, frame, prose

from llm.rules import BAD, GOOD, RULES, fit, judge, kept, votes, with_counts
from llm.urls import RULES as URL_RULES
from llm.urls import filter_urls, host_edges, propagate


def counts(text: str) -> tuple[int, ...]:
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_counts_and_base(spark):
    got = judge(frame(spark)).collect()
    expected = Counter()
    for i, t in awkward():
        c = counts(t or "")
        expected[(i, *c, c[0] < 50 or 100 * c[4] > 50 * c[0])] += 1
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got) == expected
    assert not any(r["kept"] for r in got if r["base_failed"])
    assert judge(empty(spark)).count() == 0


def test_overlapping_windows(spark):
    texts = [(1, "a a a a"), (2, "a b c a b c d"), (3, "a b\x0bc f\x0cg"), (4, "f f f"), (5, "a b c x a b c y a b c")]
    got = {r["doc_id"]: r["n_repeat_words"] for r in judge(frame(spark, texts)).collect()}
    assert got == {i: counts(t)[4] for i, t in texts}


def mixed() -> list[tuple[int, str]]:
    good = [(i, prose(i, 150)) for i in range(60)]
    shout = [(100 + i, " ".join(w.upper() + "!!" for w in prose(i, 120).split())) for i in range(10)]
    symbols = [(200 + i, " ".join(w + "###" for w in prose(i, 120).split())) for i in range(10)]
    return good + shout + symbols


def test_posterior_separates_junk(spark):
    got = {r["doc_id"]: r["kept"] for r in judge(frame(spark, mixed())).collect()}
    assert all(got[i] for i in range(60)) and not any(k for i, k in got.items() if i >= 100)


def test_expectation_maximisation_by_hand(spark):
    voted = with_counts(frame(spark, mixed()).select("text")).select(*votes())
    model = fit(voted, rounds=3)
    rows = [tuple(r) for r in voted.collect()]
    names = list(RULES)
    prior, g, b = 0.8, dict.fromkeys(names, 0.005), dict.fromkeys(names, 0.2)
    cut = lambda x: min(0.999, max(0.001, x))
    for _ in range(3):
        post = []
        for r in rows:
            good, bad = prior, 1 - prior
            for n, v in zip(names, r):
                if v == BAD:
                    good, bad = good * g[n], bad * b[n]
                elif v == GOOD:
                    good, bad = good * (1 - g[n]), bad * (1 - b[n])
            post.append(good / (good + bad))
        g2, b2 = {}, {}
        for k, n in enumerate(names):
            on = [(p, r[k]) for p, r in zip(post, rows) if r[k]]
            g2[n] = cut((sum(p for p, v in on if v == BAD) + 0.5) / (sum(p for p, _ in on) + 100))
            b2[n] = cut((sum(1 - p for p, v in on if v == BAD) + 20) / (sum(1 - p for p, _ in on) + 100))
        prior, g, b = cut(sum(post) / len(post)), {n: min(g2[n], b2[n]) for n in names}, b2
    assert abs(model.prior - prior) < 1e-6
    assert all(abs(model.on_good[n] - g[n]) < 1e-6 and abs(model.on_bad[n] - b[n]) < 1e-6 for n in names)


def test_filter_keeps_columns(spark):
    docs = frame(spark)
    left = kept(docs)
    assert left.columns == docs.columns
    judged = {(r["doc_id"], r["n_words"]) for r in judge(docs).collect() if r["kept"]}
    assert Counter((r["doc_id"], len(WORD.findall(r["text"]))) for r in left.collect()) == Counter((i, len(WORD.findall(t or ""))) for i, t in awkward() if (i, len(WORD.findall(t or ""))) in judged)
    assert kept(empty(spark)).count() == 0


PAGES = [
    (1, "http://a.b.example.net/en/x?q#f", None), (2, "HTTPS://WWW.Example.NET/de/", ""), (3, "no scheme", "<a href='http://x.org/'>"), (4, None, None),
    (5, "ftp://example.com/de/1", "<a href=//good.org/fr/>"), (6, "http://example.com?x=/de/", ""), (7, "http://q.org/fr/a", "<A HREF=\"http://Other.com/\">"), (8, "http://q.org/fr/a", ""),
    (None, "http://notexample.com/de/1", ""), (9, "://net/", ""), (10, "http://bad.com/de/", ""), (11, "http://sub.example.com/de", ""),
]


def parts(url: str | None) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host) :])[0]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, host string")
    got = Counter((r["page_id"], r["host"], r["path"], r["rule"]) for r in filter_urls(pages).collect())
    expected = Counter()
    for i, url, _ in PAGES:
        host, path = parts(url)
        fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        expected[(i, host, path, max((r.name for r in fits), key=len, default=None))] += 1
    assert got == expected
    assert filter_urls(pages.limit(0)).count() == 0


def test_edges(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    got = {(r["src"], r["dst"]): r["weight"] for r in host_edges(pages, "url", "html").collect()}
    assert got[("example.com", "good.org")] == 1 and got[("q.org", "other.com")] == 1
    assert got[("a.b.example.net", "b.example.net")] == got[("b.example.net", "a.b.example.net")] == 1
    assert ("example.net", "net") not in got


def test_propagation_by_hand(spark):
    edges = [("a", "b", 1.0), ("a", "c", 3.0), ("b", "c", 1.0), ("c", "a", 1.0), ("d", "c", 1.0)]
    seeds = {"a": (1.0, 0.0), "c": (0.0, 1.0), "d": (0.0, 0.0)}
    got = {r["host"]: (r["trust"], r["distrust"]) for r in propagate(spark.createDataFrame([(h, *s) for h, s in seeds.items()], "host string, allowed double, blocked double"), spark.createDataFrame(edges, "src string, dst string, weight double")).collect()}
    for k, links in enumerate((edges, [(b, a, w) for a, b, w in edges])):
        total = Counter()
        for a, _, w in links:
            total[a] += w
        rank, most = {h: seeds.get(h, (0, 0))[k] for h in "abcd"}, dict.fromkeys("abcd", 1.0)
        for _ in range(15):
            rank, most = (
                {h: 0.15 * seed(h) + 0.85 * sum(x[a] * w / total[a] for a, b, w in links if b == h) for h in "abcd"}
                for x, seed in ((rank, lambda h: seeds.get(h, (0, 0))[k]), (most, lambda h: 1.0))
            )
        for h in "abcd":
            assert abs(got[h][k] - rank[h] / most[h]) < 1e-9
