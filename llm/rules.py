"""Quality rules as weak supervision, in DataFrame and SQL functions only.

Every rule looks at a few counts of the text and votes good, bad or abstains. How far a vote is to
be trusted is estimated without labels: expectation-maximisation over the table of vote patterns
(at most 3 to the number of rules, however many documents) fits, for each rule, how often it votes bad
on good and on bad documents, and the share of good ones. A document's posterior probability of being
good then decides, in place of "passes all rules".
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import SPACE, Stored, ids_and_texts

GOOD, BAD, ABSTAIN = 1, -1, 0

#: name -> (condition for bad, condition for good); neither: the rule abstains.
RULES: dict[str, tuple[str, str]] = {
    "symbols": ("n_symbols > 0.1 * n_words", "n_symbols <= 0.02 * n_words"),
    "word_length": ("word_chars < 2.5 * n_words or word_chars > 15 * n_words", "word_chars between 3.5 * n_words and 10 * n_words"),
    "repeated_words": ("n_repeat_words > 0.3 * n_words", "n_repeat_words <= 0.1 * n_words"),
    "repeated_lines": ("n_dup_lines > 0.3 * n_lines", "n_dup_lines = 0"),
    "capitals": ("n_capitals > 0.3 * word_chars", "n_capitals <= 0.1 * word_chars"),
    "shouting": ("n_marks > 0.2 * n_words", "n_marks <= 0.05 * n_words"),
    "symbol_ends": ("n_symbol_ends > 0.05 * n_words", "n_symbol_ends <= 0.01 * n_words"),
    "vocabulary": ("n_words < 2000 and n_distinct < 0.55 * n_words", "n_distinct >= 0.65 * n_words"),
    "length": ("n_words < 50", "n_words >= 100"),
}

#: What is believed before any vote is seen, as (votes bad, all votes) counts that are added to the data's.
_ON_GOOD, _ON_BAD, _PRIOR_GOOD = (0.5, 100.0), (20.0, 100.0), 0.8
#: Bounds of the estimates: a rule is never trusted without limit, nor taken for its opposite.
_LOW, _HIGH = 0.001, 0.999


def with_counts(frame: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals, n_marks,
    n_symbol_ends and n_distinct.

    Windows of three words are told apart by hash and place in one long (place in the low bits), so
    sorting brings equal ones together; neighbours of equal hash are compared word by word."""
    spaces = "' \\t\\n\\u000B\\u000C\\r'"
    body = text
    for c in ("' '", "'\\n'", "'\\t'", "'\\r'", "'\\u000B'", "'\\u000C'"):
        body = f"replace({body}, {c}, '')"
    first = frame.selectExpr(
        "*",
        f"split(btrim({text}, {spaces}), r'{SPACE}+') as _w",
        f"cast(length({body}) as long) as word_chars",
        f"cast(regexp_count({text}, '[#*$%&|<>]') as long) as n_symbols",
        f"cast(regexp_count({text}, '[A-Z]') as long) as n_capitals",
        f"cast(regexp_count({text}, '[!?]') as long) as n_marks",
        f"cast(regexp_count({text}, '[#*$%&|<>](?![^\\\\x20\\\\x09-\\\\x0D])') as long) as n_symbol_ends",
        f"filter(split({text}, '\\n'), x -> btrim(x, {spaces}) <> '') as _lines",
    )
    second = first.selectExpr("*", "if(word_chars = 0, 0, size(_w)) as _n", "cast(size(array_distinct(_w)) as long) as n_distinct", "cast(size(_lines) as long) as n_lines", "cast(size(_lines) - size(array_distinct(_lines)) as long) as n_dup_lines", "cast(ceil(log2(size(_w) + 1)) as int) as _b").drop("_lines")
    third = second.selectExpr("*", "if(_n < 3, cast(array() as array<bigint>), sort_array(transform(sequence(0, greatest(_n - 3, 0)), i -> shiftleft(xxhash64(get(_w, i), get(_w, i + 1), get(_w, i + 2)), _b) | i))) as _h", "shiftleft(1L, _b) - 1 as _m")

    # Neighbours in _h whose upper bits are equal, as places in _h; then the places of both in the text.
    fourth = third.selectExpr("*", "if(size(_h) < 2, cast(array() as array<int>), filter(sequence(0, greatest(size(_h) - 2, 0)), k -> shiftrightunsigned(get(_h, k) ^ get(_h, k + 1), _b) = 0)) as _k")
    a, b = ("cast(get(_h, k) & _m as int)", "cast(get(_h, k + 1) & _m as int)")
    same = " and ".join(f"get(_w, {a} + {i}) = get(_w, {b} + {i})" for i in range(3))
    fifth = fourth.selectExpr("*", f"array_sort(array_distinct(flatten(transform(filter(_k, k -> {same}), k -> array({a}, {b}))))) as _p").drop("_w", "_h", "_k")
    return fifth.selectExpr(
        "*",
        "cast(_n as long) as n_words",
        "if(size(_p) = 0, 0L, aggregate(sequence(1, size(_p)), 0L, (s, k) -> s + if(k = size(_p), 3L, least(3L, cast(get(_p, k) - get(_p, k - 1) as long))))) as n_repeat_words",
    ).drop("_n", "_b", "_m", "_p")


BASE_FAILED = "(n_words < 50 or 100 * n_repeat_words > 50 * n_words)"


def votes(rules: dict[str, tuple[str, str]] = RULES) -> list[Column]:
    return [F.expr(f"case when {bad} then {BAD} when {good} then {GOOD} else {ABSTAIN} end").alias(f"vote_{name}") for name, (bad, good) in rules.items()]


@dataclass(frozen=True)
class Model:
    """Estimates: the share of good documents; for each rule how often it votes bad on good and on bad ones."""

    prior: float
    on_good: dict[str, float]
    on_bad: dict[str, float]

    def posterior(self) -> Column:
        """Probability that the document with these vote columns is good."""
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for name, g in self.on_good.items():
            b = self.on_bad[name]
            vote = F.col(f"vote_{name}")
            odds = odds + F.when(vote == BAD, math.log(g / b)).when(vote == GOOD, math.log((1 - g) / (1 - b))).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def fit(voted: DataFrame, rules: dict[str, tuple[str, str]] = RULES, rounds: int = 10) -> Model:
    """Expectation-maximisation over the vote patterns, all rounds in one query: the patterns (at most 3 to
    the number of rules) meet in one row, and ``aggregate`` carries the estimates from round to round."""
    names = list(rules)
    patterns = voted.groupBy(*[f"vote_{n}" for n in names]).agg(F.count("*").cast("double").alias("n"))
    row = patterns.select(F.struct("n", F.array(*[f"vote_{n}" for n in names]).alias("v")).alias("p")).agg(F.collect_list("p").alias("w"))
    bound = lambda x: f"least({_HIGH}D, greatest({_LOW}D, {x}))"
    start = f"named_struct('prior', {_PRIOR_GOOD}D, 'g', array_repeat({_ON_GOOD[0] / _ON_GOOD[1]}D, {len(names)}), 'b', array_repeat({_ON_BAD[0] / _ON_BAD[1]}D, {len(names)}))"
    each = f"sequence(0, {len(names) - 1})"
    odds = f"""aggregate({each}, ln(m.prior / (1 - m.prior)), (s, j) -> s + case get(p.v, j) when {BAD} then ln(get(m.g, j) / get(m.b, j))
        when {GOOD} then ln((1 - get(m.g, j)) / (1 - get(m.b, j))) else 0D end)"""
    weighted = f"transform(w, p -> named_struct('v', p.v, 'good', p.n / (1 + exp(-{odds})), 'n', p.n))"

    def share(weight: str, add: tuple[float, float]) -> str:
        bad = f"aggregate(x, 0D, (s, p) -> s + if(get(p.v, j) = {BAD}, {weight}, 0D))"
        all_ = f"aggregate(x, 0D, (s, p) -> s + if(get(p.v, j) <> {ABSTAIN}, {weight}, 0D))"
        return f"transform({each}, j -> {bound(f'({bad} + {add[0]}D) / ({all_} + {add[1]}D)')})"

    prior = bound("aggregate(x, 0D, (s, p) -> s + p.good) / aggregate(x, 0D, (s, p) -> s + p.n)")
    fitted = f"get(transform(array({weighted}), x -> named_struct('prior', {prior}, 'g', {share('p.good', _ON_GOOD)}, 'b', {share('(p.n - p.good)', _ON_BAD)})), 0)"
    # A vote for bad never speaks for a document.
    step = f"get(transform(array({fitted}), z -> named_struct('prior', z.prior, 'g', zip_with(z.g, z.b, (g, b) -> least(g, b)), 'b', z.b)), 0)"
    got = row.select(F.expr(f"if(size(w) = 0, {start}, aggregate(sequence(1, {rounds}), {start}, (m, i) -> {step}))").alias("model")).first()["model"]
    return Model(got["prior"], dict(zip(names, got["g"], strict=True)), dict(zip(names, got["b"], strict=True)))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, threshold: float = 0.3, rules: dict[str, tuple[str, str]] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, the counts, base_failed, kept, posterior and each rule's vote.

    Null and empty texts have no words and fail the base rule. Repeated rows give a row each, null ids
    stay null, an empty table gives no rows; other columns are not read."""
    counted = Stored(with_counts(ids_and_texts(docs, id_col, text_col)).drop("text").select("*", *votes(rules)), "rules-counts").frame
    model = fit(counted, rules)
    return counted.select("doc_id", *COUNTS, F.expr(BASE_FAILED).alias("base_failed"), model.posterior().alias("posterior"), *[f"vote_{n}" for n in rules]).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))


def kept(docs: DataFrame, threshold: float = 0.3, rules: dict[str, tuple[str, str]] = RULES, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that the rules reject; columns as given. The texts are not shuffled:
    the counts are made once to fit the model, and once more where the rows are filtered."""
    plain = [f"_c{i}" for i in range(len(docs.columns))]
    renamed = docs.toDF(*plain)
    text = F.coalesce(F.col(plain[docs.columns.index(text_col)]).cast("string"), F.lit(""))
    model = fit(with_counts(renamed.select(text.alias("text"))).drop("text").select(*votes(rules)), rules)
    judged = with_counts(renamed.withColumn("text", text)).select(*plain, "n_words", "n_repeat_words", *votes(rules), F.spark_partition_id().alias("_here"))
    # A filter isn't pushed below a projection whose own column it needs and that isn't deterministic; else
    # every count would be made again for each place in the condition.
    chosen = judged.where((F.col("_here") >= 0) & ~F.expr(BASE_FAILED) & (model.posterior() >= threshold))
    return chosen.select(*[F.col(p).alias(c) for p, c in zip(plain, docs.columns, strict=True)])
