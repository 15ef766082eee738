"""The operators applied to the given tables, with production parameters."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.classifier import classify
from llm.common import ship, table
from llm.decontaminate import decontaminate
from llm.languages import identify
from llm.negatives import mine
from llm.packing import pack
from llm.pitman_yor import score
from llm.rules import judge
from llm.secrets import scan_secrets
from llm.sharding import shard
from llm.simhash import near_duplicates
from llm.tokens import count_tokens
from llm.trie import prefix_trie
from llm.urls import filter_urls


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"), fdr=0.01, alpha=0.001)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=3, radius=2)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer="word_bpe_49k.json", max_tokens=2048, end=0)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), label_col="quality", threshold=0.7)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), parts=10, part=0, rounds=3, samples=2)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judge(table(spark, sf_dir, "documents"), threshold=0.3)
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = filter_urls(table(spark, sf_dir, "pages"), threshold=0.5)
    return found.select("page_id", "host", "path", "rule", "verdict", "trust", "distrust")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"), dimensions=("lang", "source"), shards=8).drop("curve")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer="piece_bpe_32k.model", limit=4096)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five positives and ten negatives a positive, over every vector; every seventh label is moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings"), anchor=F.col("vec_id") % 100 == 0, label=label, scale=256, positives=5, negatives=10, least_share=30, most_share=90)


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each with up to three first turns of the one whose id is the next lower
    multiple of 20."""
    conv = F.col("conv")
    return prefix_trie(table(spark, sf_dir, "conversations"), base=conv - conv % 20, shared=F.crc32(conv.cast("string")) % 4, most_shared=3)


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"), parts=4, part=2, train_rows=16_000, train_bytes=32 << 20)


def _with_code(query):
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {f.__name__: _with_code(f) for f in (op1_secret_scan, op2_simhash, op3_best_fit_packing, op4_quality_classifier, op5_decontamination, op6_lm_scores, op7_quality_rules, op8_url_filters, op9_sharding, op10_token_counts, op11_hard_negatives, op12_conversation_trie, op13_language_id)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLES: dict[str, str] = {
    "op5_decontamination": f"""with d as (select row_number() over () r, doc_id, {_WORDS} w from documents),
 i as (select cast(item_id as varchar) item, {_WORDS} w from benchmark where item_id is not null),
 windows as (select distinct item, least(10, len(w)) n, array_to_string(w[k:k + 9], ' ') words
  from (select *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) k from i where len(w) > 0)),
 places as (select r, k, n, array_to_string(w[k:k + n - 1], ' ') words
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) k from d, (select distinct n from windows) where len(w) >= n)),
 hits as (select r, k, places.n n, item from places join windows on places.words = windows.words and places.n = windows.n),
 hit_words as (select r, count(distinct p) n_hit from (select r, unnest(range(k, k + n)) p from hits) group by r),
 hit_items as (select r, count(*) n_items, string_agg(item, ',' order by item) items from (select distinct r, item from hits) group by r)
 select doc_id, len(w) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
  sha256(coalesce(items, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
 from d left join hit_words using (r) left join hit_items using (r)""",
    "op11_hard_negatives": """with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as kind,
  list_transform(embedding, lambda x: floor(256 * cast(x as double))) q from embeddings
  where vec_id is not null and label is not null and embedding is not null
  and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
 s as (select a.vec_id anchor_id, b.vec_id other, a.kind = b.kind same, cast(list_dot_product(a.q, b.q) as bigint) score
  from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
 p as (select anchor_id, other, score from s where same qualify row_number() over (partition by anchor_id order by score desc, other) <= 5),
 n as (select anchor_id, p.other positive_id, s.other negative_id, p.score positive_score, s.score negative_score,
  row_number() over (partition by anchor_id, p.other order by s.score desc, s.other) place
  from p join s using (anchor_id) where not s.same and 30 * p.score <= 100 * s.score and 100 * s.score <= 90 * p.score)
 select anchor_id, positive_id, cast(place as int) as "rank", negative_id, positive_score, negative_score from n where place <= 10""",
    # crc32 bit by bit, over the digits of the id
    "op12_conversation_trie": """with t as (select conv_id c, row_number() over (partition by conv_id order by turn nulls first, role, text) p,
  coalesce(role, '') r, coalesce(text, '') x from conversations where conv_id is not null),
 k as (select c, count(*) has, xor(3, list_reduce([4294967295] || list_transform(string_split(cast(c as varchar), ''), lambda d: ascii(d)),
   lambda s, d: list_reduce([xor(s, d)] || range(8), lambda q, i: xor(q >> 1, (q & 1) * 3988292384))) & 3) h from t group by c),
 b as (select k.c, least(h, coalesce(o.has, 0)) taken, h from k left join (select c base, has from k) o on o.base = k.c - k.c % 20),
 u as (select b.c, t.p, t.r, t.x from b join t on t.c = b.c - b.c % 20 and t.p <= taken
  union all select b.c, t.p - h + taken, t.r, t.x from b join t on t.c = b.c and t.p > h),
 f as (select k.c, coalesce(w, []) w from k left join (select c, list({'r': r, 'x': x} order by p) w from u group by c) using (c)),
 m as (select c, unnest(range(0, len(w) + 1)) d, w from f),
 g as (select d, w[1:d] w, min(c) conv, count(*) n, string_agg(c, ',' order by c) filter (where len(m.w) = d) ends from m group by 1, 2),
 a as (select g.*, (select count(*) from g j where j.d = g.d + 1 and j.w[1:g.d] = g.w) kids,
  case when d > 0 then (n - 1) * len(regexp_extract_all(w[d].x, '[^\\x20\\x09-\\x0D]+')) else 0 end saved from g)
 select conv conv_id, d as "depth", (select min(j.conv) from g j where j.d = a.d - 1 and j.w = a.w[1:a.d - 1]) parent_conv_id, n n_convs, kids n_children,
  (select count(*) from a j where j.kids = 0 and j.d >= a.d and j.w[1:a.d] = a.w) n_leaves,
  (select cast(sum(j.saved) as bigint) from a j where j.d >= a.d and j.w[1:a.d] = a.w) saved_tokens, sha256(coalesce(ends, '')) ends_sha256 from a""",
}
