"""Registered queries of this subpackage: one per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from stmtscope.llm import periodic_runs, pieces, prefix_trie, token_counts
from stmtscope.llm.html_text import main_texts
from stmtscope.llm.lm_score import lm_scores
from stmtscope.llm.mixing import mix
from stmtscope.llm.near_dup import near_duplicates
from stmtscope.llm.pii import find_personal_data
from stmtscope.llm.quality_rules import quality_rules
from stmtscope.llm.quality_vote import quality_scores
from stmtscope.llm.topk import top_k
from stmtscope.llm.url_filter import filter_urls

URL_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), k=20, scale=64.0, query_every=20)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as often as a mixture of all tokens takes it, no source over twice."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_tokens")
    )
    return mix(docs, budget=1.0, max_repeats=2.0)


def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return quality_rules(table(spark, sf_dir, "documents"), trusted)


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and a digest of the text that decoding them gives back."""
    decoded = pieces.decode(pieces.encode(table(spark, sf_dir, "documents")))
    return decoded.select(
        "doc_id", "n_tokens", "token_ids", F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256")
    )


def op8_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Besides the counts, how much of each text fits the limit."""
    limit = 4096
    counted = token_counts.token_counts(table(spark, sf_dir, "documents"), limit)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "fitting_chars")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation opens with the first 0 to 3 turns of the first one of its twenty."""
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    own = prefix_trie.sequences(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(spark, prefix_trie.with_shared_openings(own, 20, shared))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` where one text in ten, by a hash of doc_id, becomes periodic from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    # As columns of one generated row, which is not merged into the expressions above it.
    row = F.when(h % 10 == 0, F.struct(words.alias("words"), F.floor(h / 10).alias("g")))
    marked = docs.select("doc_id", "text", F.explode(F.array(row)).alias("r"))
    n, g = F.size("r.words"), F.col("r.g")
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    body = F.slice("r.words", a + 1, p)
    times = F.ceil((n - a) / p).cast("int")
    repeated = F.slice(F.flatten(F.array_repeat(body, times)), F.lit(1), n - a)
    planted = F.array_join(F.concat(F.slice("r.words", F.lit(1), a), repeated), " ")
    return marked.select("doc_id", F.when(F.col("r").isNotNull() & (n > 0), planted).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run of most periods, and digests of all runs and of the text without repeats."""
    found = periodic_runs.find_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    # More periods first.  Quotients of equal value are equal doubles, and others differ by more
    # than rounding in texts of up to 2^26 words.
    order = F.transform(
        "runs", lambda r: F.struct((-(r["length"] / r["period"])).alias("less"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length"))
    )
    best = F.array_min(order)
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.when(F.size("runs") > 0, F.concat(F.array_join(line, "\n"), F.lit("\n"))).otherwise(F.lit(""))

    def sha256(text):
        return F.sha2(text.cast("binary"), 256)

    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        sha256(lines).alias("runs_sha256"),
        sha256(F.col("collapsed")).alias("collapsed_sha256"),
        "n_words",
    ).select(
        "doc_id", "n_runs", "start", "length", "period",
        F.expr("1000 * length div period").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256", "n_words",
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filter": op1_url_filter,
        "op2_near_duplicates": op2_near_duplicates,
        "op3_top_k": op3_top_k,
        "op4_mixing": op4_mixing,
        "op5_lm_scores": op5_lm_scores,
        "op6_quality_rules": op6_quality_rules,
        "op7_pieces": op7_pieces,
        "op8_quality_scores": op8_quality_scores,
        "op9_main_texts": op9_main_texts,
        "op10_personal_data": op10_personal_data,
        "op11_token_counts": op11_token_counts,
        "op12_prefix_trie": op12_prefix_trie,
        "op13_periodic_runs": op13_periodic_runs,
        "pipeline": corpus_pipeline.run,
    }


WORD_LIST = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"

# All pairs of documents that share a shingle, then what each document reaches.
OP2_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {WORD_LIST.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) < 2 THEN ws
         ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS shingle FROM w),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(sizes.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least ON a = d.doc_id LEFT JOIN sizes ON sizes.doc_id = d.doc_id"""

OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 20"""

# The exponent by bisection, 25 steps; then the epochs and the cut of each source's last one.
OP4_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(len({WORD_LIST.format(text="text")}) AS BIGINT) AS n_tokens,
         CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 12))::BIGINT % (SELECT CAST(ceil(sqrt(count(*))) AS BIGINT) FROM documents)
              AS BIGINT) AS block
  FROM documents),
total AS (SELECT sum(n_tokens)::DOUBLE AS t FROM d),
sources AS (SELECT source, sum(n_tokens)::BIGINT AS tokens, sum(n_tokens)::DOUBLE / any_value(t) AS share FROM d, total GROUP BY 1),
shares AS (SELECT list(share) AS ps, min(share) AS least FROM sources),
steps AS (
  SELECT 0 AS step, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
  UNION ALL
  SELECT step + 1, CASE WHEN ok THEN low ELSE middle END, CASE WHEN ok THEN middle ELSE high END
  FROM (SELECT step, low, high, (low + high) / 2 AS middle,
               pow(least, (low + high) / 2 - 1) / list_sum(list_transform(ps, lambda p: pow(p, (low + high) / 2))) <= 2.0 AS ok
        FROM steps, shares WHERE step < 25)),
a AS (SELECT CASE WHEN pow(least, -1) / len(ps) <= 2.0 THEN 0.0 ELSE high END AS a FROM steps, shares WHERE step = 25),
z AS (SELECT sum(pow(share, a)) AS z FROM sources, a),
wanted AS (SELECT source, tokens, round(pow(share, a) / z, 9) AS weight, round(pow(share, a) / z * t, 3) AS w FROM sources, a, z, total),
planned AS (
  SELECT source, weight, CAST(floor(w / tokens) AS INTEGER) AS epochs, CAST(floor(w - floor(w / tokens) * tokens) AS BIGINT) AS rest
  FROM wanted),
blocks AS (
  SELECT *, sum(tokens) OVER (PARTITION BY source ORDER BY md5(source || '|' || block || '|' || epochs), block
                              ROWS UNBOUNDED PRECEDING) AS until
  FROM (SELECT source, block, sum(n_tokens) AS tokens FROM d GROUP BY 1, 2) JOIN planned USING (source)),
cut AS (SELECT *, rest - until + tokens AS room FROM blocks WHERE until > rest AND until - tokens < rest),
fits AS (
  SELECT source, doc_id FROM (
    SELECT source, doc_id, room, sum(n_tokens) OVER (PARTITION BY source ORDER BY md5(doc_id || '|' || epochs), doc_id) AS upto
    FROM d JOIN cut USING (source, block)) WHERE upto <= room),
placed AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY source, epoch ORDER BY md5(source || '|' || block || '|' || epoch), block) AS INTEGER)
         AS block_rank
  FROM (SELECT *, CAST(unnest(range(0, epochs + 1)) AS INTEGER) AS epoch FROM blocks))
SELECT doc_id, source, n_tokens, epoch, block, block_rank, weight FROM d JOIN placed USING (source, block)
WHERE epoch < epochs OR (rest > 0 AND until <= rest)
   OR (until > rest AND until - tokens < rest AND (source, doc_id) IN (SELECT source, doc_id FROM fits))"""


# Prefixes of every rebuilt conversation as lists of turn numbers; the checksum from its table.
OP12_SQL = f"""
WITH crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
         lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
turns AS (
  SELECT conv_id, turn, dense_rank() OVER (ORDER BY coalesce(role, ''), coalesce(text, '')) AS id,
         CAST(len({WORD_LIST.format(text="coalesce(text, '')")}) AS BIGINT) AS words
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list(id ORDER BY turn NULLS FIRST, id) AS ids, list(words ORDER BY turn NULLS FIRST, id) AS words,
  FROM turns GROUP BY 1),
shared AS (
  SELECT own.*, xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: ascii(s))),
                    lambda c, b: xor(t[1 + (xor(c, b) & 255)], c >> 8)), 4294967295) % 4 AS h
  FROM own, crc),
convs AS (
  SELECT s.conv_id, list_concat(coalesce(b.ids[1:h], []), s.ids[h + 1:]) AS ids,
         list_concat(coalesce(b.words[1:h], []), s.words[h + 1:]) AS words
  FROM shared s LEFT JOIN own b ON b.conv_id = s.conv_id - s.conv_id % 20),
prefixes AS (
  SELECT conv_id, CAST(d AS BIGINT) AS depth, ids[1:d] AS p, len(ids) = d AS ending, CASE WHEN d > 0 THEN words[d] ELSE 0 END AS words
  FROM (SELECT *, unnest(range(0, len(ids) + 1)) AS d FROM convs)),
nodes AS (
  SELECT depth, p, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ending), '')) AS ends_sha256
  FROM prefixes GROUP BY 1, 2),
children AS (SELECT depth - 1 AS depth, p[1:depth - 1] AS p, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2),
whole AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (depth, p)),
above AS (
  SELECT CAST(d AS BIGINT) AS depth, p[1:d] AS p, CAST(count(*) FILTER (WHERE n_children = 0) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM whole) GROUP BY 1, 2)
SELECT w.conv_id, w.depth, q.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens, w.ends_sha256
FROM whole w JOIN above a ON a.depth = w.depth AND a.p = w.p
LEFT JOIN nodes q ON q.depth = w.depth - 1 AND q.p = w.p[1:w.depth - 1] AND w.depth > 0"""


def oracle_sql() -> dict[str, str]:
    return {"op2_near_duplicates": OP2_SQL, "op3_top_k": OP3_SQL, "op4_mixing": OP4_SQL, "op12_prefix_trie": OP12_SQL}
