"""Registered queries of this package, over whole tables, and their SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelight.llm import (
    bpe,
    code_search,
    conversations,
    language,
    license_scan,
    lm,
    mixing,
    neighbours,
    quality_rules,
    sharding,
    simhash,
    spelling,
    url_filter,
)
from parcelight.llm.common import remainder, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


@query
def op2_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"))


@query
def op3_bin_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"), 40).withColumn(
        "grown_shard", F.lit(None).cast("int")
    )


@query
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 4) == 2
    model = language.fit(docs.where(~held_out), public_tokenizers.path("piece_bpe_32k.model"))
    return language.with_language(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


# (verdict, host and start of the path)
URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]
# Sites whose pages make up the list of URLs to block.
LISTED_SITES = "adult-x|ads-track|casino-win|cheap-pills|free-bets|spam-farm"


@query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.where(
        url_filter.host_of(F.col("url")).rlike(rf"(^|\.)({LISTED_SITES})\.")
    ).select("url")
    return url_filter.judge(pages, listed, URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict", "listed"
    )


_RULE_ROWS = ", ".join(
    f"('{verdict}', '{text.partition('/')[0]}', '/{text.partition('/')[2]}', '{text}')"
    for verdict, text in URL_RULES
)
ORACLE["op5_url_filter"] = rf"""
WITH split AS (
  SELECT page_id, url,
    CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages
), parts AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
    list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'),
      lambda x: x <> '' AND split_part(x, '=', 1) NOT IN ('ref', 'fbclid', 'gclid')
        AND NOT starts_with(split_part(x, '=', 1), 'utm_'))) AS query
  FROM split
), named AS (
  SELECT page_id, host, path,
    CASE WHEN host <> '' THEN regexp_replace(host, '^www\.', '')
      || regexp_replace(path, '/+$', '')
      || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END
    END AS entry
  FROM parts
), listed AS (
  SELECT DISTINCT entry FROM named
  WHERE regexp_matches(host, '(^|\.)({LISTED_SITES})\.') AND entry IS NOT NULL
), rules(verdict, host, path, rule) AS (VALUES {_RULE_ROWS})
SELECT n.page_id, n.host, n.path,
  (SELECT arg_max(r.rule, length(r.rule) * 1000 + length(r.host)) FROM rules r
   WHERE (n.host = r.host OR ends_with(n.host, '.' || r.host))
     AND starts_with(n.path, r.path)) AS rule,
  coalesce(
    (SELECT arg_max(r.verdict, length(r.rule) * 1000 + length(r.host)) FROM rules r
     WHERE (n.host = r.host OR ends_with(n.host, '.' || r.host))
       AND starts_with(n.path, r.path)),
    CASE WHEN l.entry IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
  l.entry IS NOT NULL AND (SELECT count(*) FROM rules r
    WHERE (n.host = r.host OR ends_with(n.host, '.' || r.host))
      AND starts_with(n.path, r.path)) = 0 AS listed
FROM named n LEFT JOIN listed l ON n.entry = l.entry
"""


@query
def op6_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs)


@query
def op7_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder("doc_id", 5) == 1
    scored = lm.score(
        docs, docs.where(~held_out), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )
    return scored.withColumn("held_out", held_out)


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0)
    model = neighbours.fit(docs, labels)
    return neighbours.with_score(docs, model, "text", "score").select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= neighbours.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op10_code_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return code_search.search(vectors, vectors.where("vec_id % 50 = 0"), k=10)


# Every pair's distance; the code is the sign of each value.
ORACLE["op10_code_search"] = """
WITH codes AS (
  SELECT row_number() OVER () AS n, vec_id,
    list_transform(embedding, lambda x: coalesce(x > 0 AND NOT isnan(x), false)) AS code
  FROM embeddings WHERE embedding IS NOT NULL
), pairs AS (
  SELECT q.n, q.vec_id AS query_id, r.vec_id AS id,
    len(list_filter(list_zip(q.code, r.code), lambda p: p[1] <> p[2])) AS distance
  FROM codes q, codes r WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY n ORDER BY distance, id) AS INTEGER) AS rank
  FROM pairs
)
SELECT query_id, rank, id, distance FROM ranked WHERE rank <= 10
"""


@query
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


_TEMPLATE_ROWS = ", ".join(
    "({}, '{}', '{}', {}, {}, {})".format(i, text.replace("'", "''"), *rest)
    for i, text, *rest in license_scan.template_rows()
)
_WORDS = (
    "list_filter(regexp_split_to_array(translate(coalesce(text, ''), "
    f"'{license_scan.UPPER}', '{license_scan.LOWER}'), '{license_scan.SEPARATORS}'), "
    "lambda x: x <> '')"
)
ORACLE["op12_license_scan"] = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents
), named(template, text, label, phrase, base, run) AS (VALUES {_TEMPLATE_ROWS}
), worded AS (SELECT *, {_WORDS} AS w FROM named
), known AS (
  SELECT template, label, phrase, base, run, len(w) - run + 1 AS runs, j,
    array_to_string(w[j + 1 : j + run], ' ') AS gram
  FROM (SELECT *, unnest(range(len(w) - run + 1)) AS j FROM worded)
), runs AS (
  SELECT r, i, run, array_to_string(w[i + 1 : i + run], ' ') AS gram
  FROM (SELECT r, w, run, unnest(range(len(w) - run + 1)) AS i
        FROM docs, (VALUES ({license_scan.PHRASE_RUN}), ({license_scan.NOTICE_RUN})) k(run))
), votes AS (
  SELECT r, template, label, phrase, base, k.run, runs, i, j, i - j AS diagonal
  FROM runs JOIN known k ON runs.run = k.run AND runs.gram = k.gram
), diagonals AS (
  SELECT *, diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) AS step
  FROM (SELECT DISTINCT r, template, diagonal, phrase FROM votes)
), placed AS (
  SELECT r, template, diagonal, count_if(phrase OR step IS NULL OR step > {license_scan.GAP})
    OVER (PARTITION BY r, template ORDER BY diagonal) AS span
  FROM (SELECT r, template, diagonal, phrase, step FROM diagonals)
), merged AS (
  SELECT r, template, label, phrase, base, run, runs, count(DISTINCT j) AS n,
    min(i) AS first_word, max(i) + run - 1 AS last_word
  FROM votes JOIN placed USING (r, template, diagonal)
  GROUP BY r, template, label, phrase, base, run, runs, span
), judged AS (
  SELECT *, n / runs AS share, CASE WHEN phrase THEN n = runs ELSE n / runs >= {license_scan.SHARE}
    AND last_word - first_word + 1 <= {license_scan.STRETCH} * (runs + run - 1) END AS found
  FROM merged
)
SELECT any_value(doc_id) AS doc_id, any_value(len(w)) AS n_words,
  CAST(count_if(coalesce(found AND base, false)) AS BIGINT) AS n_base,
  min(first_word) FILTER (found AND base) AS first_word,
  max(first_word) FILTER (found AND base) AS last_word,
  coalesce(array_to_string(list_sort(list_distinct(list(label) FILTER (found AND base))), ','), '')
    AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list(label) FILTER (found))), ','), '') AS labels,
  coalesce(max(share) FILTER (found OR NOT phrase), 0.0) AS score
FROM docs LEFT JOIN judged USING (r) GROUP BY r
"""


def damaged_turns(turns: DataFrame) -> DataFrame:
    """Conversations with faults, by the checksum of a turn's place."""
    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    spoilt = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text("text"), "[.!?]", ""))
    return turns.where(kind != 0).select(
        "conv_id", "turn",
        F.when(kind == 4, "user").otherwise(text("role")).alias("role"),
        F.coalesce(spoilt, text("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("_copy"),
    ).drop("_copy")


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    reports, repaired = conversations.repair(damaged_turns(turns))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    every = turns.select(F.col("conv_id").alias("conv")).distinct()
    rows = every.unionByName(reports, True).unionByName(conversations.digests(repaired), True)
    nothing = F.lit(EMPTY_SHA256)
    return rows.groupBy(F.col("conv").alias("conv_id")).agg(
        *[F.coalesce(F.max(c), F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("sha256"), nothing).alias("repaired_sha256"),
    )


# sha256 of no bytes.
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def _put(state: str, cost: str, letter: str, condition: str = "true") -> str:
    """A state's (cost, audit) with one edit more."""
    return (
        f"CASE WHEN {state} IS NOT NULL AND {condition} "
        f"THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}'}} END"
    )


def _least(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


def _inserted(source: str, columns: str) -> str:
    """Rows with turns put in where they are cheaper, e0 to e3."""
    once = (
        f"SELECT {columns}, b0, b1, b2, b3, "
        f"{_least('b2', *(_put(b, '5', 'I') for b in ('b0', 'b1', 'b3')))} AS r2, "
        f"{_least('b3', _put('b2', '5', 'I'))} AS r3 FROM {source}"
    )
    return (
        f"SELECT {columns}, b0 AS e0, b1 AS e1, {_least('r2', _put('r3', '5', 'I'))} AS e2, "
        f"{_least('r3', _put('r2', '5', 'I'))} AS e3 FROM ({once})"
    )


def _moved(state: str, initial: str) -> list[str]:
    kept = _put(state, "more", "K", f"may_stay AND initial = '{initial}'")
    return [kept, _put(state, "more + 1", "R", "may_stay")]


ORACLE["op13_conversation_repair"] = rf"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY x) AS t
  FROM range(256) r(x)
), keyed AS (
  SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations
), damage AS (
  SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split(k, ''), lambda x: CAST(unicode(x) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 20 AS kind
  FROM keyed, crc_table
), turns AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g')
      ELSE coalesce(text, ' ') END AS text
  FROM damage, range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)
), placed AS (
  SELECT *, coalesce(CAST(conv_id AS VARCHAR), '') AS conv, row_number() OVER w AS pos,
    role[1] AS initial, coalesce(lag(role) OVER w, '')[1] || role[1] AS pair,
    NOT regexp_matches(text, '[^ 	-
]') AS blank,
    NOT regexp_matches(text, '[.!?][ 	-
]*\z') AS cut
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), faults AS (
  SELECT *, NOT blank AND first AS may_stay, NOT blank AND NOT first AS duplicate,
    CASE WHEN cut THEN 5 ELSE 0 END AS more
  FROM (SELECT *, pos = min(pos) OVER (PARTITION BY conv_id, role, text) AS first FROM placed)
), best AS (
  SELECT DISTINCT conv, 0::BIGINT AS pos, {{'c': 0::BIGINT, 'a': ''}} AS b0,
    NULL::STRUCT(c BIGINT, a VARCHAR) AS b1, NULL::STRUCT(c BIGINT, a VARCHAR) AS b2,
    NULL::STRUCT(c BIGINT, a VARCHAR) AS b3 FROM placed
  UNION ALL
  SELECT f.conv, f.pos, {_put('e0', '2', 'D')},
    {_least(_put('e1', '2', 'D'), _put('e0', 'more', 'K', "may_stay AND initial = 's'"))},
    {_least(_put('e2', '2', 'D'), *_moved('e0', 'u'), *_moved('e1', 'u'), *_moved('e3', 'u'))},
    {_least(_put('e3', '2', 'D'), *_moved('e2', 'a'))}
  FROM ({_inserted('best', 'conv, pos')}) e JOIN faults f ON e.conv = f.conv AND e.pos + 1 = f.pos
), stats AS (
  SELECT conv, max(pos) AS pos, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
    count_if(blank) AS blank, count_if(duplicate) AS duplicate,
    count_if(may_stay AND cut) AS truncated,
    count_if(pos > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv
), chosen AS (
  SELECT s.*, {_least('e0', 'e3')} AS found
  FROM ({_inserted('best', 'conv, pos')}) e JOIN stats s USING (conv, pos)
), letters AS (
  SELECT conv, k, found.a[k] AS letter,
    count_if(found.a[k] <> 'I') OVER w AS pos, count_if(found.a[k] <> 'D') OVER w AS place
  FROM (SELECT conv, found, unnest(range(1, len(found.a) + 1)) AS k FROM chosen)
  WINDOW w AS (PARTITION BY conv ORDER BY k)
), edited AS (
  SELECT l.conv, k, letter, role, text,
    place - max(CASE WHEN place = 1 AND letter = 'K' AND initial = 's' THEN 1 ELSE 0 END)
      OVER (PARTITION BY l.conv) AS place
  FROM letters l LEFT JOIN faults f ON l.conv = f.conv AND l.pos = f.pos
  WHERE letter <> 'D'
), repaired AS (
  SELECT conv, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN place % 2 = 1 THEN 'user'
    ELSE 'assistant' END || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY k)) AS sha
  FROM edited GROUP BY conv
), every AS (
  SELECT DISTINCT conv_id, coalesce(CAST(conv_id AS VARCHAR), '') AS conv FROM conversations
)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
  CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, coalesce(found.c, 0) AS cost,
  coalesce(found.a, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM every LEFT JOIN chosen USING (conv) LEFT JOIN repaired USING (conv)
"""
