"""URL filter: allow and block rules, then a list of canonical URLs.

A rule is a host and the start of a path; it fits the host and its subdomains, and
the longest rule that fits decides. Other URLs are looked up in a list. The list
becomes a blocked Bloom filter: a table of blocks of 256 bits, in which each listed
URL sets eight bits of one block (aggregated with ``bit_or``, so a block is built
map-side). A URL reads the one block its hash names; only possible hits go on to an
exact hash join with the list, which removes the false ones.

Both joins are on evenly spread keys: the block, then the URL itself (rows that
cannot be hits carry a key made of id and URL and match nothing). A URL that many pages
share, or a row that repeats, is a skewed key that adaptive execution splits on the page
side; the list side is unique. Spark broadcasts a side only when its measured size allows.

Defined cases: null URLs and URLs without ``://`` have empty host and path, no rule
and no entry, so they are allowed; null and repeated list entries count once or
not at all; null ids and repeated rows stay; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelight.llm.common import store

ALLOW, BLOCK = "allow", "block"
PER_BLOCK = 16  # listed URLs to a block of 256 bits
LANES = 4  # 64-bit words of a block; two bits are set in each

# Query parameters that name a visit and not a page.
TRACKING = ["ref", "fbclid", "gclid"]
TRACKING_START = "utm_"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _rest(url: Column) -> Column:
    """What follows the first ``://``, or null."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.``, path without trailing slashes, and the parameters
    that are not tracking, sorted; null where there is no host."""
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)

    def lasting(part: Column) -> Column:
        name = F.substring_index(part, "=", 1)
        return (part != "") & ~name.isin(*TRACKING) & ~name.startswith(TRACKING_START)

    parts = F.array_sort(F.filter(F.split(query, "&"), lasting))
    tail = F.when(F.size(parts) > 0, F.concat(F.lit("?"), F.array_join(parts, "&")))
    return F.when(host != "", F.concat(host, path, F.coalesce(tail, F.lit(""))))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest fitting rule, or null. ``rules``:
    (verdict, 'host/path'); the first slash starts the path."""
    found = []
    for verdict, text in rules:
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        entry = F.struct(
            F.lit(len(text)).alias("size"), F.lit(len(name)).alias("host"),
            F.lit(text).alias("rule"), F.lit(verdict).alias("verdict"),
        )
        found.append(F.when(fits, entry))
    if not found:
        return F.lit(None).cast("struct<size:int,host:int,rule:string,verdict:string>")
    # Longest; of equally long ones the one with the longer host.
    return F.array_max(F.array(*found))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _mask(key: Column, lane: int) -> Column:
    """Two bits of a lane, from a second hash."""
    bits = F.xxhash64(key, F.lit(1))

    def bit(place: int) -> Column:
        six = F.shiftrightunsigned(bits, 6 * place).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("long"), six)

    return bit(2 * lane).bitwiseOR(bit(2 * lane + 1))


def bloom_filter(listed: DataFrame, key: str) -> tuple[DataFrame, int]:
    """(block, w0..w3) of the listed keys, and the number of blocks."""
    blocks = max(1, -(-listed.count() // PER_BLOCK))
    table = listed.groupBy(_block(F.col(key), blocks).alias("_block")).agg(
        *[F.bit_or(_mask(F.col(key), k)).alias(f"w{k}") for k in range(LANES)]
    )
    return table, blocks


def judge(
    pages: DataFrame,
    listed: DataFrame,
    rules: Sequence[tuple[str, str]],
    id_column: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """id, host, path, rule, verdict, and how a listed URL was found:
    ``possible`` (passed the filter) and ``listed`` (is in the list).

    ``listed`` has a column ``url``; entries are made canonical here.
    """
    entries = listed.select(canonical(F.col("url")).alias("_entry"))
    entries, _ = store(entries.where(F.col("_entry").isNotNull()).distinct(), "listed")
    table, blocks = bloom_filter(entries, "_entry")
    table, _ = store(table, "bloom")
    given = pages.select(F.col(id_column).alias("_id"), F.col(url).alias("_url"))
    split = given.select(
        "_id", "_url",
        host_of(F.col("_url")).alias("host"),
        path_of(F.col("_url")).alias("path"),
        canonical(F.col("_url")).alias("_key"),
    )
    ruled = split.withColumn("_rule", rule_for(F.col("host"), F.col("path"), rules))
    # Missing and ruled URLs need no look-up, whatever share of the pages they are:
    # blocks below 0 do not exist, and id and URL spread such rows over them.
    idle = -1 - F.pmod(F.xxhash64("_id", "_url"), F.lit(1 << 62))
    wanted = F.col("_key").isNotNull() & F.col("_rule").isNull()
    probed = ruled.withColumn(
        "_block", F.when(wanted, _block(F.col("_key"), blocks)).otherwise(idle)
    ).join(table, "_block", "left")
    hit = F.lit(True)
    for k in range(LANES):
        mask = _mask(F.col("_key"), k)
        hit = hit & (F.col(f"w{k}").bitwiseAND(mask) == mask)
    possible = wanted & F.coalesce(hit, F.lit(False))
    own = F.concat(F.lit("\u0000"), F.xxhash64("_id", "_url").cast("string"))
    checked = probed.withColumn("possible", possible).withColumn(
        "_look", F.when(F.col("possible"), F.col("_key")).otherwise(own)
    )
    exact = entries.withColumnRenamed("_entry", "_look").withColumn("_in", F.lit(True))
    joined = checked.join(exact, "_look", "left")
    in_list = F.coalesce(F.col("_in"), F.lit(False))
    return joined.select(
        F.col("_id").alias(id_column),
        "host",
        "path",
        F.col("_rule.rule").alias("rule"),
        F.coalesce(
            F.col("_rule.verdict"), F.when(in_list, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
        ).alias("verdict"),
        "possible",
        in_list.alias("listed"),
    )
