"""Operator 10: URL rules and a blocked Bloom filter over listed canonical URLs.

Listed URLs set one bit in each of the eight 32-bit words of one block. A page whose canonical URL
finds all its eight bits is a possible hit; an exact hash join on the canonical URL then removes
the false positives. The filter's blocks are at most 2^20 rows of 40 bytes, which bounds what is
broadcast whatever the length of the list: a longer list only lets more false positives through
to the join, and no listed URL is ever missed.

Defined results: a null URL or one without `://` has an empty host and path, is matched by no rule
and no list entry, and is allowed; repeated rows each get a verdict; empty tables give no rows;
null, empty and host-less list entries are ignored; other columns of the pages are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskengine.llm.common import ascii_lower, kept_as, whole_text
from riskengine.session import materialize

# Rules as (host, path, verdict).
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
MAX_BLOCKS = 1 << 20
KEYS_PER_BLOCK = 16
# Words of a block, and bits of each word; a second hash of the key gives five bits to each word.
WORDS, WORD_BITS = 8, 5
# Query parameters that only track the visit.
TRACKING = r"^(?:utm_[^=]*|ref|fbclid|gclid)(?:=|$)"


# Pages with less HTML for each link than this are taken for link farms.
CHARS_PER_LINK = 200
LINK = "<a "


def link_farms(pages: DataFrame, chars_per_link: int = CHARS_PER_LINK) -> DataFrame:
    """url of the pages (url, html) that are mostly links; a null html has none."""
    html = whole_text("html")
    links = (F.length(html) - F.length(F.replace(html, F.lit(LINK)))) / len(LINK)
    return kept_as(pages, url="url", html="html").where(links * chars_per_link > F.length(html)).select("url")


def url_host(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical_url(url: Column) -> Column:
    """Host without `www.` and default port, path without a closing `/`, other parameters sorted."""
    host = F.regexp_replace(F.regexp_replace(url_host(url), r"^www\.", ""), r":(?:80|443)?$", "")
    path = F.regexp_replace(url_path(url), r"/+$", "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(kept), "&"))).otherwise(F.lit(""))
    return F.when(host != "", F.concat(host, path, tail))


def _fits(host: Column, path: Column, rule: tuple[str, str, str]) -> Column:
    return ((host == rule[0]) | host.endswith(f".{rule[0]}")) & path.startswith(rule[1])


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule as text, and its verdict; null where none fits."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        fits = _fits(host, path, rule)
        name = F.when(fits, F.lit(rule[0] + rule[1])).otherwise(name)
        verdict = F.when(fits, F.lit(rule[2])).otherwise(verdict)
    return name, verdict


def _place(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """Block of a key and its bit in each word of that block."""
    block = F.pmod(F.xxhash64(F.lit(1), key), F.lit(blocks))
    second = F.xxhash64(F.lit(2), key)
    places = [F.shiftrightunsigned(second, WORD_BITS * i).bitwiseAND((1 << WORD_BITS) - 1) for i in range(WORDS)]
    return block, [F.call_function("shiftleft", F.lit(1).cast("long"), p.cast("int")) for p in places]


def bloom_blocks(keys: DataFrame, blocks: int) -> DataFrame:
    """The filter as rows (block, w0..w7) from `key`, or-ed together on the map side first."""
    block, bits = _place(F.col("key"), blocks)
    words = keys.select(block.alias("block"), *(b.alias(f"w{i}") for i, b in enumerate(bits)))
    return words.groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(len(bits))))


def judge_urls(pages: DataFrame, listed: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, bloom_hit, listed for every page (page_id, url).

    `listed` has `url`: pages that no rule fits are blocked if their canonical URL is listed.
    """
    keys = listed.select(canonical_url(whole_text("url")).alias("key")).where("key is not null").distinct()
    keys = materialize(keys, "listed-urls")
    blocks = min(MAX_BLOCKS, max(1, -(-keys.count() // KEYS_PER_BLOCK)))
    filter_rows = bloom_blocks(keys, blocks).withColumnRenamed("block", "f_block")

    url = whole_text("url")
    parsed = kept_as(pages, page_id="page_id", url="url").select(
        "page_id", url_host(url).alias("host"), url_path(url).alias("path"), canonical_url(url).alias("key")
    )
    block, bits = _place(F.col("key"), blocks)
    all_set = F.lit(True)
    for i, bit in enumerate(bits):
        all_set = all_set & (F.col(f"w{i}").bitwiseAND(bit) != 0)
    # At most MAX_BLOCKS rows: a proven bound for the broadcast.
    tested = (
        parsed.withColumn("block", block)
        .join(F.broadcast(filter_rows), F.col("block") == F.col("f_block"), "left")
        .withColumn("bloom_hit", F.coalesce(F.col("key").isNotNull() & all_set, F.lit(False)))
        .select("page_id", "host", "path", "key", "bloom_hit")
    )
    # Only possible hits carry a join key; the others would all be sent to one task as nulls.
    hit = tested.where("bloom_hit").join(keys.withColumn("listed", F.lit(True)), "key", "left")
    miss = tested.where("not bloom_hit").withColumn("listed", F.lit(False))
    columns = ["page_id", "host", "path", "bloom_hit", "listed"]
    both = hit.withColumn("listed", F.coalesce("listed", F.lit(False))).select(columns).unionByName(miss.select(columns))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return both.withColumn("rule", rule).withColumn(
        "verdict", F.coalesce(verdict, F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow")))
    )
