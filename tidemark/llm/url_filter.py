"""URL filter: a blocked Bloom filter of listed canonical URLs, and an exact join for what passes it.

The filter is a table with one row per block of eight 64-bit words; a URL picks one block and sets one bit in each
word. Building it is one aggregate (`bit_or` per word and block). Its size is the number of blocks, a parameter, and
not the size of the list, so the planner may broadcast it whatever the list holds. A longer list only raises the share
of false positives, and all of those are removed by the exact hash join on the canonical URL. URLs that do not pass
never meet the list. Everything is built-in functions.

Defined results: a null URL, or one without `://`, has empty host and path, fits no rule and is never listed (verdict
allow). Repeated rows are judged one by one. Nulls in the list are ignored, an empty list blocks nothing, an empty table
of URLs gives no rows. Further columns of the input are kept by `filter_urls`; a column called like one of the added
ones is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.tables import table

# Fixed values of the query: (verdict, host, path) of each rule.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
# Fixed values of the query: parts of host names that put a host's URLs on the list.
LISTED_HOST_PARTS = ["adult", "ads", "bets", "casino", "pills", "spam"]
# Parameters of a query string that do not change the page.
TRACKING = r"^(utm_[a-z_]*|ref|fbclid|gclid)(=|$)"
BLOCKS = 1 << 14  # of 64 bytes: 1 MB
WORDS = 8


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url: Column) -> dict[str, Column]:
    """Host (lower case), path and query of a URL; all empty without a scheme."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    tail = F.substr(rest, F.length(F.regexp_extract(rest, "^[^/?#]*", 0)) + 1)
    return {
        "host": ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)),
        "path": F.regexp_extract(tail, "^[^?#]*", 0),
        "query": F.regexp_extract(tail, r"^[^?#]*\?([^#]*)", 1),
    }


def canonical(host: Column, path: Column, query: Column) -> Column:
    """One spelling per page: no scheme, fragment, default port, closing slash or tracking; parameters in order."""
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~ascii_lower(p).rlike(TRACKING)))
    shown = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.concat(F.regexp_replace(host, ":(80|443)$", ""), F.regexp_replace(path, "/+$", ""), shown)


def with_canonical(pages: DataFrame, url: str) -> DataFrame:
    """Adds host, path and canonical (null where the URL has no host)."""
    parts = url_parts(F.col(url))
    found = pages.withColumns({"host": parts["host"], "path": parts["path"], "__query": parts["query"]})
    name = F.when(F.col("host") != "", canonical(F.col("host"), F.col("path"), F.col("__query")))
    return found.withColumn("canonical", name).drop("__query")


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (verdict, rule) of the longest rule that fits, or null. Rules are a short list given by the caller."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(h + p).alias("rule"))).otherwise(found)
    return found


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("block")), F.lit(blocks))


def bits_of(key: Column) -> list[Column]:
    """One bit per word of the block, cut from two hashes of the key."""
    hashes = [F.xxhash64(key, F.lit("low")), F.xxhash64(key, F.lit("high"))]
    places = [F.shiftrightunsigned(hashes[i // 4], 6 * (i % 4)).bitwiseAND(F.lit(63)).cast("int") for i in range(WORDS)]
    return [F.call_function("shiftleft", F.lit(1).cast("bigint"), place) for place in places]


def blocked_bloom(keys: DataFrame, key: str, blocks: int = BLOCKS) -> DataFrame:
    """The filter as a table: __block and __w0 to __w7. Never more than `blocks` rows."""
    bits = keys.select(
        block_of(F.col(key), blocks).alias("__block"), *[b.alias(f"__b{i}") for i, b in enumerate(bits_of(F.col(key)))]
    )
    return bits.groupBy("__block").agg(*[F.bit_or(f"__b{i}").alias(f"__w{i}") for i in range(WORDS)])


def filter_urls(
    pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]] = (), url: str = "url", blocks: int = BLOCKS
) -> DataFrame:
    """Adds host, path, canonical, listed, rule and verdict to every row of `pages`.

    `listed` has a column `canonical`. A rule decides before the list; the list blocks; all else is allowed.
    """
    keys = listed.select(F.col("canonical").alias("__listed")).filter("__listed IS NOT NULL").distinct()
    bloom = blocked_bloom(keys, "__listed", blocks)
    named = with_canonical(pages, url)
    own = [c for c in named.columns if c not in ("rule", "verdict", "listed")]
    probed = named.select(*own, block_of(F.col("canonical"), blocks).alias("__at")).join(
        F.broadcast(bloom), F.col("__at") == F.col("__block"), "left"
    )
    hit = F.col("__block").isNotNull() & F.col("canonical").isNotNull()
    for i, bit in enumerate(bits_of(F.col("canonical"))):
        hit = hit & (F.col(f"__w{i}").bitwiseAND(bit) != 0)
    probed = probed.select(*own, F.coalesce(hit, F.lit(False)).alias("__possible"))
    passed = probed.filter("__possible").join(keys, F.col("canonical") == F.col("__listed"), "left")
    judged = passed.select(*own, F.col("__listed").isNotNull().alias("listed")).unionByName(
        probed.filter("NOT __possible").select(*own, F.lit(False).alias("listed"))
    )
    rule = longest_rule(F.col("host"), F.col("path"), list(rules))
    by_list = F.when(F.col("listed"), "block").otherwise("allow")
    return (
        judged.withColumn("__rule", rule)
        .withColumns({"rule": F.col("__rule.rule"), "verdict": F.coalesce(F.col("__rule.verdict"), by_list)})
        .drop("__rule")
    )


def abusive_urls(pages: DataFrame, parts: list[str], url: str = "url") -> DataFrame:
    """Canonical URLs of all pages on hosts whose name has one of the given parts: the list of the query."""
    named = with_canonical(pages, url)
    return named.filter(F.arrays_overlap(F.split("host", "[.-]"), F.array(*map(F.lit, parts)))).select("canonical")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = filter_urls(pages, abusive_urls(pages, LISTED_HOST_PARTS), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "listed")


OP1_SQL = """
WITH cut AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), named AS (
    SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS shown,
           regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
    FROM cut
), hosts AS (
    SELECT page_id, translate(shown, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM named
), rules(kind, h, p) AS (
    VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
           ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), fits AS (
    SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(kind, length(h || p)) AS kind
    FROM hosts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
    GROUP BY page_id
), judged AS (
    SELECT hosts.page_id, host, path, rule, kind,
           list_has_any(regexp_split_to_array(host, '[.-]'), ['adult', 'ads', 'bets', 'casino', 'pills', 'spam']) AS listed
    FROM hosts LEFT JOIN fits ON hosts.page_id = fits.page_id
)
SELECT page_id, host, path, rule, coalesce(kind, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, listed
FROM judged
"""
