"""URL filter: a blocked Bloom filter passes possible hits of a listing to an exact join.

Only DataFrame functions are used. A listing has two kinds of entries: rules (a host with its subdomains and a path prefix)
and pages (one canonical URL).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cohortflow.llm.text import lower_ascii
from cohortflow.plans.lineage import BROADCAST_ROWS, is_small

#: A block is four 64-bit words; a key sets two bits in each word of its block.
WORDS = 4
KEYS_PER_BLOCK = 16


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_page(url: Column) -> Column:
    """Host without a leading ``www.`` or ``m.``, path without ``.html`` and closing slashes; scheme, query and fragment go."""
    host = F.regexp_replace(host_of(url), r"^(www|m)\.", "")
    return F.concat(host, F.regexp_replace(F.regexp_replace(path_of(url), r"\.html$", ""), "/+$", ""))


def _words(key: Column) -> list[Column]:
    """The two bits that a key sets in each word of its block, from 12 hash bits per word."""
    bits = F.xxhash64(F.lit("bits"), key)
    masks = []
    for w in range(WORDS):
        one, two = (F.shiftrightunsigned(bits, 12 * w + 6 * j).bitwiseAND(F.lit(63)).cast("int") for j in (0, 1))
        masks.append(F.call_function("shiftleft", F.lit(1).cast("long"), one).bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), two)))
    return masks


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), key), F.lit(blocks))


def bloom_blocks(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, w0..w3): one row per block that any key falls into."""
    rows = keys.select(_block(F.col(key), blocks).alias("block"), *[m.alias(f"w{w}") for w, m in enumerate(_words(F.col(key)))])
    return rows.groupBy("block").agg(*[F.bit_or(f"w{w}").alias(f"w{w}") for w in range(WORDS)])


def possible_hits(rows: DataFrame, key: str, filter_blocks: DataFrame, blocks: int) -> DataFrame:
    """The rows whose key may be listed. The filter is broadcast if a bounded count proves it small, else joined by block."""
    bloom = filter_blocks.select(F.col("block").alias("_block"), *[F.col(f"w{w}").alias(f"_w{w}") for w in range(WORDS)])
    bloom = F.broadcast(bloom) if is_small(filter_blocks, BROADCAST_ROWS) else bloom
    tested = rows.withColumns({"_block": _block(F.col(key), blocks), **{f"_m{w}": m for w, m in enumerate(_words(F.col(key)))}})
    hit = tested.join(bloom, "_block")
    for w in range(WORDS):
        hit = hit.filter(F.col(f"_w{w}").bitwiseAND(F.col(f"_m{w}")) == F.col(f"_m{w}"))
    return hit.select(*rows.columns)


def rule_entries(rules: DataFrame) -> DataFrame:
    """rule, verdict -> listing entries. A rule is ``host/`` or ``host/path/``: its path is a whole number of folders."""
    return rules.select(F.concat(F.lit("rule:"), F.col("rule")).alias("key"), F.col("rule").alias("entry"), "verdict", F.lit(True).alias("is_rule"))


def page_entries(pages: DataFrame) -> DataFrame:
    """page (canonical URL) -> listing entries that block."""
    return pages.select(F.concat(F.lit("page:"), F.col("page")).alias("key"), F.col("page").alias("entry"), F.lit("block").alias("verdict"), F.lit(False).alias("is_rule"))


def _candidates(urls: DataFrame, listing: DataFrame) -> DataFrame:
    """url, key: every (parent host, parent folder) of a url, no deeper than any listed rule, and its canonical page."""
    rules = listing.filter("is_rule").select("entry")
    depth = rules.agg(
        F.coalesce(F.max(F.size(F.split(F.substring_index(F.col("entry"), "/", 1), r"\."))), F.lit(0)).alias("hosts"),
        F.coalesce(F.max(F.size(F.split("entry", "/")) - 1), F.lit(0)).alias("folders"),
    ).first()
    labels = F.split("host", r"\.")
    folders = F.split("path", "/")
    n_labels, n_folders = F.size(labels), F.size(folders) - 1
    empty = F.array().cast("array<string>")
    hosts = F.when(F.lit(depth["hosts"] > 0), F.transform(F.sequence(F.lit(1), F.least(n_labels, F.lit(max(depth["hosts"], 1)))), lambda k: F.call_function("substring_index", F.col("host"), F.lit("."), -k))).otherwise(empty)
    paths = F.when(
        (n_folders > 0) & F.lit(depth["folders"] > 0),
        F.transform(F.sequence(F.lit(1), F.greatest(F.least(n_folders, F.lit(max(depth["folders"], 1))), F.lit(1))), lambda k: F.concat(F.call_function("substring_index", F.col("path"), F.lit("/"), k), F.lit("/"))),
    ).otherwise(empty)
    with_parts = urls.select("url", F.col("page").alias("_page"), hosts.alias("_hosts"), paths.alias("_paths"))
    keys = F.flatten(F.transform("_hosts", lambda h: F.transform("_paths", lambda p: F.concat(F.lit("rule:"), h, p))))
    return with_parts.select("url", F.explode(F.concat(keys, F.array(F.concat(F.lit("page:"), F.col("_page"))))).alias("key"))


def judge_urls(pages: DataFrame, listing: DataFrame, url: str = "url") -> DataFrame:
    """Every row of ``pages`` with host, path, rule and verdict.

    The longest listed rule that fits decides. Without one the verdict is ``block`` if the canonical page is listed, else
    ``allow``, and the rule is null. Each distinct url is judged once, so a url that many rows share costs one judgement.
    A null url, or one without ``://``, has an empty host and path and is allowed. Columns of ``pages`` named like a
    result are replaced by it. Entries are (key, entry, verdict, is_rule); if one key is listed twice, ``block`` wins.
    """
    results = ("host", "path", "rule", "verdict")
    rest = [c for c in pages.columns if c not in results]
    packed = pages.select(F.struct(*rest).alias("_row"), F.col(url).alias("url"))
    distinct = packed.filter(F.col("url").contains("://")).select("url").distinct()
    urls = distinct.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), canonical_page(F.col("url")).alias("page"))
    listing = listing.groupBy("key", "entry", "is_rule").agg(F.max("verdict").alias("verdict"))  # "block" > "allow"
    size = listing.count()
    blocks = max(1, -(-size // KEYS_PER_BLOCK))
    maybe = possible_hits(_candidates(urls, listing), "key", bloom_blocks(listing, "key", blocks), blocks)
    hits = maybe.join(F.broadcast(listing) if size <= BROADCAST_ROWS else listing, "key")
    best = hits.groupBy("url").agg(
        F.max(F.when(F.col("is_rule"), F.struct(F.length("entry").alias("n"), "entry", "verdict"))).alias("_best"),
        F.max(~F.col("is_rule")).alias("_listed"),
    )
    joined = packed.join(best, "url", "left")
    verdict = F.coalesce(F.col("_best")["verdict"], F.when(F.col("_listed"), "block"), F.lit("allow"))
    return joined.select(
        *[F.col("_row")[c].alias(c) for c in rest],
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        F.col("_best")["entry"].alias("rule"),
        verdict.alias("verdict"),
    )


def repeated_pages(pages: DataFrame, url: str = "url") -> DataFrame:
    """page: the canonical URLs that more than one row has, that is, pages fetched again under any spelling."""
    page = pages.filter(F.col(url).contains("://")).select(canonical_page(F.col(url)).alias("page"))
    return page.groupBy("page").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("page")
