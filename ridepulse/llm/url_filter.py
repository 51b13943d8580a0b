"""URL filters: rules and listed URLs behind a blocked Bloom filter.

Listed keys go into a blocked Bloom filter: one 64-bit word per block, a key's
bits all in the word its hash picks, so a probe reads one word. Each URL is
probed with its canonical form and with the (host suffix, path prefix) pairs a
rule could have; probes that the filter lets pass meet the exact keys in a
hash join, which removes the filter's false positives. All steps are SQL
functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BITS = 6  # bits set per key
_KEYS_PER_WORD = 4
# Filters of up to this many words (8 bytes each) are sent to every executor; larger ones are joined by block.
_BROADCAST_WORDS = 1 << 20
# A canonical URL and a rule never share a key: control characters do not occur in rule keys.
_URL_MARK = "\x01"


def url_host(url: Column) -> Column:
    """What stands after the first :// up to /, ?, # or the end, A-Z in lower case; empty without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host and path without scheme, query, fragment, a leading www. and a trailing slash."""
    host, path = F.regexp_replace(url_host(url), r"^www\.", ""), F.regexp_replace(url_path(url), "/+$", "")
    return F.concat(host, path)


def _word(h: Column) -> Column:
    """The bits a hash sets: six 6-bit fields of its upper half."""
    bits = [F.expr(f"shiftleft(1L, cast(shiftrightunsigned(_h, {28 + 6 * i}) & 63 as int))") for i in range(_BITS)]
    out = bits[0]
    for b in bits[1:]:
        out = out.bitwiseOR(b)
    return out


def _hashed(keys: DataFrame, words: int) -> DataFrame:
    return (
        keys.withColumn("_h", F.xxhash64("key"))
        .withColumn("_block", F.col("_h").bitwiseAND(F.lit(words - 1)))
        .withColumn("_mask", _word(F.col("_h")))
    )


def bloom_filter(keys: DataFrame, n_keys: int) -> tuple[DataFrame, int]:
    """(_block, _word) rows of a filter over ``keys`` (key), and its number of words (a power of two)."""
    words = 1 << max(4, (n_keys // _KEYS_PER_WORD).bit_length())
    return _hashed(keys, words).groupBy("_block").agg(F.bit_or("_mask").alias("_word")), words


def possible(probes: DataFrame, filter_rows: DataFrame, words: int) -> DataFrame:
    """The rows of ``probes`` (with a column key) that the filter lets pass: all listed keys and few others."""
    side = F.broadcast(filter_rows) if words <= _BROADCAST_WORDS else filter_rows
    return (
        _hashed(probes, words).join(side, "_block")
        .where(F.col("_word").bitwiseAND(F.col("_mask")) == F.col("_mask"))
        .drop("_h", "_block", "_mask", "_word")
    )


def filter_urls(pages: DataFrame, rules: DataFrame, listed: DataFrame, rule_lengths: list[int]) -> DataFrame:
    """Judge every row of ``pages`` (page_id, url; other columns are ignored).

    rules: (host, path, verdict), unique by host and path; a rule fits its host and all
    subdomains if the URL's path starts with the rule's path; the longest
    wins. listed: (url) to block where no rule fits. rule_lengths: the path
    lengths that occur in ``rules``.

    Returns page_id, host, path, rule (host and path of the rule, or null),
    verdict. A null URL, or one without ://, has empty host and path, no rule
    and is not listed: allowed. Equal rows stay as many rows.
    """
    exact = (
        rules.select(F.concat("host", "path").alias("key"), F.length("host").alias("_host_len"), "verdict")
        .unionByName(
            listed.select(F.concat(F.lit(_URL_MARK), canonical(F.col("url"))).alias("key"))
            .where(F.col("key") != _URL_MARK).distinct()
            .select("key", F.lit(-1).alias("_host_len"), F.lit("block").alias("verdict"))
        )
    )
    n_keys = exact.count()
    filter_rows, words = bloom_filter(exact, n_keys)

    urls = pages.select("url").where("url is not null").distinct()
    urls = urls.withColumn("host", url_host(F.col("url"))).withColumn("path", url_path(F.col("url")))
    labels = F.split("host", r"\.", -1)
    suffix = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    lengths = F.filter(F.array(*map(F.lit, rule_lengths)), lambda n: n <= F.length("path"))
    pairs = F.flatten(
        F.transform(
            suffix,
            lambda s: F.transform(
                lengths, lambda n: F.struct(F.concat(s, F.substring(F.col("path"), F.lit(1), n)).alias("key"), F.length(s).alias("_host_len"))
            ),
        )
    )
    own = F.array(F.struct(F.concat(F.lit(_URL_MARK), canonical(F.col("url"))).alias("key"), F.lit(-1).alias("_host_len")))
    probes = urls.where("host <> ''").select("url", F.explode(F.concat(own, pairs)).alias("_p")).select("url", "_p.key", "_p._host_len")
    hits = possible(probes, filter_rows, words).join(exact, ["key", "_host_len"])
    # a rule beats the list (length -1); the longest rule wins, on a tie the one with the longer host
    best = hits.groupBy("url").agg(
        F.max(
            F.struct(
                F.when(F.col("_host_len") < 0, -1).otherwise(F.length("key")).alias("n"), "_host_len", "key", "verdict"
            )
        ).alias("_best")
    )
    return pages.select("page_id", "url").join(best, "url", "left").select(
        "page_id",
        url_host(F.col("url")).alias("host"),
        url_path(F.col("url")).alias("path"),
        F.when(F.col("_best.n") >= 0, F.col("_best.key")).alias("rule"),
        F.coalesce(F.col("_best.verdict"), F.lit("allow")).alias("verdict"),
    )
