"""The registered queries of the corpus operators: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridepulse.llm import (
    conversations,
    decontaminate,
    hamming_search,
    language,
    licenses,
    mixing,
    oracle,
    personal_data,
    rlz_dedup,
    simhash,
    spelling,
    suffix_dedup,
    token_files,
    url_filter,
)
from ridepulse.llm.common import ready, table
from ridepulse.session import new_work_dir

# Fixed value: the id appended to every document.
END_ID = 2


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


# The rules of the URL filter as (host, path, verdict).
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
# First host labels whose pages make up the list of URLs to block.
LISTED_LABELS = ["spam-farm", "cheap-pills", "adult-x", "free-bets"]


def listed_urls(pages: DataFrame) -> DataFrame:
    """The list of URLs to block: those in ``pages`` under a host with a listed label."""
    host = url_filter.url_host(F.col("url"))
    return pages.select("url").where(F.arrays_overlap(F.split(host, r"\."), F.array(*map(F.lit, LISTED_LABELS))))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    lengths = sorted({len(path) for _, path, _ in URL_RULES})
    return url_filter.filter_urls(pages, rules, listed_urls(pages), lengths)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return licenses.scan(table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    ready(spark)
    docs = table(spark, sf_dir, "documents") if docs is None else docs
    path = new_work_dir(spark, "token-files")
    token_files.write_token_files(docs, path, public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return token_files.token_digest(spark, path)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return language.identify(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return mixing.mix(table(spark, sf_dir, "documents")).drop("text_hash")


def op8_rlz_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return rlz_dedup.remove_repeats(table(spark, sf_dir, "documents"))


# Parameter: neighbours a query vector gets.
NEIGHBORS = 10


def op9_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return hamming_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=NEIGHBORS)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# Fixed value: a run of letters is misspelt where this divides its checksum.
SLIP = 31


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return spelling.variants(spelling.count_words(table(spark, sf_dir, "documents"), SLIP))


# Conversations of one group share openings of so many turns at most.
OPENING_GROUP, OPENING_TURNS = 20, 3


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    turns = conversations.number_turns(table(spark, sf_dir, "conversations"))
    return conversations.prefix_trie(conversations.share_openings(turns, OPENING_GROUP, OPENING_TURNS))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return personal_data.scan(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_url_filter": op2_url_filter,
    "op3_license_scan": op3_license_scan,
    "op4_token_files": op4_token_files,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_language_id": op6_language_id,
    "op7_mixing": op7_mixing,
    "op8_rlz_dedup": op8_rlz_dedup,
    "op9_top_k_search": op9_top_k_search,
    "op10_decontaminate": op10_decontaminate,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_personal_data": op13_personal_data,
}
ORACLE_SQL = {
    "op2_url_filter": oracle.urls(URL_RULES, LISTED_LABELS),
    "op3_license_scan": oracle.license_scan(),
    "op5_suffix_dedup": oracle.byte_repeats(),
    "op7_mixing": oracle.mix(),
    "op8_rlz_dedup": oracle.word_repeats(),
    "op9_top_k_search": oracle.top_k(NEIGHBORS),
    "op11_spelling_variants": oracle.variants(SLIP),
    "op12_conversation_trie": oracle.trie(OPENING_GROUP, OPENING_TURNS),
}
