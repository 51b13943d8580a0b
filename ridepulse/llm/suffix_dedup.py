"""Exact substring removal over suffix arrays of shards.

A byte goes if a ``width``-byte string that covers it also starts in a
document with a smaller doc_id. Equal strings meet in one shard by their
anchors (``passages``). Whole runs of windows with equal text are one name
there; texts that share an anchor but differ are indexed: the shard's suffix
array is built by induced sorting (``suffixes``), and permuted common prefixes
of ``width`` bytes or more group equal windows.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridepulse.llm.passages import Rule, Units, covered, groups
from ridepulse.llm.suffixes import common_prefixes, suffix_array

WIDTH, GRAM = 50, 16
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _least(values: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Each row's least value of its group (rows sorted by group)."""
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    return np.minimum.reduceat(values, starts)[group] if len(starts) else values


def _settle(t: dict) -> tuple[np.ndarray, np.ndarray]:
    """Runs in a document after their text's first one are covered; those of the first go on."""
    order, group = groups(t["anchor"], t["run"])
    later = t["doc"][order] > _least(t["doc"][order], group)
    return order[later], np.sort(order[~later])


def matcher(width: int):
    def match(data: np.ndarray, length: np.ndarray, doc: np.ndarray) -> np.ndarray:
        n, text = len(length), np.repeat(np.arange(len(length)), length)
        at = np.arange(len(data)) + text  # a mark after each text
        s = np.zeros(len(data) + n, np.int64)
        s[at] = data.astype(np.int64) + 1
        order = suffix_array(s)
        prefix = common_prefixes(s, order)
        ends = np.cumsum(length + 1) - 1
        owner = np.searchsorted(ends, np.arange(len(s)))
        window = np.arange(len(s)) + width <= ends[owner]
        order = order[window[order]]
        # a suffix left out has no common prefix of ``width`` with its neighbours
        group = np.cumsum(prefix[order] < width)
        group -= group[0] if len(group) else 0
        hit = np.zeros(len(s), bool)
        owners = doc[owner[order]]
        hit[order] = owners > _least(owners, group)
        return hit[at]

    return match


def _digest(text: bytes, mask: np.ndarray | None) -> tuple[int, int, int, str]:
    if mask is None:
        return len(text), 0, 0, hashlib.sha256(text).hexdigest()
    gone = np.zeros(len(text) + 1, bool)
    gone[: len(mask)] = mask
    kept = np.frombuffer(text, np.uint8)[~gone[:-1]].tobytes()
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, **rule) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of ``docs`` (doc_id, text).

    Texts are UTF-8 bytes, null the empty text. Matches never cross documents.
    Rows with equal doc_id are no smaller than each other and keep what they
    share. A row without a doc_id keeps all and removes nothing elsewhere.
    Other columns are ignored; an empty table gives no rows.
    """
    how = Rule(width, gram, Units.of_bytes, _settle, matcher(width), needs_id=True, **rule)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return covered(rows, how, _digest, SCHEMA)
