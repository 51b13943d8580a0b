"""Substring removal by relative Lempel-Ziv parsing.

A word goes if a window of ``width`` words that covers it also starts anywhere
else. Texts that share an anchor meet in one reference block (``passages``);
no other block can hold a window of theirs. The block is indexed by a suffix
array over its words, and each text is factored greedily: the longest match
elsewhere in the block is a factor, the next factor starts where it ends.
Factors of ``width`` words or more are duplicate spans. A greedy factor may
end inside another match, so the windows across each factor boundary are
checked as well. Runs of equal text are one factor by name.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridepulse.llm.passages import Rule, Units, covered, groups
from ridepulse.llm.suffixes import common_prefixes, suffix_array

WIDTH, GRAM = 35, 8
SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _settle(t: dict) -> tuple[np.ndarray, np.ndarray]:
    """Runs whose text stands twice are covered; one row of each text goes on, with its number of copies (2 at most)."""
    order, group = groups(t["anchor"], t["run"])
    copies = np.minimum(np.bincount(group, t["copies"][order], group[-1] + 1 if len(group) else 0), 2).astype(np.int64)
    first = order[np.flatnonzero(np.diff(group, prepend=-1))]
    t["copies"][first] = copies
    return order[copies[group] > 1], np.sort(first)


def matcher(width: int):
    def longest(s: np.ndarray, room: np.ndarray) -> np.ndarray:
        """For each position the longest match with another one, inside its own text."""
        order = suffix_array(s)
        with_before = common_prefixes(s, order)
        with_after = np.zeros(len(s), np.int64)
        with_after[order[:-1]] = with_before[order[1:]]
        return np.minimum(np.maximum(with_before, with_after), room)

    def match(data: np.ndarray, length: np.ndarray, doc: np.ndarray) -> np.ndarray:
        n, text = len(length), np.repeat(np.arange(len(length)), length)
        at = np.arange(len(data)) + text
        ends = np.cumsum(length + 1) - 1
        s = np.empty(len(data) + n, np.int64)
        s[at] = np.unique(data, return_inverse=True)[1] + n
        s[ends] = np.arange(n)  # a mark of its own after each text
        owner = np.searchsorted(ends, np.arange(len(s)))
        match_ = longest(s, ends[owner] - np.arange(len(s)))
        hit = np.zeros(len(s) + 1, np.int64)
        pos = ends - length
        while len(pos):  # all texts take their next factor together
            factor = match_[pos]
            whole = factor >= width
            np.add.at(hit, pos[whole], 1)
            np.add.at(hit, pos[whole] + factor[whole] - width + 1, -1)
            # windows that start in the last width - 1 words before the boundary
            boundary = pos + np.maximum(factor, 1)
            across = (np.maximum(boundary - width + 1, pos)[:, None] + np.arange(width - 1))
            across = across[across < boundary[:, None]]
            across = across[match_[across] >= width]
            np.add.at(hit, across, 1)
            np.add.at(hit, across + 1, -1)
            pos = boundary[boundary < ends[owner[pos]]]
        return (np.cumsum(hit[:-1]) > 0)[at]

    return match


def _digest(text: bytes, mask: np.ndarray | None) -> tuple[int, int, str]:
    words = text.split()
    gone = 0
    if mask is not None:
        gone = int(mask.sum())
        keep = np.ones(len(words), bool)
        keep[: len(mask)] = ~mask
        words = [words[i] for i in np.flatnonzero(keep).tolist()]
    return len(words) + gone, gone, hashlib.sha256(b" ".join(words)).hexdigest()


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, **rule) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row of ``docs`` (doc_id, text).

    Words are runs of anything but ASCII blanks, unchanged; a null text has
    none. All places of a repeated window lose it, the first too, and a window
    may repeat inside one document. Equal rows repeat each other. The doc_id
    is only carried along and may be null. Other columns are ignored; an empty
    table gives no rows.
    """
    how = Rule(width, gram, Units.of_words, _settle, matcher(width), needs_id=False, **rule)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return covered(rows, how, _digest, SCHEMA)
