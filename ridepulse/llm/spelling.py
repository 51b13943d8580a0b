"""Spelling variants of words, by a variable-length gram index.

Two words are near if one inserted, deleted or replaced code point makes them
equal. The index:

1. *Gram dictionary.* Grams of ``QMIN`` to ``QMAX`` code points are counted
   over the vocabulary; those in more than ``FREQUENT`` places are frequent.
   The frequent ones are all the dictionary has to keep (a bounded number,
   ``MAX_FREQUENT``): from any place in a word, the gram there is the shortest
   one that is not frequent, or the one of ``QMAX``, or what the word's end
   leaves. So common beginnings get long grams and rare ones short.
2. *Decomposition.* A word has one gram per place. A gram depends on its own
   code points alone (and on the word's end, if that cut it short).
3. *Affected grams.* One edit touches only grams that cover its place, so a
   word keeps at least (grams - the most that cover one place) of them, and
   since ``QMAX`` is the least length less 2, at least one. Kept grams left of
   the edit keep their distance from the start, those right of it their
   distance from the end.
4. *Lists.* Sorted from rare to frequent, the first (affected + 1) grams of
   two near words have a kept gram in common, so only those enter the lists
   (keyed by gram, place and length) and only those look into them.
5. *Verification.* What a list brings together is compared outright.

A pair is found in every list that it shares, and has at most a few thousand
partners by the alphabet, so pairs are made distinct word by word.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridepulse.llm.common import as_bytes, slices, stored

# What a word is, and when a near word is taken for its right form.
LETTERS = "a-zÀ-ÿ"
MIN_CHARS = 7
MIN_COUNT = 2
FORM_RATIO = 10
# Parameters of the index. QMAX up to MIN_CHARS - 2 leaves every word at least one gram that an edit spares.
QMIN, QMAX = 2, MIN_CHARS - 2
FREQUENT = 64
MAX_FREQUENT = 200_000
# Counts held by one task before it hands them on.
_HELD = 200_000


def _handed_on(counts: Counter, names: list[str]) -> pa.RecordBatch:
    out = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names)
    counts.clear()
    return out


def count_words(docs: DataFrame, slip: int | None = None) -> DataFrame:
    """(word, n) of all words of ``docs`` (doc_id, text): runs of letters, A-Z lower-cased, of ``MIN_CHARS`` at least.

    ``slip`` makes known misspellings: where it divides the crc32 of
    ``<doc_id>:<run>``, the run loses the code point at crc32 % length. A null
    text has no words; a null doc_id is written as the empty text. Words with
    fewer than ``MIN_COUNT`` occurrences are left out.
    """
    runs = re.compile(f"[{LETTERS}]{{{MIN_CHARS},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), as_bytes(batch.column("text"))):
                crc = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
                crc = zlib.crc32(b":", crc)
                for word, n in Counter(runs.findall(text.lower().decode())).items():  # bytes.lower() lowers A-Z alone
                    h = zlib.crc32(word.encode(), crc) if slip else 1
                    if slip and h % slip == 0:
                        word = word[: h % len(word)] + word[h % len(word) + 1 :]
                        if len(word) < MIN_CHARS:
                            continue
                    held[word] += n
            if len(held) > _HELD:
                yield _handed_on(held, ["word", "n"])
        yield _handed_on(held, ["word", "n"])

    texts = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= MIN_COUNT)


def frequent_grams(words: DataFrame) -> dict[str, int]:
    """Grams in more than ``FREQUENT`` places of the vocabulary, with their number; ``MAX_FREQUENT`` at most.

    The bound is on the dictionary, not on results: a gram left out is taken
    for a rare one, and its list is longer.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for word in batch.column("word").to_pylist():
                for q in range(QMIN, QMAX + 1):
                    held.update([word[i : i + q] for i in range(len(word) - q + 1)])
                if len(held) > _HELD:
                    yield _handed_on(held, ["gram", "n"])
        yield _handed_on(held, ["gram", "n"])

    counted = words.select("word").mapInArrow(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    kept = counted.where(F.col("n") > FREQUENT).orderBy(F.desc("n"), F.length("gram"), "gram").limit(MAX_FREQUENT)
    return dict(kept.collect())


def decompose(word: str, frequent: dict[str, int]) -> list[tuple[int, int]]:
    """(start, end) of the gram at each place of ``word``."""
    size, out = len(word), []
    for start in range(size - QMIN + 1):
        end = start + QMIN
        while end < size and end - start < QMAX and word[start:end] in frequent:
            end += 1
        out.append((start, end))
    return out


def affected(grams: list[tuple[int, int]], size: int) -> int:
    """The most grams that one edit can change: those that cover one place."""
    change = [0] * (size + 1)
    for start, end in grams:
        change[start] += 1
        change[end] -= 1
    most = now = 0
    for x in change:
        now += x
        most = max(most, now)
    return most


def selected(word: str, frequent: dict[str, int]) -> list[tuple[str, int]]:
    """(gram, start) of the (affected + 1) rarest grams of ``word``, in an order that all words share."""
    grams = decompose(word, frequent)
    keyed = sorted((frequent.get(word[a:b], 0), word[a:b], a) for a, b in grams)
    return [(gram, a) for _, gram, a in keyed[: affected(grams, len(word)) + 1]]


def _listed(words: DataFrame, frequent: dict[str, int]) -> DataFrame:
    """word, n, size (code points), mask (a bit per letter modulo 64), gram, start: the selected grams of each word."""
    shared = words.sparkSession.sparkContext.broadcast(frequent)

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, size, mask, gram, start = [], [], [], [], []
            for i, word in enumerate(batch.column("word").to_pylist()):
                bits = 0
                for c in set(word):
                    bits |= 1 << (ord(c) & 63)
                bits -= (bits >> 63) << 64
                for g, a in selected(word, shared.value):
                    at.append(i)
                    size.append(len(word))
                    mask.append(bits)
                    gram.append(g)
                    start.append(a)
            rows = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("word"), rows.column("n"), pa.array(size, pa.int32()), pa.array(mask, pa.int64()),
                    pa.array(gram, pa.string()), pa.array(start, pa.int32()),
                ],
                ["word", "n", "size", "mask", "gram", "start"],
            )

    return words.select("word", "n").mapInArrow(
        select, "word string, n long, size int, mask long, gram string, start int"
    )


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every near pair of ``words`` (word, n) in both directions, once each."""
    listed = stored(_listed(words, frequent_grams(words)), "spelling-lists")

    def key(start: Column, size: Column) -> Column:
        return F.xxhash64("gram", start.cast("int"), size.cast("int")).alias("key")

    size, start = F.col("size"), F.col("start")
    index = listed.select(key(start, size), F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("mask").alias("near_mask"))
    # of equal length: each pair once; of lengths one apart: the shorter word asks for grams left and right of the edit
    equal = listed.select(key(start, size), F.lit(False).alias("longer"), "word", "n", "mask")
    left = listed.select(key(start, size + 1), F.lit(True).alias("longer"), "word", "n", "mask")
    right = listed.select(key(start + 1, size + 1), F.lit(True).alias("longer"), "word", "n", "mask")
    found = equal.unionAll(left).unionAll(right).join(index, "key").where(
        (F.col("longer") | (F.col("word") < F.col("near")))
        & (F.bit_count(F.col("mask").bitwiseXOR(F.col("near_mask"))) <= 2)
        & (F.levenshtein("word", "near", 1) == 1)
    )
    both = found.select("word", "n", "near", "near_n").unionAll(
        found.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    )
    return both.repartition("word").distinct()


def variants(words: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n, root of every row of ``words`` (word string, n long; words are distinct).

    ``form``: the near word of largest n (ties: first in code-point order) if
    that n is ``FORM_RATIO`` times the word's or more, else null. ``root``: where
    following forms ends. A form's n grows tenfold with each step, so a chain
    of forms has under 19 steps; roots double their reach in each round.
    """
    words = stored(words.select("word", "n"), "spelling-words")
    near = near_pairs(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best")
    )
    good = -F.col("best.n") >= FORM_RATIO * F.col("n")
    formed = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(good, F.col("best.near")).alias("form"),
        F.when(good, -F.col("best.n")).alias("form_n"),
    )
    formed = stored(formed, "spelling-forms")
    reached = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(5):  # 2^5 steps
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(
            reached.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "spelling-roots",
        )
        reached = step.select("word", "root")
        if not step.where("moved").limit(1).count():
            break
    return formed.join(reached, "word", "left").withColumn("root", F.coalesce("root", "word"))
