"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

Texts and items are sequences of lower-case words. A window of a document
leaks an item if their edit distance (words inserted, deleted, replaced) is
within ``1 - similarity`` of the item's words.

1. Windows: a leaked item of n words with e edits keeps at least
   n - q + 1 - q*e of its word q-grams, in a band of diagonals. Bands with fewer
   shared q-grams cannot leak (the q-gram lemma); of the others the item-sized
   window at every diagonal with a shared q-gram is embedded.
2. CGK random-walk embedding: a pointer walks over the window's words; step j
   writes the word under it and moves on by a random bit of (j, word). Edit
   distance becomes Hamming distance, the same walk on equal words meeting
   again after an edit.
3. Bit-sampling LSH: in each repetition both embeddings are sampled at a few
   steps; the pair is a candidate if all samples agree in one repetition. The
   number of repetitions follows from the item's edit limit (``repetitions``),
   for a recall over 0.9 at that limit.
4. Exact verification of the candidates: the smallest edit distance of the item
   to any stretch at the windows.
5. The exact way for what LSH misses: bands without a candidate are verified
   too, after the candidates. ``found_by`` tells which of both found a leak.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridepulse.llm.common import as_bytes, slices
from ridepulse.llm.words import PUNCTUATION, Words, mixed

SIMILARITY = 0.8
# Items are held by every task in blocks of up to about this many bytes; more items take more passes.
ITEM_BLOCK_BYTES = 8 << 20
SAMPLES = 2
_TABLE_BITS = 22
# Shared q-grams, and cells of embeddings, that are held at a time.
_MOST_HITS, _MOST_CELLS = 1 << 20, 1 << 20
# Repetitions that are embedded together, before windows of settled bands are left out.
_ROUND = 8

LEAK_SCHEMA = "doc_id long, item_id long, start long, n_words long, distance long, found_by string"


def max_edits(n: int, similarity: float) -> int:
    return int(n * (1 - similarity) + 1e-9)


def gram_words(n: int, similarity: float) -> tuple[int, int]:
    """(q, least number of shared q-grams) that no leak of an item of n words can miss."""
    e = max_edits(n, similarity)
    for q in (3, 2, 1):
        if n - q + 1 - q * e >= 1:
            return q, n - q + 1 - q * e
    return 1, max(1, n - e)


def repetitions(edits):
    """LSH repetitions for leaks with ``edits`` edits (measured recall at the limit: 0.93 for 300 words, 0.97 up to 200)."""
    return 12 + 5 * edits // 2


def _grams(words: np.ndarray, q: int) -> np.ndarray:
    out = words[: len(words) - q + 1].copy()
    for i in range(1, q):
        out = mixed(out) + words[i : len(words) - q + 1 + i]
    return out


@lru_cache(maxsize=1024)
def _walk(steps: int, repetition: int) -> np.ndarray:
    """The odd factors that give a repetition's walk its random bits."""
    return np.random.default_rng(repetition).integers(1, 1 << 63, steps, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def embed(words: np.ndarray, start: np.ndarray, size: np.ndarray, steps: int, repetition: np.ndarray) -> np.ndarray:
    """CGK embeddings (steps x windows) of the windows [start, start + size) of ``words``, each by its repetition's walk.

    Past its window's end a walk writes zeros.
    """
    kinds, of = np.unique(repetition, return_inverse=True)
    odd = np.stack([_walk(steps, int(r)) for r in kinds], axis=1)
    padded = np.concatenate([words, [np.uint64(0)]])
    out = np.zeros((steps, len(start)), np.uint64)
    at, end = start.astype(np.int64), (start + size).astype(np.int64)
    for j in range(steps):
        w = np.where(at < end, padded[np.minimum(at, len(words))], np.uint64(0))
        out[j] = w
        at = at + ((mixed(w) * odd[j][of]) >> np.uint64(63)).astype(np.int64)
    return out


@lru_cache(maxsize=1 << 16)
def sample_steps(n: int, repetition: int, samples: int) -> tuple[int, ...]:
    """The steps that a repetition compares, for an item of n words: anywhere in its first 2n steps."""
    return tuple(np.random.default_rng([7, n, repetition]).integers(0, 2 * n, samples).tolist())


def edit_distance(item: np.ndarray, region: np.ndarray) -> tuple[int, int]:
    """(smallest edit distance of ``item`` to any stretch of ``region``, the stretch's end)."""
    n = len(item)
    column = np.arange(n + 1)
    ladder = np.arange(n + 1)
    best, at = int(column[n]), 0
    for i, w in enumerate(region.tolist()):
        new = np.empty_like(column)
        new[0] = 0
        np.minimum(column[1:] + 1, column[:-1] + (item != np.uint64(w)), out=new[1:])
        column = np.minimum.accumulate(new - ladder) + ladder
        if column[n] < best:
            best, at = int(column[n]), i + 1
    return best, at


@dataclass
class Items:
    """Benchmark items as word hashes, with an index of their q-grams for each q."""

    ids: list[int | None]
    words: list[np.ndarray]
    similarity: float
    samples: int

    def __post_init__(self) -> None:
        self.edits = np.array([max_edits(len(w), self.similarity) for w in self.words], np.int64)
        need = [gram_words(len(w), self.similarity) if len(w) else (1, 1) for w in self.words]
        self.least = np.array([t for _, t in need], np.int64)
        self.size = np.array([len(w) for w in self.words], np.int64)
        self.repetitions = repetitions(self.edits)
        self.index = {}
        for q in sorted({q for (q, _), w in zip(need, self.words) if len(w)}):
            rows = [(_grams(w, q), i) for i, (w, (own, _)) in enumerate(zip(self.words, need)) if own == q and len(w)]
            gram = np.concatenate([g for g, _ in rows])
            item = np.concatenate([np.full(len(g), i) for g, i in rows])
            offset = np.concatenate([np.arange(len(g)) for g, _ in rows])
            order = np.argsort(gram, kind="stable")
            shift = np.uint64(64 - min(_TABLE_BITS, 6 + len(gram).bit_length()))
            seen = np.zeros(1 << (64 - int(shift)), bool)
            seen[mixed(gram) >> shift] = True
            self.index[q] = (gram[order], item[order], offset[order], seen, shift)

    def shared(self, w: Words) -> dict[int, tuple[np.ndarray, ...]]:
        """By q, the words at which a q-gram of an item starts, and that gram's range in the index."""
        out = {}
        for q, (gram, _, _, seen, shift) in self.index.items():
            if len(w.hash) < q:
                continue
            own = _grams(w.hash, q)
            at = np.flatnonzero(seen[mixed(own) >> shift])
            at = at[w.doc[at] == w.doc[at + q - 1]]
            lo, hi = np.searchsorted(gram, own[at], "left"), np.searchsorted(gram, own[at], "right")
            found = hi > lo
            if found.any():
                out[q] = at[found], lo[found], hi[found]
        return out

    def parts(self, w: Words, first: int = 0) -> Iterator[tuple[Items, int, dict]]:
        """These items, or parts of them with a bounded number of shared q-grams: (items, number of the first, shared)."""
        shared = self.shared(w)
        if sum(int((hi - lo).sum()) for _, lo, hi in shared.values()) <= _MOST_HITS or len(self.words) == 1:
            yield self, first, shared
        else:
            k = len(self.words) // 2
            for a, b in ((0, k), (k, len(self.words))):
                yield from Items(self.ids[a:b], self.words[a:b], self.similarity, self.samples).parts(w, first + a)

    def hits(self, w: Words, shared: dict) -> tuple[np.ndarray, ...]:
        """(doc, item, start, count, key): shared q-grams by the window start they point at, in the order of ``key``.

        Pairs of occurrences are made and counted in chunks, so that a gram
        frequent on both sides needs memory for its starts only.
        """
        # texts are set apart, so that starts before a text's first word stay its own and no band reaches another text
        pad = int((self.size + 2 * self.edits).max()) + 2
        span = len(w.hash) + (len(w.count) + 2) * pad
        keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        for q, (at, lo, hi) in shared.items():
            _, item, offset, _, _ = self.index[q]
            upto = np.concatenate([[0], np.cumsum(hi - lo)])
            for begin in range(0, int(upto[-1]), _MOST_HITS):
                pair = np.arange(begin, min(begin + _MOST_HITS, int(upto[-1])))
                of = np.searchsorted(upto, pair, "right") - 1
                k, word = lo[of] + pair - upto[of], at[of]
                new = item[k] * span + word - offset[k] + (w.doc[word] + 1) * pad
                keys, inverse = np.unique(np.concatenate([keys, new]), return_inverse=True)
                counts = np.bincount(inverse, np.concatenate([counts, np.ones(len(new), np.int64)]), len(keys)).astype(np.int64)
        item, start = keys // span, keys % span
        doc = np.searchsorted(w.first[:-1] + np.arange(len(w.count)) * pad, start, "right") - 1
        return doc, item, start - (doc + 1) * pad, counts, keys

    def windows(self, w: Words, shared: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(doc, item, start, leads) of the diagonals in bands with enough shared q-grams; bands begin where ``leads``."""
        doc, item, start, count, key = self.hits(w, shared)
        # diagonals of one leak differ by its edits at most; count those from a start on
        upto = np.concatenate([[0], np.cumsum(count)])
        end = np.searchsorted(key, key + 2 * self.edits[item], "right")
        leads = upto[end] - upto[:-1] >= self.least[item]
        covered = np.zeros(len(key) + 1, np.int64)
        np.add.at(covered, np.flatnonzero(leads), 1)
        np.add.at(covered, end[leads], -1)
        keep = np.cumsum(covered)[:-1] > 0
        return doc[keep], item[keep], start[keep], leads[keep]

    def collide(self, w: Words, doc: np.ndarray, item: np.ndarray, start: np.ndarray, region: np.ndarray) -> np.ndarray:
        """Which regions have a window that agrees with its item on all samples of a repetition."""
        hit = np.zeros(int(region[-1]) + 1, bool)
        lo = np.maximum(start, w.first[doc])
        size = np.minimum(start + self.size[item], w.first[doc + 1]) - lo
        offsets = np.concatenate([[0], np.cumsum(self.size)])
        flat = np.concatenate(self.words)
        order = np.argsort(self.size[item], kind="stable")
        for r in range(0, int(self.repetitions[item].max()), _ROUND):
            left = order[(size[order] > 0) & (self.repetitions[item[order]] > r)]
            while len(left := left[~hit[region[left]]]):
                # windows that fit into memory with all repetitions of the round, at least one
                cells = 2 * self.size[item[left]] * np.arange(1, len(left) + 1) * _ROUND
                now, left = np.split(left, [max(1, int(np.searchsorted(cells, _MOST_CELLS)))])
                steps = 2 * int(self.size[item[now[-1]]])
                kinds, of = np.unique(item[now], return_inverse=True)
                rounds = np.arange(r, r + _ROUND)
                theirs = embed(flat, np.repeat(offsets[kinds], _ROUND), np.repeat(self.size[kinds], _ROUND), steps, np.tile(rounds, len(kinds)))
                ours = embed(w.hash, np.repeat(lo[now], _ROUND), np.repeat(size[now], _ROUND), steps, np.tile(rounds, len(now)))
                picks = np.array([sample_steps(int(n), int(k), self.samples) for n in self.size[kinds] for k in rounds])
                column = (of[:, None] * _ROUND + np.arange(_ROUND)).ravel()
                agree = np.arange(_ROUND)[None, :] < self.repetitions[item[now]][:, None] - r
                for p in picks.T:
                    agree &= (ours[p[column], np.arange(len(column))] == theirs[p[column], column]).reshape(agree.shape)
                hit[region[now[agree.any(axis=1)]]] = True
        return hit

    def regions(self, w: Words, shared: dict) -> tuple[np.ndarray, ...]:
        """(doc, item, first word, end, LSH candidate) of the stretches to verify; bands that overlap are one."""
        doc, item, start, leads = self.windows(w, shared)
        if not len(doc):
            return doc, item, start, start, np.zeros(0, bool)
        # windows further on in a band lie inside the stretch of the one that leads it
        lead = start[np.maximum.accumulate(np.where(leads, np.arange(len(doc)), 0))]
        lo = np.maximum(lead - 2 * self.edits[item], w.first[doc])
        hi = np.minimum(lead + self.size[item] + 2 * self.edits[item], w.first[doc + 1])
        new = np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(item) != 0) | (lo[1:] > hi[:-1])])
        at = np.flatnonzero(new)
        hit = self.collide(w, doc, item, start, np.cumsum(new) - 1)
        return doc[at], item[at], lo[at], np.maximum.reduceat(hi, at), hit

    def leaks(self, w: Words, any_item: bool = False, exact: bool = True) -> dict[tuple[int, int], tuple[int, int, int, str]]:
        """(doc, item) -> (distance, first word, words, found by) of the best leaking stretch.

        With ``any_item`` one item a doc, without ``exact`` only what LSH finds.
        """
        out: dict[tuple[int, int], tuple[int, int, int, str]] = {}
        leaking: set[int] = set()
        for items, first, shared in self.parts(w):
            doc, item, lo, hi, hit = items.regions(w, shared)
            order = np.argsort(~hit, kind="stable")[: len(hit) if exact else int(hit.sum())]
            for d, i, a, b, by_lsh in zip(*(x[order].tolist() for x in (doc, item + first, lo, hi, hit))):
                if (any_item and d in leaking) or out.get((d, i), (1,))[0] == 0:
                    continue
                region = w.hash[a:b]
                distance, end = edit_distance(self.words[i], region)
                if distance <= self.edits[i]:
                    # no stretch that ends before is as near, so the nearest read backwards starts at this end
                    _, words = edit_distance(self.words[i][::-1], region[:end][::-1])
                    best = (distance, a + end - words - int(w.first[d]), words)
                    by = out[d, i][3] if (d, i) in out else "lsh" if by_lsh else "exact"
                    out[d, i] = (*min(out.get((d, i), best)[:3], best), by)
                    leaking.add(d)
        return out


def _item_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Ids and word hashes of the items with any words, in blocks of about ``block_bytes``."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.where("text is not null")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    blocks = -(-total // block_bytes)
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        w = Words([r.text.encode() for r in rows], PUNCTUATION, lower=True)
        parts = [(r.item_id, w.hash[w.first[i] : w.first[i + 1]]) for i, r in enumerate(rows)]
        parts = sorted((p for p in parts if len(p[1])), key=lambda p: (p[0] is None, p[0] or 0))
        if parts:
            yield [p[0] for p in parts], [p[1] for p in parts]


def _passes(docs: DataFrame, benchmark: DataFrame, block_bytes: int, any_item: bool, exact: bool, *how):
    """For each block of items a function that gives ``Items.leaks`` of a slice of texts, made once a task."""
    for block in _item_blocks(benchmark, block_bytes):
        held = docs.sparkSession.sparkContext.broadcast(block)

        def finder(held=held):
            items = Items(*held.value, *how)
            return items, lambda batch: items.leaks(Words(as_bytes(batch.column("text")), PUNCTUATION, lower=True), any_item, exact)

        yield finder


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    similarity: float = SIMILARITY,
    samples: int = SAMPLES,
    block_bytes: int = ITEM_BLOCK_BYTES,
    exact: bool = True,
) -> DataFrame:
    """Leaks of ``benchmark`` (item_id, text) in ``docs`` (doc_id, text), one row per document row and item.

    Columns: doc_id, item_id, start and n_words (the nearest stretch of words),
    distance (its edits), found_by (``lsh``, or ``exact`` for a leak whose windows
    LSH missed). All leaks are found; without ``exact`` those of LSH only. Null and blank texts leak
    nothing and are leaked by nothing; equal rows give equal rows; null ids
    stay null; empty tables give no rows. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = docs.sparkSession.createDataFrame([], LEAK_SCHEMA)
    for finder in _passes(docs, benchmark, block_bytes, False, exact, similarity, samples):

        def run(batches: Iterator[pa.RecordBatch], finder=finder) -> Iterator[pa.RecordBatch]:
            items, find = finder()
            for batch in slices(batches):
                found = sorted(find(batch).items())
                doc_ids = batch.column("doc_id").to_pylist()
                columns = [
                    [doc_ids[d] for (d, _), _ in found],
                    [items.ids[i] for (_, i), _ in found],
                    [s for _, (_, s, _, _) in found],
                    [k for _, (_, _, k, _) in found],
                    [e for _, (e, _, _, _) in found],
                ]
                arrays = [*(pa.array(c, pa.int64()) for c in columns), pa.array([by for _, (*_, by) in found], pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "item_id", "start", "n_words", "distance", "found_by"])

        out = out.unionByName(rows.mapInArrow(run, LEAK_SCHEMA))
    return out


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, block_bytes: int = ITEM_BLOCK_BYTES
) -> DataFrame:
    """The rows of ``docs`` that leak no item of ``benchmark``, all columns unchanged."""
    for finder in _passes(docs, benchmark, block_bytes, True, True, similarity, SAMPLES):

        def run(batches: Iterator[pa.RecordBatch], finder=finder) -> Iterator[pa.RecordBatch]:
            _, find = finder()
            for batch in slices(batches):
                leaking = {d for d, _ in find(batch)}
                yield batch.filter(pa.array([i not in leaking for i in range(batch.num_rows)]))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
