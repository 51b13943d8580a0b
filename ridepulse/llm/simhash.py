"""SimHash near-duplicates by a binary-trie self-join.

Fingerprints are 64 bits. Two that differ in at most ``max_bits`` (4) bits
agree on at least two of six blocks, so every fingerprint is dealt to 15
tries, one for each pair of blocks, keyed by those blocks' bits: all members
of a trie share them, and a linked pair meets in one trie at least. Inside a
trie, node pairs are traversed together; the bits in which their prefixes
differ are accumulated, and a pair of nodes beyond the error budget is
pruned. A pair of nodes that already hang together is pruned as well: what is
needed is each document's component, not every pair of a group of copies.
A trie of more than ``max_trie`` fingerprints is cut below its top levels:
each task gets one pair of sub-tries whose prefixes are within the budget.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridepulse.llm.common import as_bytes, slices, stored
from ridepulse.llm.graph import components

# Fixed values of the fingerprint: hash seed, and the six blocks as (lowest bit, width).
SEED = 42
BLOCKS = [(0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10)]
MAX_TRIE = 1 << 16


def fingerprint(text: bytes, shingle: int) -> int:
    """Fingerprint of one text: a bit is set if it is set in over half the shingles' hashes."""
    words = text.lower().split()  # bytes.lower() changes A-Z only
    if not words:
        return 0
    joined, k, h = b" ".join(words), min(shingle, len(words)), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    hashes = [h(joined[a:b], SEED) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())]
    n, counts = len(hashes), np.zeros(64, np.int64)
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8), bitorder="little").reshape(n, 64)
    for i in range(0, n, 255):  # sums of 255 bits fit a byte
        counts += np.add.reduce(bits[i : i + 255], axis=0, dtype=np.uint8)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, text_hash, fp) of every row of ``docs``; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = as_bytes(batch.column("text"))
            own = np.array([xxhash.xxh64_intdigest(t, SEED) for t in texts], np.uint64)
            fps = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(own.view(np.int64)), pa.array(fps.view(np.int64))], ["doc_id", "text_hash", "fp"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def trie_links(values: list[int], max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest (value, root) of the links among ``values`` (sorted, distinct).

    A node of the trie is a range of ``values``. The stack holds pairs of
    nodes; a node paired with itself opens into its children's own pairs
    first, so that when two nodes meet it is known whether each is one
    component already.
    """
    parent = list(range(len(values)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    whole: set[tuple[int, int]] = set()  # nodes whose leaves are one component

    def branch(lo: int, hi: int) -> int:
        """Bits from the first in which the leaves differ down to the last."""
        return (values[lo] ^ values[hi - 1]).bit_length()

    def halves(lo: int, hi: int, bit: int) -> int:
        return bisect_left(values, values[hi - 1] >> (bit - 1) << (bit - 1), lo, hi)

    def one(lo: int, hi: int) -> bool:
        return hi - lo == 1 or (lo, hi) in whole

    stack = [(0, len(values), 0, len(values), False)]
    while stack:
        a, b, c, d, closing = stack.pop()
        if (a, b) == (c, d):
            if b - a == 1:
                continue
            mid = halves(a, b, branch(a, b))
            if closing:
                if one(a, mid) and one(mid, b) and find(a) == find(mid):
                    whole.add((a, b))
            else:
                stack += [(a, b, a, b, True), (a, mid, mid, b, False), (mid, b, mid, b, False), (a, mid, a, mid, False)]
            continue
        left, right = branch(a, b), branch(c, d)
        shared = max(left, right)
        if ((values[a] ^ values[c]) >> shared).bit_count() > max_bits:
            continue
        if one(a, b) and one(c, d) and find(a) == find(c):
            continue
        if not shared:
            x, y = sorted((find(a), find(c)))
            parent[y] = x
        elif left >= right:
            mid = halves(a, b, left)
            stack += [(mid, b, c, d, False), (a, mid, c, d, False)]
        else:
            mid = halves(c, d, right)
            stack += [(a, b, mid, d, False), (a, b, c, mid, False)]
    return [(v, values[r]) for i, v in enumerate(values) if (r := find(i)) != i]


def _bits(fp: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1))


def _tries(fps: DataFrame, max_bits: int, max_trie: int) -> DataFrame:
    """(trie, a, b, fp): the tries each fingerprint is dealt to, the large ones as pairs of sub-tries."""
    fp, dealt = F.col("fp"), []
    for n, pair in enumerate(combinations(range(len(BLOCKS)), 2)):
        key, rest = F.lit(n).cast("long"), F.lit(0).cast("long")
        for i, (low, width) in enumerate(BLOCKS):
            if i in pair:
                key = F.shiftleft(key, 11).bitwiseOR(_bits(fp, low, width))
            else:
                rest = F.shiftleft(rest, width).bitwiseOR(_bits(fp, low, width))
        # the bits not shared, left-aligned in 44
        width = sum(BLOCKS[i][1] for i in range(len(BLOCKS)) if i not in pair)
        dealt.append(F.struct(key.alias("trie"), F.shiftleft(rest, 44 - width).alias("rest")))
    rows = fps.select("fp", F.explode(F.array(*dealt)).alias("_d")).select("fp", "_d.trie", "_d.rest")
    large = (
        rows.groupBy("trie").count().where(F.col("count") > max_trie)
        .select("trie", F.least(F.ceil(F.log2(F.col("count") / max_trie)), F.lit(16)).cast("int").alias("levels"))
    )
    masks = F.expr(f"filter(sequence(0L, shiftleft(1L, levels) - 1), m -> bit_count(m) <= {max_bits})")
    return (
        rows.join(large, "trie", "left").withColumn("levels", F.coalesce("levels", F.lit(0)))
        .select("trie", "fp", F.expr("shiftright(rest, 44 - levels)").alias("_p"), F.explode(masks).alias("_m"))
        .select("trie", "fp", "_p", F.col("_p").bitwiseXOR(F.col("_m")).alias("_q"))
        .select("trie", F.least("_p", "_q").alias("a"), F.greatest("_p", "_q").alias("b"), "fp")
    )


def links(fps: DataFrame, max_bits: int = 4, max_trie: int = MAX_TRIE) -> DataFrame:
    """Links (u, v) that connect all of ``fps`` (distinct fp) that chains of ``max_bits`` links connect."""
    if max_bits > 4:
        raise ValueError("two of six blocks agree up to 4 differing bits only")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by trie; a trie may go on in the next batch."""
        key, held = None, np.empty(0, np.int64)
        for batch in batches:
            t = np.stack([batch.column(c).to_numpy() for c in ("trie", "a", "b")])
            fp = batch.column("fp").to_numpy()
            if not len(fp):
                continue
            cuts = np.flatnonzero((t[:, 1:] != t[:, :-1]).any(axis=0)) + 1
            found: list[tuple[int, int]] = []
            for a, b in zip(np.concatenate([[0], cuts]).tolist(), np.concatenate([cuts, [len(fp)]]).tolist()):
                now = tuple(t[:, a].tolist())
                if now != key:
                    found += _group(held, max_bits)
                    key, held = now, fp[a:b]
                else:
                    held = np.concatenate([held, fp[a:b]])
            yield _pairs(found)
        yield _pairs(_group(held, max_bits))

    return (
        _tries(fps, max_bits, max_trie)
        .repartition("trie", "a", "b")
        .sortWithinPartitions("trie", "a", "b")
        .mapInArrow(run, "u long, v long")
    )


def _group(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    if len(fps) < 2:
        return []
    return trie_links(np.unique(fps.view(np.uint64)).tolist(), max_bits)


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["u", "v"])


def classes(docs: DataFrame, shingle: int, max_bits: int, max_trie: int = MAX_TRIE) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) of every row; root is the component's least fingerprint."""
    rows = stored(fingerprints(docs, shingle), "simhash-fp")
    one = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(one.select("fp"), max_bits, max_trie), "simhash-links")
    named = one.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of = named.join(ids, "root").select("fp", "root", "component_id")
    return rows.join(of, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, max_trie: int = MAX_TRIE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored).

    Columns: doc_id, fingerprint (16 hex digits), component_id (the smallest
    doc_id that chains of links reach, itself included). A null or blank text
    has fingerprint zero and is linked like any other. Rows with a null doc_id
    are linked too but give no component its id; a component without any id
    has a null component_id. Equal rows stay as many rows. Exact copies share
    a fingerprint and enter the tries once.
    """
    return classes(docs, shingle, max_bits, max_trie).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of ``docs`` with one row of each component: its least doc_id's (ids before null), all columns."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("_k")
    kept = classes(docs, shingle, max_bits).groupBy("root").agg(first)
    kept = kept.select(F.col("_k.doc_id").alias("_id"), F.col("_k.text_hash").alias("_hash")).distinct()
    text_hash = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    # the document as one column, so that none of its columns meets a helper's name
    keyed = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("own_id"), text_hash.alias("own_hash"))
    same = keyed["own_id"].eqNullSafe(kept["_id"]) & (keyed["own_hash"] == kept["_hash"])
    return keyed.join(kept, same, "left_semi").dropDuplicates(["own_id", "own_hash"]).select("row.*")
