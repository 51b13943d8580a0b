"""Exact top-k search over binary codes by incremental multi-index hashing.

A code's 64 bits are cut into four segments, each with an index from segment
value to codes. A query looks up the values within radius 0, 1, 2, ... of its
own segments, one segment after the other; every code met is verified by its
full Hamming distance. After radius r on segments 0..j all codes within
4r + j bits have been met, so a query stops as soon as its kth verified
distance is covered.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SEGMENTS, WIDTH = 4, 16
# Codes are dealt to shards and queries to blocks of about so many; every shard meets every block.
SHARD_CODES, BLOCK_QUERIES = 8192, 8192
_LOOKUPS = 1 << 22
# Tasks of the search at most; beyond that, a task takes several (shard, block) pairs, one after the other.
_TASKS = 1 << 14

_TOP_SCHEMA = "vec_id long, code long, neighbor_id long, distance int"


def codes(vectors: DataFrame) -> DataFrame:
    """Distinct (vec_id, code): bit i is set if component i is positive. Rows without components are left out.

    A code has 64 bits; a row with more components fails the query.
    """
    bit = "aggregate(sequence(0, 63), 0L, (a, i) -> a | if(coalesce(get(embedding, i) > 0, false), shiftleft(1L, i), 0L))"
    return (
        vectors.where("vec_id is not null and size(embedding) > 0")
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.when(F.size("embedding") > 64, F.raise_error(F.lit("embedding of more than 64 components"))).otherwise(F.expr(bit)).alias("code"))
        .distinct()
    )


def _masks(radius: int) -> np.ndarray:
    """All segment values with ``radius`` bits set."""
    return np.array([sum(1 << b for b in bits) for bits in combinations(range(WIDTH), radius)], np.int64)


def _segment(values: np.ndarray, j: int) -> np.ndarray:
    return ((values >> np.uint64(WIDTH * j)) & np.uint64((1 << WIDTH) - 1)).astype(np.int64)


def search(ids: np.ndarray, db: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[np.ndarray]:
    """(query number, code number, distance) of the k nearest codes of each query, ties by id; not the query's own id."""
    index = []
    for j in range(SEGMENTS):
        value = _segment(db, j)
        order = np.argsort(value, kind="stable")
        index.append((order, np.searchsorted(value[order], np.arange((1 << WIDTH) + 1))))
    found = [np.empty((0, 3), np.int64)]
    best = np.full((len(queries), 65), 0)  # verified codes by distance
    active = np.arange(len(queries))
    for radius in range(WIDTH + 1):
        masks = _masks(radius)
        for j, (order, starts) in enumerate(index):
            chunk = max(1, _LOOKUPS // len(masks))
            for part in (active[i : i + chunk] for i in range(0, len(active), chunk)):
                value = _segment(queries[part], j)[:, None] ^ masks
                lo, n = starts[value], starts[value + 1] - starts[value]
                q = np.repeat(part, n.sum(axis=1))
                n, lo = n.ravel(), lo.ravel()
                at = order[np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())]
                differ = queries[q] ^ db[at]
                # met before, or met again later: a pair counts at its nearest segment, the first of equals
                new = ids[at] != query_ids[q]
                for other in range(SEGMENTS):
                    if other != j:
                        d = np.bitwise_count(_segment(differ, other))
                        new &= d > radius if other < j else d >= radius
                q, at, d = q[new], at[new], np.bitwise_count(differ[new]).astype(np.int64)
                found.append(np.stack([q, at, d], axis=1))
                np.add.at(best, (q, d), 1)
            covered = SEGMENTS * radius + j
            done = best[active, : covered + 1].sum(axis=1) >= k
            active = active[~done]
        if not len(active):
            break
    all_ = np.concatenate(found)
    all_ = all_[np.lexsort((ids[all_[:, 1]], all_[:, 2], all_[:, 0]))]
    first = np.searchsorted(all_[:, 0], all_[:, 0])
    return all_[np.arange(len(all_)) - first < k]


def top_k(vectors: DataFrame, is_query, k: int = 10) -> DataFrame:
    """(vec_id, rank, neighbor_id, distance): for every query row the k codes at the least Hamming distance.

    vectors: (vec_id, embedding array). Ties go to the smaller neighbor_id; a
    query's own id is no neighbour. Rows with a null id, a null or an empty
    embedding have no code; missing components, nulls and NaN below are unset
    bits (NaN compares as positive in Spark and is a set bit). Equal rows count
    once. With fewer than k other codes all of them are returned. Shards and
    blocks keep one task's input bounded; each pair of them sends on at most k
    rows a query.
    """
    all_codes = codes(vectors)
    queries = all_codes.where(is_query)
    size = all_codes.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    shards, blocks = max(1, -(-size.n // SHARD_CODES)), max(1, -(-size.q // BLOCK_QUERIES))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    db = all_codes.withColumn("shard", F.pmod(F.xxhash64("vec_id", "code"), F.lit(shards)).cast("int")).withColumn("block", each(blocks))
    asked = queries.withColumn("block", F.pmod(F.xxhash64("code", "vec_id"), F.lit(blocks)).cast("int")).withColumn("shard", each(shards))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        ids, qids = left["vec_id"].to_numpy(np.int64), right["vec_id"].to_numpy(np.int64)
        db_, q_ = left["code"].to_numpy(np.int64).view(np.uint64), right["code"].to_numpy(np.int64).view(np.uint64)
        hit = search(ids, db_, qids, q_, k) if len(ids) and len(qids) else np.empty((0, 3), np.int64)
        return pd.DataFrame(
            {"vec_id": qids[hit[:, 0]], "code": right["code"].to_numpy(np.int64)[hit[:, 0]],
             "neighbor_id": ids[hit[:, 1]], "distance": hit[:, 2].astype(np.int32)}
        )

    # a stated number of partitions: adaptive execution would merge them by bytes, and the search is CPU work
    tasks = min(_TASKS, shards * blocks)
    paired = [side.repartition(tasks, "shard", "block").groupBy("shard", "block") for side in (db, asked)]
    near = paired[0].cogroup(paired[1]).applyInPandas(run, _TOP_SCHEMA)
    by = Window.partitionBy("vec_id", "code").orderBy("distance", "neighbor_id")
    return near.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("vec_id", "rank", "neighbor_id", "distance")
