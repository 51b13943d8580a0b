"""Mixing sources to target weights along a low-discrepancy schedule.

Every source's documents are put in a shuffled order and their words cut into
blocks of equal size. A schedule of slots maps the points of a golden-ratio
sequence through the cumulative weights, so any stretch of the schedule holds
the sources in proportion. Slots are ranked per source, and rank r takes the
source's block r, round and round, at most ``MAX_EPOCHS`` times.

All steps are DataFrame operations. Ranks and offsets are prefix sums in two
steps, inside bounded chunks and over chunk totals, so a source with a third
of all rows is no single task's work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridepulse.llm.common import WORD, stored

# Fixed values of the mix: weights by the sources' order, and how often a text may be taken.
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
# Golden ratio conjugate times 2^31, made odd: i * _STEP mod 2^31 is a Weyl sequence with period 2^31.
_STEP, _MOD = 1_327_217_885, 1 << 31
_CELLS = 4096
_CHUNK = 1 << 16
_SHELVES = 4096
_BROADCAST_ROWS = 100_000
BLOCK_WORDS = 64

_KEY = ["no_source", "source"]


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source as a null-free key, the hash of the text and its number of words, for each row."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").isNull().alias("no_source"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_hash"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )


def targets(sizes: DataFrame) -> DataFrame:
    """Per source: source_size, weight, target (words) and order.

    Shares of 100 % of all words by weight, stopped at MAX_EPOCHS times a
    source's size, the excess shared again: with sources ordered by
    cap / weight, those that are stopped come first, and the level of the
    others is (all - caps before) / (weights from here on). Windows run over
    one row per source.
    """
    per = sizes.groupBy(*_KEY).agg(F.sum("size").alias("source_size"))
    ordered = per.withColumn("_n", F.row_number().over(Window.orderBy(*_KEY)) - 1).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("_n") % len(WEIGHTS) + 1).cast("int")).cast("long")
    )
    cap = (MAX_EPOCHS * F.col("source_size")).cast("long")
    by = Window.orderBy(F.col("_cap") / F.col("weight"), "_n")
    back, on = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("_cap").over(back), F.lit(0))) / F.sum("weight").over(on)
    return (
        ordered.withColumn("_cap", cap)
        .withColumn("_level", level)
        .withColumn("_stopped", F.col("_level") * F.col("weight") >= F.col("_cap"))
        .withColumn("_rest", F.min(F.when(~F.col("_stopped"), F.struct(F.col("_cap") / F.col("weight"), "_n", "_level"))).over(whole))
        .select(
            *_KEY, F.col("_n").alias("order"), "weight", "source_size",
            F.when(F.col("_stopped"), F.col("_cap").cast("double"))
            .otherwise(F.col("_rest._level") * F.col("weight")).cast("double").alias("target"),
        )
    )


def _before(total: str, *over: str, key: list[str]) -> Column:
    w = Window.partitionBy(*key).orderBy(*over).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(total).over(w), F.lit(0)).cast("long")


def _small(df: DataFrame, bound: int) -> DataFrame:
    """``df``, marked for a broadcast if it is known to stay within the bound."""
    return F.broadcast(df) if bound <= _BROADCAST_ROWS else df


def schedule(plan: DataFrame, n_slots: int, n_sources: int) -> DataFrame:
    """(slot, source key, block, epoch) in slot order; slots past a source's last epoch are left out.

    ``plan``: one row per source with blocks and slots (the blocks it wants).
    """
    over = Window.orderBy("order").rowsBetween(Window.unboundedPreceding, 0)
    edge = F.floor(F.sum("slots").over(over) / F.sum("slots").over(Window.partitionBy()) * _MOD).cast("long")
    cell = _MOD // _CELLS
    ranges = plan.where("slots > 0").withColumn("_to", edge).withColumn(
        "_from", F.coalesce(F.lag("_to").over(Window.orderBy("order")), F.lit(0).cast("long"))
    ).where("_to > _from")
    cells = ranges.select(
        *_KEY, "blocks", "_from", "_to",
        F.explode(F.sequence(F.floor(F.col("_from") / cell), F.floor((F.col("_to") - 1) / cell))).alias("_cell"),
    )
    i = F.col("slot") % _MOD
    points = (
        plan.sparkSession.range(n_slots).withColumnRenamed("id", "slot")
        .withColumn("_u", i * F.lit(_STEP) % _MOD).withColumn("_cell", F.floor(F.col("_u") / cell))
        .join(_small(cells, _CELLS + n_sources), "_cell").where("_u >= _from and _u < _to")
        .select(*_KEY, "blocks", "slot", F.floor(F.col("slot") / _CHUNK).alias("_chunk"))
    )
    chunks = points.groupBy(*_KEY, "_chunk").agg(F.count("*").alias("_n"))
    chunks = chunks.select(*_KEY, "_chunk", _before("_n", "_chunk", key=_KEY).alias("_base"))
    inside = Window.partitionBy(*_KEY, "_chunk").orderBy("slot")
    rank = F.col("_base") + F.row_number().over(inside) - 1
    return (
        points.join(chunks, [*_KEY, "_chunk"]).withColumn("_rank", rank)
        .select("slot", *_KEY, (F.col("_rank") % F.col("blocks")).alias("block"), F.floor(F.col("_rank") / F.col("blocks")).alias("epoch"))
        .where(F.col("epoch") < MAX_EPOCHS)
    )


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken, source, text_hash.

    Blocks of a source differ by one word at most; a block's words belong to
    the documents it covers, so ``taken`` counts each time a block with words
    of the document is taken. Null and blank texts have size 0 and are never
    taken; null sources are one source, ordered last; an empty table gives no
    rows. Equal rows are told apart by their place in the shuffled order.
    Reruns agree: the order and the schedule depend on the rows alone.
    ``block_words`` should grow with the corpus: there is a slot for each
    block taken, and the sequence repeats after 2^31 slots.
    """
    rows = stored(sized(docs), "mix-sizes")
    per = stored(
        targets(rows)
        .withColumn("blocks", F.ceil(F.col("source_size") / block_words))
        .withColumn("slots", F.when(F.col("source_size") > 0, F.col("target") * F.col("blocks") / F.col("source_size")).otherwise(F.lit(0.0))),
        "mix-targets",
    )
    total = per.agg(F.ceil(F.sum("slots")).alias("n"), F.count("*").alias("k")).first()
    n_sources = total.k
    times = (
        schedule(per, int(total.n or 0), n_sources).groupBy(*_KEY, "block").agg(F.count("*").alias("_times"))
    )

    # shuffled order: shelves by hash, prefix sums over shelves, running sums inside a shelf
    shuffled = rows.where("size > 0").withColumn("_h", F.md5(F.concat(F.lit("mix"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    shuffled = shuffled.withColumn("_shelf", F.conv(F.substring("_h", 1, 3), 16, 10).cast("int") % _SHELVES)
    shelves = shuffled.groupBy(*_KEY, "_shelf").agg(F.sum("size").alias("_n"))
    shelves = shelves.select(*_KEY, "_shelf", _before("_n", "_shelf", key=_KEY).alias("_base"))
    on_shelf = Window.partitionBy(*_KEY, "_shelf").orderBy("_h", "doc_id", "size", "text_hash").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        shuffled.withColumn("_end", F.sum("size").over(on_shelf))
        .join(shelves, [*_KEY, "_shelf"])
        .withColumn("_end", F.col("_base") + F.col("_end")).withColumn("_start", F.col("_end") - F.col("size"))
        .join(_small(per, n_sources), _KEY)
    )
    # block j holds words [j * source_size div blocks, (j + 1) * source_size div blocks)
    edge = lambda j: F.expr(f"({j} * source_size) div blocks")
    first = F.expr("(_start * blocks) div source_size")
    last = F.least(F.expr("(_end * blocks) div source_size"), F.col("blocks") - 1)
    pieces = (
        placed.select(*_KEY, "doc_id", "text_hash", "size", "_start", "_end", "source_size", "blocks", F.explode(F.sequence(first, last)).alias("block"))
        .withColumn("_words", F.least("_end", edge("(block + 1)")) - F.greatest("_start", edge("block")))
        .where("_words > 0")
    )
    taken = (
        pieces.join(times, [*_KEY, "block"], "left")
        .groupBy(*_KEY, "doc_id", "text_hash", "size", "_start")
        .agg(F.sum(F.col("_words") * F.coalesce("_times", F.lit(0))).alias("taken"))
        .select(*_KEY, "doc_id", "text_hash", "size", "taken")
    )
    blank = rows.where("size = 0").select(*_KEY, "doc_id", "text_hash", "size", F.lit(0).cast("long").alias("taken"))
    return (
        taken.unionByName(blank).join(_small(per, n_sources), _KEY)
        .select("doc_id", "size", "source_size", "target", "taken", F.when(~F.col("no_source"), F.col("source")).alias("source"), "text_hash")
    )


def mixture(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them: taken / size, to the nearest whole number."""
    times = mix(docs, block_words).where("size > 0").groupBy("doc_id", "text_hash")
    times = times.agg(F.floor(F.avg(F.col("taken") / F.col("size")) + 0.5).cast("int").alias("_times")).where("_times > 0")
    times = times.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "_times")
    # the document as one column, so that none of its columns meets a helper's name
    text_hash = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    keyed = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("own_id"), text_hash.alias("own_hash"))
    same = keyed["own_id"].eqNullSafe(times["_id"]) & (keyed["own_hash"] == times["_hash"])
    repeated = keyed.join(times, same).select("row", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    return repeated.select("row.*")
