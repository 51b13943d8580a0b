"""Prefix trie of conversations.

Turns become ids (128 bits of the SHA-256 of role and text) in numbered
places. A block of places is one row of id columns per conversation, and one
``ROLLUP`` over those columns makes all nodes of the block at once: the
grouping id tells a node's depth. A node is known by its smallest member and
its depth; further blocks are keyed by the node that the block before ended
in, and hold only conversations that still share that node with others: a
node with one member has no branches below it, its turns are read straight
from the conversation. So the number of rounds follows the longest *shared*
prefix, not the longest conversation.

Measures over subtrees come from a second ``ROLLUP`` over the same rows. With
``o`` the smallest member of a node at depth d, the nodes of its subtree are
the nodes of which one of its members is smallest; of members other than ``o``
these are all such nodes, of ``o`` those from d on. So

    sum over subtree = sum over members of (all the member's own nodes)
                       - all of o's own nodes + o's own nodes from d on.

Nothing is collected: a conversation with a third of all turns is numbered
over many tasks, a node with very many members is a partial aggregate, and
the ids that end at a node are hashed as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridepulse.llm.common import WORD, stored

# Parameters: id columns of the first block and of each further one.
FIRST_BLOCK, NEXT_BLOCK = 8, 32
# Member ids joined to one string before they are hashed.
_JOINED = 4096

TRIE_SCHEMA = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)
_NO_TURNS = hashlib.sha256(b"").hexdigest()


def number_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), id, words of every turn.

    Turns are ordered by ``turn``, null first; turns of one number by role,
    then by id, so repeated rows follow each other. Null role or text is
    empty. Rows without a conv_id belong to no conversation and are left out.

    The order is one global sort, so a long conversation spreads over tasks; a
    row's place is its place in the task plus the rows of its conversation in
    earlier tasks, known from one row per task.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    tie = F.monotonically_increasing_id().alias("tie")
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.substring(F.unhex(F.sha2(F.concat(F.length(role), F.lit(":"), role, text), 256)), 1, 16).alias("id"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        tie,
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, conv, done = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            ids = batch.column("conv_id").to_numpy()
            if not len(ids):
                continue
            row = np.arange(len(ids))
            first = np.concatenate([[True], ids[1:] != ids[:-1]])
            k = row - np.maximum.accumulate(np.where(first, row, 0))
            if ids[0] == conv:
                k[: np.argmax(np.append(ids != conv, True))] += done
            conv, done = ids[-1], int(k[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("conv_id", "id", "words")), pa.array(np.full(len(ids), part, np.int32)), pa.array(k)],
                ["conv_id", "id", "words", "part", "k"],
            )

    order = ["conv_id", "turn", "role", "id", "tie"]
    hashed = stored(turns, "trie-hashed")  # the sort reads its input twice, so texts are hashed before it
    placed = stored(
        hashed.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "id", "words").mapInArrow(
            place, "conv_id long, id binary, words long, part int, k long"
        ),
        "trie-placed",
    )
    # one row per task: how many rows of its first conversation lie in earlier tasks
    tasks = placed.groupBy("part").agg(F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "k")).alias("last"))
    tasks = tasks.select("part", "first", F.col("last.conv_id").alias("last"), (F.col("last.k") + 1).alias("tail"))
    before = Window.partitionBy("last").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    tails = tasks.groupBy(F.col("last").alias("first")).agg(F.sum("tail").alias("tails"))
    carried = (
        tasks.withColumn("inner", F.sum("tail").over(before))
        .join(tails, "first", "left")
        .select("part", F.col("first").alias("conv_id"), F.when(F.col("first") == F.col("last"), F.col("inner")).otherwise(F.col("tails")).alias("carry"))
        .where("carry IS NOT NULL")
    )
    return placed.join(F.broadcast(carried), ["part", "conv_id"], "left").select(
        "conv_id", (F.col("k") + 1 + F.coalesce("carry", F.lit(0))).alias("pos"), "id", "words"
    )


def share_openings(turns: DataFrame, group: int, most: int) -> DataFrame:
    """Conversations rebuilt to share openings: conv_id, pos, id, words; one row with pos 0 for each conversation.

    Conversation c gets the first h turns of conversation c - c % ``group``
    (all if fewer, none if absent), then its own turns after its first h;
    h = crc32(c) % (``most`` + 1).
    """
    base = (F.col("conv_id") - F.col("conv_id") % group).alias("base")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).alias("h")
    heads = turns.where((F.col("conv_id") % group == 0) & (F.col("pos") <= most)).select(
        F.col("conv_id").alias("base"), F.col("pos").alias("head"), F.col("id").alias("head_id"), F.col("words").alias("head_words")
    )
    convs = turns.where("pos = 1").select("conv_id", base, h)
    opening = convs.join(heads, "base").where("head <= h").select("conv_id", F.col("head").alias("pos"), F.col("head_id").alias("id"), F.col("head_words").alias("words"))
    lengths = heads.groupBy("base").agg(F.max("head").alias("heads"))
    own = (
        turns.select("*", base, h)
        .where("pos > h")
        .join(lengths, "base", "left")
        .select("conv_id", (F.col("pos") - F.col("h") + F.least("h", F.coalesce("heads", F.lit(0)))).alias("pos"), "id", "words")
    )
    mark = convs.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("id"), F.lit(0).cast("long").alias("words"))
    return opening.unionByName(own).unionByName(mark)


def _block(pos: Column) -> Column:
    return F.when(pos <= FIRST_BLOCK, 0).otherwise(F.floor((pos - FIRST_BLOCK - 1) / NEXT_BLOCK) + 1).cast("int")


def _depth(block: Column | str, place: Column) -> Column:
    """Depth of a block's place (from 1; 0 is the end of the block before)."""
    block = F.col(block) if isinstance(block, str) else block
    start = F.when(block == 0, 0).otherwise((block - 1) * NEXT_BLOCK + FIRST_BLOCK)
    return (start + place).cast("long")


def _rolled(rows: DataFrame, width: int, measures: str) -> DataFrame:
    """block, prior, prefix (ids), level (their number) and ``measures`` of every node of the rows' blocks."""
    columns = [f"t{i}" for i in range(width)]
    wide = rows.select("*", *(F.get("ids", F.lit(i)).alias(c) for i, c in enumerate(columns)))
    names = ", ".join(columns)
    nodes = rows.sparkSession.sql(
        f"""SELECT block, prior, filter(array({names}), t -> t IS NOT NULL) AS prefix,
                   {width} - bit_count(grouping_id()) AS level, {measures}
            FROM {{wide}} GROUP BY block, prior, ROLLUP ({names})""",
        wide=wide,
    )
    # columns behind a conversation's end are null and make no node
    return nodes.where("level > 0 AND size(prefix) = level")


def _grown(turns: DataFrame, lengths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, nodes) of all blocks.

    rows: conv_id, len, block, prior, ids, owner, n_convs: each block row with
    the node of its last turn; nodes: block, prior, prefix, level, depth,
    conv_id (smallest member), n_convs, len (of the longest member).
    """
    blocks = (
        turns.where("pos > 0")
        .groupBy("conv_id", _block(F.col("pos")).alias("block"))
        .agg(F.array_sort(F.collect_list(F.struct("pos", "id"))).alias("ids"))
        .select("conv_id", "block", F.col("ids.id").alias("ids"))
    )
    blocks = stored(blocks.join(lengths, "conv_id"), "trie-blocks")
    current = blocks.where("block = 0").withColumn("prior", F.lit(None).cast("long"))
    block, rows, nodes = 0, [], []
    while True:
        width = NEXT_BLOCK if block else FIRST_BLOCK
        if block:
            current = stored(current, "trie-rows")
        made = _rolled(current, width, "min(conv_id) AS conv_id, count(*) AS n_convs, max(len) AS len")
        made = stored(made.withColumn("depth", _depth("block", F.col("level"))), "trie-made")
        ends = made.select(F.col("prior").alias("of"), F.col("prefix").alias("ids"), F.col("conv_id").alias("owner"), "n_convs")
        reached = current.join(ends, (current.ids == ends.ids) & current.prior.eqNullSafe(ends.of)).select(
            *(current[c] for c in ("conv_id", "len", "block", "prior", "ids")), "owner", "n_convs"
        )
        reached = stored(reached, "trie-reached")
        rows.append(reached)
        nodes.append(made)
        shared = reached.where((F.col("n_convs") > 1) & (F.col("len") > _depth("block", F.lit(width))))
        if not shared.limit(1).count():
            break
        block += 1
        current = blocks.where(F.col("block") == block).join(shared.select("conv_id", F.col("owner").alias("prior")), "conv_id").select(
            "conv_id", "block", "ids", "len", "prior"
        )
    every_row, every_node = rows[0], nodes[0]
    for more in rows[1:]:
        every_row = every_row.unionByName(more)
    for more in nodes[1:]:
        every_node = every_node.unionByName(more)
    return every_row, every_node


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (conv_id, depth, member) rows as (conv_id, depth, member, members): up to _JOINED ids in one string."""
    names = ["conv_id", "depth", "member", "members"]
    for batch in batches:
        for start in range(0, batch.num_rows, _JOINED):
            part = batch.slice(start, _JOINED)
            conv, depth, member = (part.column(c).to_numpy() for c in names[:3])
            cut = np.flatnonzero((conv[1:] != conv[:-1]) | (depth[1:] != depth[:-1])) + 1
            first = np.concatenate([[0], cut])
            texts = [",".join(map(str, x.tolist())) for x in np.split(member, cut)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(conv[first]), pa.array(depth[first]), pa.array(member[first]), pa.array(texts, pa.string())], names
            )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over each node's strings, in order, as a stream."""
    node, digest = None, None

    def out():
        return pa.RecordBatch.from_pylist([{"conv_id": node[0], "depth": node[1], "ends_sha256": digest.hexdigest()}])

    for batch in batches:
        rows = zip(batch.column("conv_id").to_pylist(), batch.column("depth").to_pylist(), batch.column("members"))
        for conv, depth, members in rows:
            if (conv, depth) != node:
                if node is not None:
                    yield out()
                node, digest = (conv, depth), hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(members.as_py().encode())
    if node is not None:
        yield out()


def _ends_hashes(ends: DataFrame) -> DataFrame:
    """conv_id, depth, ends_sha256 of nodes from (conv_id, depth, member) rows of any number per node.

    One hash of one ordered list is a chain by its nature; what is chained is
    strings of some thousand ids, made in parallel, never held together.
    """
    key = ["conv_id", "depth", "member"]
    strings = ends.repartitionByRange(*key).sortWithinPartitions(*key).mapInArrow(
        _joined, "conv_id long, depth long, member long, members string"
    )
    return (
        strings.repartition("conv_id", "depth")
        .sortWithinPartitions(*key)
        .mapInArrow(_hashed, "conv_id long, depth long, ends_sha256 string")
    )


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per node of the trie over ``turns`` (conv_id, pos from 1, id, words; a row with pos 0 per conversation).

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. Conversations without turns are members of the
    root alone. A table without conversations gives no row.
    """
    turns = stored(turns, "trie-turns")
    first, convs = turns.where("pos = 0").agg(F.min("conv_id"), F.count(F.lit(1))).first()
    if not convs:
        return turns.sparkSession.createDataFrame([], TRIE_SCHEMA)
    lengths = stored(turns.groupBy("conv_id").agg(F.max("pos").alias("len")), "trie-lengths")
    rows, nodes = _grown(turns, lengths)
    nodes = stored(_with_parents(nodes, first), "trie-nodes")
    single = _alone(nodes.where("n_convs = 1")).unionByName(_alone(_tails(rows, turns)))

    # nodes with several members, and the root
    key = ["conv_id", "depth"]
    none = F.lit(None).cast("long").alias("parent_conv_id")
    root = lengths.where(F.col("conv_id") == first).select("conv_id", F.lit(0).cast("long").alias("depth"), none, F.lit(convs).cast("long").alias("n_convs"))
    children = nodes.groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    chain = Window.partitionBy("conv_id")  # as long as a shared prefix at most
    shared = (
        nodes.where("n_convs > 1")
        .select(*key, "parent_conv_id", "n_convs")
        .unionByName(root)
        .join(children, key, "left")
        .join(turns.select("conv_id", F.col("pos").alias("depth"), "words"), key)
        .withColumn("value", (F.col("n_convs") - 1) * F.col("words"))
        .withColumn("own", F.sum("value").over(chain))
        .withColumn("own_from_here", F.sum("value").over(chain.orderBy(F.desc("depth"))))
    )
    shared = stored(shared, "trie-shared")
    ends = rows.where((F.col("n_convs") > 1) & (_depth("block", F.size("ids")) == F.col("len"))).select(
        F.col("owner").alias("conv_id"), F.col("len").alias("depth"), F.col("conv_id").alias("member")
    )
    turnless = lengths.where("len = 0").select(F.lit(first).alias("conv_id"), F.col("len").alias("depth"), F.col("conv_id").alias("member"))
    ends = stored(ends.unionByName(turnless), "trie-ends")
    sums = _subtree_sums(rows, shared, ends, first)
    return (
        shared.join(sums, key, "left")
        .join(_ends_hashes(ends), key, "left")
        .select(
            *key,
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            F.greatest("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
            (F.col("brings") - F.col("own") + F.col("own_from_here")).cast("long").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(_NO_TURNS)).alias("ends_sha256"),
        )
        .unionByName(single)
    )


def _tails(rows: DataFrame, turns: DataFrame) -> DataFrame:
    """Nodes behind the block in which a conversation became a node's only member: its own turns."""
    alone = rows.where("n_convs = 1").select("conv_id", "len", _depth(F.col("block") + 1, F.lit(0)).alias("upto")).where("len > upto")
    return turns.join(alone, "conv_id").where("pos > upto").select(
        "conv_id", F.col("pos").alias("depth"), F.col("conv_id").alias("parent_conv_id"), "len"
    )


def _alone(nodes: DataFrame) -> DataFrame:
    """Result rows of nodes with one member (conv_id, depth, parent_conv_id, len)."""
    last = F.col("depth") == F.col("len")
    return nodes.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        F.lit(1).cast("long").alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(last, F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(F.lit(_NO_TURNS)).alias("ends_sha256"),
    )


def _with_parents(nodes: DataFrame, first: int) -> DataFrame:
    """``nodes`` with parent_conv_id: the node's own conv_id, but where that conversation's own nodes begin."""
    shared = nodes.where("n_convs > 1").select(
        F.col("block").alias("in_block"), F.col("prior").alias("behind"), F.col("prefix").alias("before"), F.col("conv_id").alias("parent")
    )
    tops = nodes.groupBy("conv_id").agg(F.min_by(F.struct("block", "prior", "prefix", "level", "depth"), "depth").alias("top"))
    tops = tops.select("conv_id", "top.*").withColumn("opening", F.slice("prefix", 1, F.col("level") - 1))
    inner = tops.where("level > 1").join(
        shared, F.expr("block = in_block AND prior <=> behind AND opening = before")
    ).select("conv_id", "depth", "parent")
    outer = tops.where("level = 1").select("conv_id", "depth", F.coalesce("prior", F.lit(first)).alias("parent"))
    tops = inner.unionByName(outer).select("conv_id", F.col("depth").alias("top"), "parent")
    parent = F.when(F.col("depth") > F.col("top"), F.col("conv_id")).otherwise(F.col("parent"))
    return nodes.join(tops, "conv_id").withColumn("parent_conv_id", parent).drop("top", "parent")


def _subtree_sums(rows: DataFrame, shared: DataFrame, ends: DataFrame, first: int) -> DataFrame:
    """conv_id, depth, brings, n_leaves of nodes with several members, and of the root.

    A conversation brings the value of its own nodes, and one leaf if it is
    the smallest of those that end in a childless node.
    """
    key = ["conv_id", "depth"]
    childless = shared.where("n_children IS NULL AND depth > 0").select(*key)
    leaf = ends.where("conv_id = member").join(childless, key).select("conv_id").unionByName(rows.where("n_convs = 1").select("conv_id"))
    value = shared.groupBy("conv_id").agg(F.sum("value").alias("brings"))
    brought = value.join(leaf.withColumn("leaf", F.lit(1)), "conv_id", "full")
    zero = F.lit(0).cast("long")
    amounts = [F.coalesce(c, zero).cast("long").alias(c) for c in ("brings", "leaf")]
    brought = stored(brought.select("conv_id", *amounts), "trie-brought")
    bearing = stored(rows.join(brought, "conv_id", "left").select("conv_id", "block", "prior", "ids", *amounts), "trie-rows")
    measures = "min(conv_id) AS conv_id, count(*) AS n, sum(brings) AS brings, sum(leaf) AS n_leaves"
    sums = brought.agg(F.sum("brings").alias("brings"), F.sum("leaf").alias("n_leaves")).select(
        F.lit(first).alias("conv_id"), F.lit(0).cast("long").alias("depth"), "brings", "n_leaves"
    )
    for which, width in (("block = 0", FIRST_BLOCK), ("block > 0", NEXT_BLOCK)):
        made = _rolled(bearing.where(which), width, measures).where("n > 1")
        sums = sums.unionByName(made.select("conv_id", _depth("block", F.col("level")).alias("depth"), "brings", "n_leaves"))
    return sums
