"""Repeated windows of a corpus, found by content: the shuffles behind suffix_dedup and rlz_dedup.

A window is W consecutive units (bytes or words) of one document. Its anchor
is the k-gram in it with the least hash, the first of equals, so equal windows
have equal anchors at equal places, wherever they stand. Consecutive windows
with one anchor are a *run*; a run's text is all its windows cover.

1. ``_occurrences``: each task cuts its texts into runs and sends them, as
   packed columns, to the bucket of their anchor. Runs that its own texts
   settle (``Rule.settle``) are not sent, so a line that fills a third of the
   corpus costs each task a few rows.
2. ``_resolve``: a bucket settles runs whose whole text it knows. Runs of one
   anchor with different texts may share some windows only. Such a window
   reaches half its free length to the left or to the right of the anchor, so
   the texts of runs that agree with another one on either half are asked for.
3. ``_contexts``: documents, dealt to parts by their key, hand out those
   texts to the buckets.
4. ``Rule.match``: a bucket indexes its texts and finds the windows that also
   stand in another one.
5. ``covered``: documents meet the covered ranges, once more by part.

Texts travel as compressed blocks. Every step is a shuffle by bucket or part
with bounded partitions; nothing is collected and no pairs are made.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridepulse.llm.common import as_bytes, slices, stored
from ridepulse.llm.words import BLANK, Ranges, Words, mixed

ROUTED = "kind int, part int, blob binary"
RUNS, SPANS, ASKED, TEXTS = 0, 1, 2, 3
# Bytes of text cut into runs at once; each takes about ten 8-byte numbers meanwhile.
_RUN_SLICE = 1 << 20
# Bytes of asked texts that a task holds before it sends them, and shards that a bucket's texts are indexed in.
_HELD_TEXT = 8 << 20
_SHARDS = 16
_POSITION = np.uint64((1 << 40) - 1)


def _pack(**columns: np.ndarray | bytes) -> bytes:
    return zstandard.compress(pickle.dumps(columns, protocol=5), 1)


def _unpack(blob: bytes) -> dict:
    return pickle.loads(zstandard.decompress(blob))


def _rows(found: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    kind, part, blob = zip(*found) if found else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(kind, pa.int32()), pa.array(part, pa.int32()), pa.array(blob, pa.binary())], ["kind", "part", "blob"]
    )


def _by_part(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(part, rows of it in their order)."""
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    for rows in np.split(order, cuts) if len(order) else []:
        yield int(part[rows[0]]), rows


def _diff(x: np.ndarray) -> np.ndarray:
    """``x`` as steps, which compress better."""
    return np.diff(x, prepend=np.zeros(1, x.dtype))


@dataclass
class Units:
    """The units of a slice of texts: their values, and each text's first one."""

    values: np.ndarray
    first: np.ndarray

    @classmethod
    def of_bytes(cls, texts: list[bytes]) -> Units:
        return cls(
            np.frombuffer(b"".join(texts), np.uint8),
            np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))]),
        )

    @classmethod
    def of_words(cls, texts: list[bytes]) -> Units:
        w = Words(texts, BLANK)
        return cls(w.hash, w.first)


# Columns of a table of runs: a document's key (id, hash of its text), first window, number of windows, hashes of the
# anchor and of the run's text, and how often the text is known to stand.
# left, right: hashes of the anchor with half a window's free length on that side, 0 where no window reaches that far.
RUN_COLUMNS = ("doc", "text", "start", "size", "anchor", "run", "left", "right", "copies")


def runs(units: Units, width: int, gram: int) -> dict[str, np.ndarray]:
    """The runs of each text of the slice; ``row`` is the text's number."""
    n, span = len(units.values), width - gram + 1
    windows = np.maximum(np.diff(units.first) - width + 1, 0)
    if not windows.sum():
        numbers = {c: np.empty(0, np.int64) for c in ("row", "start", "size")}
        return numbers | {c: np.empty(0, np.uint64) for c in ("anchor", "run", "left", "right")}
    ranges = Ranges(units.values)
    grams = ranges.windows(gram)
    least = (grams & ~_POSITION) | np.arange(len(grams), dtype=np.uint64)
    reach = 1
    while 2 * reach <= span:
        least, reach = np.minimum(least[:-reach], least[reach:]), 2 * reach
    if reach < span:
        least = np.minimum(least[: reach - span], least[span - reach :])
    row = np.repeat(np.arange(len(windows)), windows)
    at = np.arange(len(row)) + np.repeat(units.first[:-1] - np.cumsum(windows) + windows, windows)
    place = (least[at] & _POSITION).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (row[1:] != row[:-1])]))
    size = np.diff(np.append(new, len(row)))
    start, place, half = at[new], place[new], (width - gram) // 2
    end = start + size - 1 + width

    def side(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        there = (low >= start) & (high <= end)
        h = ranges.hash(np.where(there, low, 0), np.where(there, high, 0)) >> np.uint64(48)
        return np.where(there, np.maximum(h, np.uint64(1)), np.uint64(0))

    return {
        "row": row[new], "start": start - units.first[row[new]], "size": size,
        "anchor": mixed(grams[place]) >> np.uint64(16), "run": ranges.hash(start, end) >> np.uint64(16),
        "left": side(place - half, place + gram), "right": side(place, place + width - half + 1),
    }


def groups(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, group number in that order) by equal values of the columns."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    for c in columns:
        c = c[order]
        new[1:] |= c[1:] != c[:-1]
    return order, np.cumsum(new)


@dataclass
class Rule:
    """What makes a window count as repeated.

    settle(table) -> (covered, send): which runs are covered for certain, and
    which rows others still need to know. match(data, sizes, doc) -> mask per
    unit of the joined texts: windows that start there and stand elsewhere.
    """

    width: int
    gram: int
    units: Callable[[list[bytes]], Units]
    settle: Callable[[dict], tuple[np.ndarray, np.ndarray]]
    match: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]
    needs_id: bool
    # Runs that one task holds before it settles and sends them.
    held_runs: int = 400_000


def _take(table: dict, rows: np.ndarray) -> dict:
    return {k: v[rows] for k, v in table.items()}


def _spans(table: dict, width: int, parts: np.ndarray) -> list[tuple[int, int, bytes]]:
    """Covered ranges of a table of runs, merged, as blobs for the documents' parts."""
    order = np.lexsort((table["start"], table["text"], table["doc"]))
    t = _take(table, order)
    start, end = t["start"], t["start"] + t["size"] - 1 + width
    if not len(start):
        return []
    same = np.concatenate([[False], (t["doc"][1:] == t["doc"][:-1]) & (t["text"][1:] == t["text"][:-1])])
    # ends grow with starts inside a document, as runs do not overlap in their windows
    new = ~same | (start > np.concatenate([[0], end[:-1]]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    doc, text, start, end = t["doc"][first], t["text"][first], start[first], end[last]
    return [
        (SPANS, p, _pack(doc=_diff(doc[r]), text=text[r], start=start[r].astype(np.int32), size=(end - start)[r].astype(np.int32)))
        for p, r in _by_part(part_of(doc, text, parts))
    ]


def part_of(doc: np.ndarray, text: np.ndarray, parts: np.ndarray) -> np.ndarray:
    return parts[(mixed(doc.view(np.uint64) ^ text) >> np.uint64(33)).astype(np.int64) % len(parts)]


def bucket_of(anchor: np.ndarray, parts: np.ndarray) -> np.ndarray:
    return parts[(anchor % np.uint64(len(parts))).astype(np.int64)]


def _keys(batch: pa.RecordBatch, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Documents' keys: id (0 for null) and hash of the text."""
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    doc = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    text = Ranges(np.frombuffer(b"".join(texts), np.uint8)).hash(np.concatenate([[0], ends[:-1]])[: len(ends)], ends)
    return doc, text


def _occurrences(rule: Rule, parts: np.ndarray):
    def send(held: list[dict]) -> pa.RecordBatch:
        t = {k: np.concatenate([h[k] for h in held]) for k in RUN_COLUMNS}
        covered, keep = rule.settle(t)
        found = _spans(_take(t, covered), rule.width, parts)
        t = _take(t, keep)
        order, key = groups(t["doc"], t["text"])
        first = order[np.flatnonzero(np.diff(key, prepend=-1))]
        ids, hashes = t["doc"][first], t["text"][first]
        of_row = np.empty(len(order), np.int64)
        of_row[order] = key
        for p, r in _by_part(bucket_of(t["anchor"], parts)):
            own, of = np.unique(of_row[r], return_inverse=True)
            columns = {
                "ids": _diff(ids[own]), "texts": hashes[own], "of": _diff(of.astype(np.int32)), "start": _diff(t["start"][r].astype(np.int32)),
                "size": t["size"][r].astype(np.uint8), "copies": t["copies"][r].astype(np.uint8),
                # 48 bits each: runs are taken as equal if both agree
                "anchor": t["anchor"][r].view(np.uint8).reshape(-1, 8)[:, :6].copy(),
                "run": t["run"][r].view(np.uint8).reshape(-1, 8)[:, :6].copy(),
                "left": t["left"][r].astype(np.uint16), "right": t["right"][r].astype(np.uint16),
            }
            found.append((RUNS, p, _pack(**columns)))
        return _rows(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in slices(batches, _RUN_SLICE):
            texts = as_bytes(batch.column("text"))
            doc, text = _keys(batch, texts)
            t = runs(rule.units(texts), rule.width, rule.gram)
            if rule.needs_id:
                t = _take(t, batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)[t["row"]])
            row = t.pop("row")
            held.append(t | {"doc": doc[row], "text": text[row], "copies": np.ones(len(row), np.int64)})
            n += len(row)
            if n >= rule.held_runs:
                yield send(held)
                held, n = [], 0
        if held:
            yield send(held)

    return run


def _six(x: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x), 8), np.uint8)
    out[:, :6] = x
    return out.view(np.uint64).ravel()


def _several(t: dict, side: str) -> np.ndarray:
    """Runs that agree with another text of their anchor on ``side``."""
    out = np.zeros(len(t["doc"]), bool)
    there = np.flatnonzero(t[side])
    order, group = groups(t["anchor"][there], t[side][there])
    if len(order):
        run, starts = t["run"][there][order], np.flatnonzero(np.diff(group, prepend=-1))
        several = np.minimum.reduceat(run, starts) != np.maximum.reduceat(run, starts)
        out[there[order]] = several[group]
    return out


def _resolve(rule: Rule, parts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            passed = []
            for kind, part, blob in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if kind != RUNS:
                    passed.append((kind, part, blob))
                    continue
                c = _unpack(blob)
                of = np.cumsum(c["of"])
                held.append(
                    {"doc": np.cumsum(c["ids"])[of], "text": c["texts"][of], "start": np.cumsum(c["start"]).astype(np.int64),
                     "size": c["size"].astype(np.int64), "copies": c["copies"].astype(np.int64), "anchor": _six(c["anchor"]), "run": _six(c["run"]), "left": c["left"], "right": c["right"]}
                )
            yield _rows(passed)
        if not held:
            return
        t = {k: np.concatenate([h[k] for h in held]) for k in RUN_COLUMNS}
        held.clear()
        covered, keep = rule.settle(t)
        found = _spans(_take(t, covered), rule.width, parts)
        t = _take(t, keep)
        partial = _several(t, "left") | _several(t, "right")
        t = _take(t, np.flatnonzero(partial))
        if len(t["doc"]):
            for p, r in _by_part(part_of(t["doc"], t["text"], parts)):
                found.append((ASKED, p, _pack(**{k: t[k][r] for k in ("doc", "text", "start", "size", "anchor")})))
        yield _rows(found)

    return run


def _packed_documents(docs: DataFrame, parts: np.ndarray) -> DataFrame:
    """``docs`` (doc_id, text) as compressed blocks for their parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = as_bytes(batch.column("text"))
            doc, text = _keys(batch, texts)
            valid = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            yield _rows(
                [
                    (TEXTS, p, _pack(doc=doc[r], text=text[r], valid=valid[r], texts=[texts[i] for i in r.tolist()]))
                    for p, r in _by_part(part_of(doc, text, parts))
                ]
            )

    return docs.mapInArrow(run, ROUTED)


def _met(blobs: list[dict], names: list[str]) -> dict[tuple[int, int], dict[str, np.ndarray]]:
    """Columns of ``blobs`` by document key."""
    if not blobs:
        return {}
    t = {k: np.concatenate([b[k] for b in blobs]) for k in ("doc", "text", *names)}
    order, group = groups(t["doc"], t["text"])
    cuts = np.flatnonzero(np.diff(group)) + 1
    return {(int(t["doc"][r[0]]), int(t["text"][r[0]])): _take(t, r) for r in np.split(order, cuts)}


def _meet(batches: Iterator[pa.RecordBatch], kind: int, names: list[str]) -> Iterator[tuple[dict, dict]]:
    """(columns for the documents of a block, block): blobs of ``kind`` come before the texts."""
    blobs, met = [], None
    for batch in batches:
        for k, blob in zip(batch.column("kind").to_pylist(), batch.column("blob").to_pylist()):
            c = _unpack(blob)
            if k != TEXTS:
                if k == SPANS:
                    c["doc"] = np.cumsum(c["doc"])
                blobs.append(c)
                continue
            if met is None:
                met = _met(blobs, names)
                blobs.clear()
            yield met, c


def _contexts(rule: Rule, parts: np.ndarray):
    def send(held: list[tuple[dict, np.ndarray]]) -> pa.RecordBatch:
        t = {k: np.concatenate([h[k] for h, _ in held]) for k in ("doc", "text", "start", "size", "anchor")}
        data, length = np.concatenate([d for _, d in held]), t["size"] - 1 + rule.width
        begin = np.cumsum(length) - length
        found = []
        for p, r in _by_part(bucket_of(t["anchor"], parts)):
            # texts of one anchor stay in one shard
            shard = (t["anchor"][r] // np.uint64(len(parts)) % np.uint64(_SHARDS)).astype(np.uint8)
            columns = {k: t[k][r] for k in ("doc", "text", "start", "size")}
            found.append((TEXTS, p, _pack(**columns, shard=shard, data=data[_stretch(begin[r], length[r])])))
        return _rows(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for met, block in _meet(batches, ASKED, ["start", "size", "anchor"]):
            keys = list(zip(block["doc"].tolist(), block["text"].tolist()))
            wanted = [i for i, key in enumerate(keys) if key in met]
            if not wanted:
                continue
            units = rule.units([block["texts"][i] for i in wanted])
            columns = [met[keys[i]] for i in wanted]
            t = {k: np.concatenate([c[k] for c in columns]) for k in ("doc", "text", "start", "size", "anchor")}
            begin = t["start"] + np.repeat(units.first[:-1], [len(c["start"]) for c in columns])
            data = units.values[_stretch(begin, t["size"] - 1 + rule.width)]
            held.append((t, data))
            n += data.nbytes
            if n >= _HELD_TEXT:
                yield send(held)
                held, n = [], 0
        if held:
            yield send(held)

    return run


def _stretch(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Places begin .. begin + length - 1 of each row, joined."""
    return np.arange(length.sum()) + np.repeat(begin - np.cumsum(length) + length, length)


def _matches(rule: Rule, parts: np.ndarray):
    def shards(blobs: list[dict]) -> Iterator[pa.RecordBatch]:
        all_ = {k: np.concatenate([b[k] for b in blobs]) for k in ("doc", "text", "start", "size", "shard", "data")}
        blobs.clear()
        data, length = all_.pop("data"), all_["size"] - 1 + rule.width
        begin = np.cumsum(length) - length
        for _, r in _by_part(all_["shard"]):
            t, size = _take(all_, r), length[r]
            hit = np.flatnonzero(rule.match(data[_stretch(begin[r], size)], size, t["doc"]))
            context = np.repeat(np.arange(len(size)), size)[hit]
            inside = hit - (np.cumsum(size) - size)[context]
            found = {
                "doc": t["doc"][context], "text": t["text"][context], "start": t["start"][context] + inside,
                "size": np.ones(len(hit), np.int64),
            }
            yield _rows(_spans(found, rule.width, parts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by part."""
        now, held = None, []
        for batch in batches:
            for part, blob in zip(batch.column("part").to_pylist(), batch.column("blob").to_pylist()):
                if part != now and held:
                    yield from shards(held)
                    held = []
                now = part
                held.append(_unpack(blob))
        if held:
            yield from shards(held)

    return run


def covered(docs: DataFrame, rule: Rule, digest, schema: str) -> DataFrame:
    """``digest(doc_id, text, mask)`` for every row of ``docs``; mask: units in repeated windows, or None.

    ``docs``: doc_id (long) and text. A null text is the empty text.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # part numbers that Spark's hash deals to a partition each
    ids = spark.range(64 * n).select(F.col("id").cast("int").alias("id"))
    own = ids.groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("p")).agg(F.min("id").alias("id"))
    parts = np.sort(np.array([r.id for r in own.collect()], np.int32))

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition(n, "part")

    runs_ = docs.mapInArrow(_occurrences(rule, parts), ROUTED)
    settled = stored(dealt(runs_).mapInArrow(_resolve(rule, parts), ROUTED), "passages")
    texts = _packed_documents(docs, parts)
    asked = settled.where(F.col("kind") == ASKED).unionByName(texts)
    contexts = dealt(asked).sortWithinPartitions("kind").mapInArrow(_contexts(rule, parts), ROUTED)
    found = dealt(contexts).sortWithinPartitions("part").mapInArrow(_matches(rule, parts), ROUTED)
    spans = settled.where(F.col("kind") == SPANS).unionByName(found).unionByName(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for met, block in _meet(batches, SPANS, ["start", "size"]):
            out = []
            rows = zip(block["doc"].tolist(), block["text"].tolist(), block["valid"].tolist(), block["texts"])
            for doc, key, valid, text in rows:
                span = met.get((doc, key))
                if span is not None:
                    end = int((span["start"] + span["size"]).max())
                    edge = np.zeros(end + 1, np.int64)
                    np.add.at(edge, span["start"], 1)
                    np.add.at(edge, span["start"] + span["size"], -1)
                    span = np.cumsum(edge[:-1]) > 0
                out.append((doc if valid else None, *digest(text, span)))
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema=arrow)

    names = [c.split()[0] for c in schema.split(", ")]
    arrow = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in schema.split(", ")])
    return dealt(spans).sortWithinPartitions("kind").mapInArrow(run, schema)
