"""Language identification by cross-parsing entropy.

For each language a suffix automaton of a bounded labelled sample recognises
every string of the sample. A text is parsed greedily against it: the longest
match is a phrase, the next phrase starts where it ended. The language that
needs the fewest phrases, each priced at log2 of its sample's length and set
against the text's length, wins. A phrase costs no less than naming a symbol of
the alphabet outright, or a sample of a few symbols would be the cheapest one,
its unknown symbols phrases at a bit or two. Walking the automaton from its root until a
transition is missing *is* the longest match, so the parse is one table lookup
a symbol, done for thousands of stretches of texts at once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridepulse.llm.common import slices

# Bounds of the labelled sample: rows per language and in all (one a language at least), taken among the texts
# of at most TEXT_CHARS. Sampled texts are learned whole.
DOCS_PER_LANG, SAMPLE_DOCS, TEXT_CHARS = 32, 512, 1000
# The share held out for tests: crc32 of the id's text mod FOLDS is 0.
FOLDS = 5
# Texts are parsed in stretches of this many symbols, side by side.
_STRETCH = 128

SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


def _automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``symbols``, state 0 the root."""
    go, link, length, last = [{}], [-1], [0], 0
    for c in symbols:
        cur = len(go)
        go.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = cur
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(go)
                go.append(dict(go[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return go


def _lower_bytes(texts: list[str]) -> list[bytes]:
    return [t.lower().encode() for t in texts]


@dataclass
class Model:
    """A language's walk: next row of the table by row and symbol; ~row where a phrase ends before the symbol."""

    lang: str
    size: int
    table: np.ndarray


@dataclass
class Models:
    """All languages' models over one alphabet: letters and non-ASCII bytes, 0 for runs of anything else."""

    classes: np.ndarray
    pad: int
    models: list[Model]

    @classmethod
    def train(cls, samples: dict[str, list[str]]) -> Models:
        joined = {lang: b" ".join(_lower_bytes(texts)) for lang, texts in sorted(samples.items())}
        seen = sorted(b for b in set(b"".join(joined.values())) if b >= 128 or chr(b).isalpha())
        classes = np.zeros(256, np.uint8)
        for i in range(256):  # bytes that no sample has share the class after the known ones
            if i >= 128 or chr(i).isalpha():
                classes[i] = len(seen) + 1
        classes[seen] = np.arange(1, len(seen) + 1)
        pad = len(seen) + 2
        width, models = pad + 1, []
        for lang, text in joined.items():
            symbols = _symbols(classes, np.frombuffer(text, np.uint8)).tolist()
            if not symbols:
                continue
            go = _automaton(symbols)
            # a symbol that the sample lacks is a phrase of its own: the last row is the state after one
            alone = len(go)
            start = np.array([go[0].get(c, alone) * width for c in range(width)], np.int32)
            table = np.tile(~start, (alone + 1, 1))
            table[0] = start
            for s, edges in enumerate(go):
                table[s, list(edges)] = [t * width for t in edges.values()]
            table[:, pad] = np.arange(alone + 1) * width
            models.append(Model(lang, len(symbols), table.ravel()))
        return cls(classes, pad, models)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """(language or und, score) of each text."""
        known = [t if t and self.models and any(map(str.isalpha, t)) else "" for t in texts]
        data = _lower_bytes(known)
        buffer = np.frombuffer(b"".join(data), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, data), np.int64, len(data)))
        symbols, counts = _symbols(self.classes, buffer, ends)
        stretches = -(-counts // _STRETCH)
        base = np.concatenate([[0], np.cumsum(stretches)])
        grid = np.full(int(base[-1]) * _STRETCH, self.pad, np.uint8)
        first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        at = np.arange(len(symbols)) + np.repeat(base[:-1] * _STRETCH - first, counts)
        grid[at] = symbols
        steps = np.ascontiguousarray(grid.reshape(-1, _STRETCH).T).astype(np.int32)
        doc = np.repeat(np.arange(len(texts)), stretches)
        price = np.empty((len(self.models), len(texts)))
        for i, m in enumerate(self.models):
            phrases = _phrases(m.table, steps, np.diff(doc, prepend=-1) != 0)
            price[i] = np.bincount(doc, phrases, len(texts)) * math.log2(max(m.size, self.pad) + 1)
        out_lang, out_score = [], []
        for d, text in enumerate(known):
            if not text:
                out_lang.append("und")
                out_score.append(0.0)
                continue
            order = sorted(price[:, d].tolist())
            out_lang.append(self.models[int(price[:, d].argmin())].lang)
            out_score.append(1.0 if len(order) == 1 else 1 - order[0] / order[1])
        return out_lang, out_score


def _phrases(table: np.ndarray, steps: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Phrases that begin in each stretch (a column of ``steps``); ``first`` ones start at the root, others go on.

    All are parsed from the root, then again those whose stretch before ended
    in another state, until none does. Parses of the same symbols soon meet,
    so the second time settles nearly all.
    """
    entry, end, phrases = np.zeros((3, steps.shape[1]), np.int32)
    todo = np.arange(steps.shape[1])
    while len(todo):
        row, over_all = entry[todo], np.zeros(len(todo), np.int32)
        for symbol in steps if len(todo) == steps.shape[1] else steps[:, todo]:
            to = table[row + symbol]
            over = to >> 31
            over_all -= over
            row = to ^ over
        phrases[todo], end[todo] = over_all, row
        after = todo[todo < steps.shape[1] - 1] + 1
        after = after[~first[after]]
        todo = after[entry[after] != end[after - 1]]
        entry[todo] = end[todo - 1]
    return phrases + first


def _symbols(classes: np.ndarray, buffer: np.ndarray, ends: np.ndarray | None = None):
    """Symbols of the joined texts, runs of class 0 as one; with ``ends`` also each text's number of them."""
    s = classes[buffer]
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != 0) | (s[:-1] != 0)
    if ends is None:
        return s[keep]
    starts = np.concatenate([[0], ends[:-1]])
    keep[starts[starts < len(s)]] = True  # a text never loses its first symbol to the text before
    upto = np.concatenate([[0], np.cumsum(keep)])
    return s[keep], upto[ends] - upto[starts]


def held_out(doc_id) -> F.Column:
    """Whether a row is kept out of learning; a null id is neither learned from nor held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def training_sample(docs: DataFrame) -> dict[str, list[str]]:
    """Bounded samples of whole labelled texts by language, not in the held-out fold.

    The rows with the least hashes among those of at most ``TEXT_CHARS``; a
    language that has none of these learns from its shortest text.
    """
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    pool = docs.select(
        doc_id.alias("doc_id"), F.col("lang").cast("string").alias("lang"), text.alias("text"), F.length(text).alias("chars")
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.crc32(doc_id.cast("string")) % FOLDS != 0))
    # long texts are ranked behind all others, without carrying them
    short = pool.withColumn("text", F.when(F.col("chars") <= TEXT_CHARS, F.col("text")))
    by = Window.partitionBy("lang").orderBy(F.col("text").isNull(), F.xxhash64("doc_id"), "doc_id", "text")
    rows = short.withColumn("_n", F.row_number().over(by)).where(F.col("_n") <= DOCS_PER_LANG).collect()
    out: dict[str, list[str]] = {r.lang: [] for r in rows}
    most = max(1, min(DOCS_PER_LANG, SAMPLE_DOCS // max(1, len(out))))
    for r in sorted(rows, key=lambda r: (r.lang, r._n)):
        if r.text is not None and len(out[r.lang]) < most:
            out[r.lang].append(r.text)
    only_long = [lang for lang, texts in out.items() if not texts]
    if only_long:
        least = F.min(F.struct("chars", F.xxhash64("doc_id").alias("hash"), "doc_id", "text")).alias("least")
        for r in pool.where(F.col("lang").isin(only_long)).groupBy("lang").agg(least).collect():
            out[r.lang].append(r.least.text)
    return out


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text has a learned language, a null ``lang`` set to the prediction.

    Rows predicted ``und`` (null or letterless texts) go; other columns pass unchanged.
    """
    held = docs.sparkSession.sparkContext.broadcast(Models.train(training_sample(docs)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            lang, _ = held.value.predict(batch.column("text").to_pylist())
            at = batch.schema.get_field_index("lang")
            given = pc.coalesce(batch.column(at), pa.array(lang, batch.column(at).type))
            kept = batch.set_column(at, batch.schema.field(at), given)
            yield kept.filter(pa.array([x != "und" for x in lang]))

    return docs.mapInArrow(run, docs.schema)


def identify(docs: DataFrame, sample: dict[str, list[str]] | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs`` (doc_id, text, lang; others are ignored).

    ``und`` with score 0 for a null text, a text without a letter, or when no
    language was learned. The score is 1 - (least price / next price): 0 for a
    tie (the language first by code point wins), 1 if only one language is
    known. Whole texts are parsed; equal rows stay as many rows.
    """
    models = Models.train(training_sample(docs) if sample is None else sample)
    held = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            lang, score = held.value.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(lang), pa.array(score)],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)
