"""Token-ID output as ORC files.

A document's token ids are one row of an ORC file: ``ids`` is an integer list
(ORC run-length encodes it), and row indexes and a Bloom filter on ``doc_id``
let a reader skip stripes and row groups from metadata alone. Files follow
each other in ascending ``doc_id`` order, so ``part`` (the file's number) and
``pos`` (the row's place in it) give every document its place; stripes are
read in parallel, and a document's start in the whole id stream is a prefix
sum over files plus a running sum inside one file.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ridepulse.llm.common import slices, small_batches, stored

# Fixed value: how byte-level BPE vocabularies of this family split a text before merging.
# Letters and numbers come first, being most frequent: no contraction begins with them or with a blank.
_SPLIT = r" ?[{L}]+| ?[{N}]+|'(?:s|t|re|ve|m|ll|d)| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
# Encoded pieces kept by one Python worker, in each of two generations; longer ones are not kept.
_CACHE_PIECES = 500_000
_CACHE_CHARS = 64
# Marks, by hash, of pieces met once; a power of two.
_MARKS = 1 << 22


def _latin_classes() -> dict[str, str]:
    """Letters, numbers and white space below U+0100 as members of a character class."""
    chars = [chr(i) for i in range(256)]
    kinds = {k: [c for c in chars if unicodedata.category(c)[0] == k] for k in "LN"}
    kinds["S"] = [c for c in chars if c.isspace() and not "\x1c" <= c <= "\x1f"]  # Unicode's White_Space
    return {k: "".join(map(re.escape, v)) for k, v in kinds.items()}


# The same split twice: the standard library's engine is the faster one on Latin-1 texts.
_SPLIT_ANY = regex.compile(_SPLIT.format(L=r"\p{L}", N=r"\p{N}", S=r"\s"))
_SPLIT_LATIN = re.compile(_SPLIT.format(**_latin_classes()))

FILE_SCHEMA = "part int, pos long, doc_id long, ids array<int>"
DIGEST_SCHEMA = "part int, pos long, doc_id long, n_tokens long, ids_crc32 long"


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else 256 and up."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(other)}


class Encoder(dict):
    """Ids of whole texts, equal to ``Tokenizer.encode(text, add_special_tokens=False).ids``.

    Merging never crosses the pieces that the pre-tokenizer cuts, so a worker
    merges a piece once and looks it up after that (this dict: piece ->
    little-endian unsigned 32-bit ids). It is kept when it comes a second time,
    as most pieces never do, unless it is very long. A full dict becomes the older
    generation, from which pieces come back when asked for again. A text that
    holds an added token's string, and any text under another kind of
    pre-tokenizer or model, is encoded in one call.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.letters = _byte_letters()
        self.older: dict[str, bytes] = {}
        self.met = bytearray(_MARKS)
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        parts = json.loads(self.whole.to_str())
        cut = parts.get("pre_tokenizer") or {}
        self.by_piece = (
            all(parts.get(k) is None for k in ("normalizer", "truncation", "padding"))
            and (cut.get("type"), cut.get("add_prefix_space"), cut.get("use_regex")) == ("ByteLevel", False, True)
            and (parts["model"].get("type"), parts["model"].get("dropout")) == ("BPE", None)
        )

    def __missing__(self, piece: str) -> bytes:
        out = self.older.get(piece)
        if out is None:
            if piece.isascii() and piece.isprintable():
                letters = piece.replace(" ", self.letters[32])
            else:
                letters = piece.encode().decode("latin-1").translate(self.letters)
            out = array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()
            if len(piece) > _CACHE_CHARS:
                return out
            mark = hash(piece) % _MARKS
            if not self.met[mark]:
                self.met[mark] = 1
                return out
        if len(self) >= _CACHE_PIECES:
            self.older = dict(self)
            self.clear()
            self.met = bytearray(_MARKS)
        self[piece] = out
        return out

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of ``text``."""
        if not self.by_piece or any(a in text for a in self.added):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        try:
            text.encode("latin-1")
            pieces = _SPLIT_LATIN.findall(text)
        except UnicodeEncodeError:
            pieces = _SPLIT_ANY.findall(text)
        return b"".join(map(self.__getitem__, pieces))


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encode ``docs`` (doc_id, text; other columns are ignored) into ORC files under ``path``.

    Ascending doc_id order over files and rows; null ids first, rows of one id
    by text. A null text is the empty text. An empty table gives no rows.
    Texts are dealt by ranges of (doc_id, hash of text), so an id with very
    many rows is split over files.
    """
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, pos = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            known = {t: coder.encode(t) + end for t in set(texts)}
            blobs = [known[t] for t in texts]
            ends = np.cumsum([len(b) // 4 for b in blobs])
            ids = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], ends]).astype(np.int32)),
                pa.array(np.frombuffer(b"".join(blobs), "<i4")),
            )
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(pos, pos + n)), batch.column("doc_id"), ids],
                ["part", "pos", "doc_id", "ids"],
            )
            pos += n

    with small_batches(docs.sparkSession):
        (
            docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .repartitionByRange(F.col("doc_id"), F.xxhash64("text"))
            .sortWithinPartitions("doc_id", "text")
            .mapInArrow(encode, FILE_SCHEMA)
            .write.option("orc.bloom.filter.columns", "doc_id")
            .option("orc.bloom.filter.fpp", "0.01")
            .option("orc.create.index", "true")
            .option("orc.row.index.stride", "1000")
            .option("orc.stripe.size", str(32 << 20))
            .orc(path)
        )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The rows of files written by ``write_token_files``."""
    return spark.read.schema(FILE_SCHEMA).orc(path)


def find_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Rows of a few documents; the id filter is pushed to the ORC reader (statistics and Bloom filters)."""
    return read_token_files(spark, path).where(F.col("doc_id").isin(doc_ids))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    _ENCODERS.clear()  # the files are written: what this worker kept for encoding is memory for the next steps
    for batch in batches:
        ids = batch.column("ids")
        offsets = ids.offsets.to_numpy()
        raw = np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<i4").view(np.uint8)
        crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in ("part", "pos", "doc_id")),
                pa.array(np.diff(offsets).astype(np.int64)),
                pa.array(crc, pa.int64()),
            ],
            ["part", "pos", "doc_id", "n_tokens", "ids_crc32"],
        )


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every row, all taken from the files.

    The window over files has one row per file; the running sums stay inside
    one file each.
    """
    with small_batches(spark):
        rows = stored(read_token_files(spark, path).mapInArrow(_digest, DIGEST_SCHEMA), "token-digest")
    files = rows.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    before = files.select(
        "part",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_before"),
    )
    inside = Window.partitionBy("part").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumn("_upto", F.sum("n_tokens").over(inside))
        .join(before, "part")
        .select("doc_id", (F.col("_before") + F.col("_upto") - F.col("n_tokens")).alias("start"), "n_tokens", "ids_crc32")
    )
