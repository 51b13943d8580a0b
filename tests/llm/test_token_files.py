from __future__ import annotations

import json
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ridepulse.llm import catalog, token_files
from ridepulse.llm.common import BATCH_BYTES, ready
from tests.conftest import SF_SMALL

PATH = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(PATH)


def library(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


def expected(rows):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: ((-1 if r[0] is None else r[0]), r[1] is not None, (r[1] or "").encode())):
        ids = library(text) + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in df.collect()), key=str)


def test_query_equals_the_library(spark):
    t = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pydict()
    assert got(catalog.op4_token_files(spark, SF_SMALL)) == expected(list(zip(t["doc_id"], t["text"])))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"ab'sé ß\n\t\r\x0b\x1c\x85  1.!", "<|endoftext|>", "  ", "'ll", " the", "日本", "👍🏽"]), max_size=40))
def test_encoder_equals_the_library(parts):
    text = "".join(parts)
    assert np.frombuffer(token_files._encoder(PATH).encode(text), "<u4").tolist() == library(text)


def test_generations_and_other_tokenizers(tmp_dir, monkeypatch):
    """A small cache loses nothing; a file with another split or model is encoded by the library."""
    monkeypatch.setattr(token_files, "_CACHE_PIECES", 3)
    coder = token_files.Encoder(PATH)
    for text in ["a b c d a b e f a", "it's a b, a c. a", "a b c d a b e f a"]:
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == library(text) and coder.by_piece
    for change in ({"add_prefix_space": True}, {"use_regex": False}):
        parts = json.loads(WHOLE.to_str())
        parts["pre_tokenizer"] |= change
        with open(f"{tmp_dir}/t.json", "w") as f:
            json.dump(parts, f)
        other, coder = Tokenizer.from_file(f"{tmp_dir}/t.json"), token_files.Encoder(f"{tmp_dir}/t.json")
        assert not coder.by_piece
        assert np.frombuffer(coder.encode("some words, here"), "<u4").tolist() == other.encode("some words, here").ids


def test_odd_rows(spark, make_docs):
    rows = [
        (5, "some words\nhere"), (5, "some words\nhere"), (5, "another"), (None, "no id"), (1, None), (2, ""),
        (3, "  blanks  \n\n"), (4, "word " * 30_000), (6, "<|endoftext|> x"), (7, "퟿ é 漢字"),
    ]
    assert got(catalog.op4_token_files(spark, "", make_docs(rows))) == expected(rows)
    assert catalog.op4_token_files(spark, "", make_docs([])).collect() == []


def test_a_document_is_found_in_the_files(spark, make_docs, tmp_dir):
    docs = make_docs([(i, f"text number {i}") for i in range(200)])
    token_files.write_token_files(docs, f"{tmp_dir}/f", PATH, 2)
    found = token_files.find_documents(spark, f"{tmp_dir}/f", [17, 400])
    assert [(r.doc_id, r.ids) for r in found.collect()] == [(17, library("text number 17") + [2])]
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().toString()


def test_a_piece_is_kept_when_it_comes_again():
    """Pieces met once take no room in the cache; hot ones stay. All are encoded as the library does."""
    coder = token_files.Encoder(PATH)
    for text in ["once upon", "a time, once", "a nap", "it's 9½ don't 'ta\x1c é\x7f"]:
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == library(text)
    assert " upon" not in coder and " nap" not in coder and "a" in coder
    for _ in range(3):
        assert np.frombuffer(coder.encode("a" * 100_000), "<u4").tolist() == library("a" * 100_000)
    assert max(map(len, coder)) < 100


def test_batches_of_long_rows_are_cut(spark, tmp_dir, monkeypatch):
    """10,000 long rows are not held at once on the way to the workers; the session's own limit comes back."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)

    def noting(name, real):
        def note(batches):
            for batch in batches:
                with open(f"{tmp_dir}/{name}", "a") as f:
                    f.write(f"{batch.nbytes}\n")
                yield from real([batch])

        return note

    monkeypatch.setattr(token_files, "slices", noting("texts", token_files.slices))
    monkeypatch.setattr(token_files, "_digest", noting("ids", token_files._digest))
    docs = ready(spark).range(0, 300, 1, 1).select(F.col("id").alias("doc_id"), F.expr("repeat('some words ', 8000)").alias("text"))
    token_files.write_token_files(docs, f"{tmp_dir}/f", PATH, 2)
    assert {r.n_tokens for r in token_files.token_digest(spark, f"{tmp_dir}/f").collect()} == {len(library("some words " * 8000)) + 1}
    for name in ("texts", "ids"):
        with open(f"{tmp_dir}/{name}") as f:
            seen = [int(x) for x in f]
        assert len(seen) > 1 and max(seen) < BATCH_BYTES + 200_000
    assert spark.conf.get(key, None) == before


def test_reading_gives_the_cache_back():
    """A worker that reads the files holds no encoder any more."""
    token_files._encoder(PATH).encode("some words")
    assert list(token_files._digest(iter([]))) == [] and token_files._ENCODERS == {}
