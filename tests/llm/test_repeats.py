from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from ridepulse.llm import catalog, rlz_dedup, suffix_dedup
from ridepulse.llm.suffixes import common_prefixes, suffix_array
from tests.conftest import SF_SMALL


def sha(b):
    return hashlib.sha256(b).hexdigest()


def brute_bytes(rows, width=50):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        if d is not None:
            for i in range(len(b) - width + 1):
                w = b[i : i + width]
                first[w] = min(first.get(w, d), d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - width + 1):
            if d is not None and first[b[i : i + width]] < d:
                gone[i : i + width] = [True] * width
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return sorted(out, key=str)


def brute_words(rows, width=35):
    texts = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for _, t in rows]
    count = Counter(tuple(w[i : i + width]) for w in texts for i in range(len(w) - width + 1))
    out = []
    for (d, _), w in zip(rows, texts):
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if count[tuple(w[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        out.append((d, len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g))))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def documents(sf):
    t = pq.read_table(f"{sf}/documents.parquet").to_pydict()
    return list(zip(t["doc_id"], t["text"]))


def test_suffix_query_equals_brute_force(spark):
    assert got(catalog.op5_suffix_dedup(spark, SF_SMALL)) == brute_bytes(documents(SF_SMALL))


def test_rlz_query_equals_brute_force(spark):
    assert got(catalog.op8_rlz_dedup(spark, SF_SMALL)) == brute_words(documents(SF_SMALL))


def hard_rows(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["é", "the", "of"]
    passage = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(6)]
    line = "the of " * 40
    rows = [(1, None), (2, ""), (None, passage[0]), (3, "short"), (4, "x" * 400), (5, "x" * 77), (6, line), (7, line + line)]
    for d in range(10, 60):
        parts = []
        for _ in range(rng.randint(1, 4)):
            kind = rng.random()
            p = rng.choice(passage)
            if kind < 0.5:
                a = rng.randrange(len(p))
                p = p[a : a + rng.randint(1, len(p))]
            elif kind < 0.7:
                p = " ".join(rng.choice(words) for _ in range(rng.randint(1, 80)))
            parts.append(p)
        rows.append((rng.choice([d, d, d, 10]), rng.choice([" ", "\n", ""]).join(parts)))
    rows += [rows[20], rows[20], rows[30]]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, held", [(1, 1_000_000), (2, 40)])
def test_hard_rows(make_docs, held, seed):
    rows = hard_rows(seed)
    docs = make_docs(rows).repartition(5)
    assert got(suffix_dedup.remove_repeats(docs, held_runs=held)) == brute_bytes(rows)
    assert got(rlz_dedup.remove_repeats(docs, held_runs=held)) == brute_words(rows)


def test_empty_table(make_docs):
    assert suffix_dedup.remove_repeats(make_docs([])).collect() == []
    assert rlz_dedup.remove_repeats(make_docs([])).collect() == []


def test_suffix_arrays_equal_sorted_suffixes():
    rng = random.Random(1)
    for _ in range(300):
        s = np.array([rng.randint(0, rng.choice([1, 2, 5, 2000])) for _ in range(rng.randint(1, 60))])
        order = suffix_array(s)
        assert order.tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
        prefix = common_prefixes(s, order)
        for a, b in zip(order, order[1:]):
            n = 0
            while max(a, b) + n < len(s) and s[a + n] == s[b + n]:
                n += 1
            assert prefix[b] == n


def test_matchers_equal_brute_force():
    rng = random.Random(4)
    for _ in range(60):
        texts = [[rng.randint(0, 2) for _ in range(rng.randint(5, 25))] for _ in range(rng.randint(1, 12))]
        doc = np.array([rng.randint(0, 4) for _ in texts])
        data, length, w = np.array(sum(texts, [])), np.array([len(t) for t in texts]), 5
        places = defaultdict(list)
        for k, t in enumerate(texts):
            for i in range(len(t) - w + 1):
                places[tuple(t[i : i + w])].append((k, i))
        smaller, twice = [], []
        for k, t in enumerate(texts):
            for i in range(len(t)):
                at = places.get(tuple(t[i : i + w]), []) if i + w <= len(t) else []
                smaller.append(any(doc[j] < doc[k] for j, _ in at))
                twice.append(len(at) > 1)
        assert suffix_dedup.matcher(w)(data.astype(np.uint8), length, doc).tolist() == smaller
        assert rlz_dedup.matcher(w)(data.astype(np.uint64), length, doc).tolist() == twice
