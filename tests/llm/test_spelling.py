"""Spelling variants: against all pairs, the bounds of the gram index, odd tables."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from ridepulse.llm import catalog, spelling
from tests.conftest import SF_SMALL


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts):
    """All pairs of words that share a deletion, by comparing outright."""
    buckets = {}
    for w in counts:
        for x in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            buckets.setdefault(x, set()).add(w)
    partners = {w: set() for w in counts}
    for group in buckets.values():
        for a in group:
            partners[a] |= {b for b in group if near(a, b)}
    form = {}
    for w, others in partners.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 10 * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, counts[w], len(partners[w]), form[w], counts.get(form[w]), root(w)) for w in counts}


def result(df):
    rows = [(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def as_words(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


def test_random_words(spark, monkeypatch):
    for frequent, letters, seed in [(64, "ab", 1), (2, "abé", 2), (8, "abc", 3), (3, "aÿ×b", 4)]:
        monkeypatch.setattr(spelling, "FREQUENT", frequent)
        rnd = random.Random(seed)
        counts = {}
        for _ in range(400):
            w = "".join(rnd.choices(letters, k=rnd.randrange(7, 11)))
            counts[w] = rnd.choice([2, 3, 20, 35, 400, 5000, 10**12])
        assert result(spelling.variants(as_words(spark, counts))) == brute(counts)


def test_selected_grams_meet():
    """Near words have one of their selected grams in common, at the same distance from the start or the end."""
    rnd = random.Random(5)
    for _ in range(3000):
        frequent = {}
        base = "".join(rnd.choices("abc", k=rnd.randrange(7, 14)))
        for q in range(2, 6):
            for _ in range(rnd.randrange(0, 12)):
                a = rnd.randrange(0, len(base) - q + 1)
                frequent[base[a : a + q]] = rnd.randrange(65, 999)
        i = rnd.randrange(len(base) + 1)
        other = rnd.choice([base[:i] + rnd.choice("abc") + base[i:], base[:i] + rnd.choice("abc") + base[i + 1 :], base[:i] + base[i + 1 :]])
        if len(other) < 7 or other == base:
            continue
        a, b = sorted((base, other), key=len)
        d = len(b) - len(a)
        longer = set(spelling.selected(b, frequent))
        assert any((g, s) in longer or (g, s + d) in longer for g, s in spelling.selected(a, frequent)), (base, other)


def test_query_equals_all_pairs(spark):
    counts = Counter()
    for d in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", d.text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{d.doc_id}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    counts = {w: n for w, n in counts.items() if n >= 2 and len(w) >= 7}
    got = result(catalog.op11_spelling_variants(spark, SF_SMALL))
    assert got == brute(counts) and any(r[3] for r in got)


def test_chains_of_forms(spark):
    counts = {"a" * 7 + "b" * k: 2 * 10**k for k in range(18)}
    got = {r[0]: r[5] for r in result(spelling.variants(as_words(spark, counts)))}
    assert set(got.values()) == {"a" * 7 + "b" * 17}


def test_odd_rows(spark, make_docs, monkeypatch):
    assert spelling.variants(spelling.count_words(make_docs([]))).collect() == []
    rows = [(1, None), (2, ""), (None, "zzzzzzz"), (3, "zzzzzzz ÀÀÀÀÀÀÀ"), (3, "ZZZZZZZ ÀÀÀÀÀÀÀ àààààààÀ short"), (4, "y" * 50_000), (5, "y" * 50_000)]
    got = result(spelling.variants(spelling.count_words(make_docs(rows))))
    assert got == {(w, n, 0, None, None, w) for w, n in (("zzzzzzz", 3), ("À" * 7, 2), ("y" * 50_000, 2))}
    # counts handed on early make no difference
    monkeypatch.setattr(spelling, "_HELD", 1)
    assert result(spelling.variants(spelling.count_words(make_docs(rows)))) == got


@pytest.mark.parametrize("bound", [0, 3])
def test_dictionary_bound_changes_no_result(spark, monkeypatch, bound):
    monkeypatch.setattr(spelling, "FREQUENT", 1)
    monkeypatch.setattr(spelling, "MAX_FREQUENT", bound)
    rnd = random.Random(bound)
    counts = {"".join(rnd.choices("abc", k=8)): rnd.choice([2, 30]) for _ in range(200)}
    assert result(spelling.variants(as_words(spark, counts))) == brute(counts)
