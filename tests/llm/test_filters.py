"""URL filter, licence scan, language ID, decontamination."""

from __future__ import annotations

import math
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from ridepulse.llm import catalog, decontaminate, language, licenses, url_filter
from ridepulse.llm.words import BLANK, PUNCTUATION, Words
from tests.conftest import SF_SMALL


def brute_url(url, listed):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = max(
        ((len(h + p), h + p, v) for h, p, v in catalog.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)),
        default=None,
    )
    if best:
        return host, path, best[1], best[2]
    own = re.sub(r"^www\.", "", host) + re.sub("/+$", "", path)
    return host, path, None, "block" if host and own in listed else "allow"


def test_urls(spark, make_docs):
    odd = [None, "", "no scheme", "http://", "http://Example.ORG/es/1?x#y", "https://a.b.example.org/en/12", "x://org/", "http://notorg/",
           "http://a.com/fr/é?://z", "http://spam-farm.example.net/en/1/", "http://www.cheap-pills.net/x", "http://a.net#//b.org/",
           "http://h.org", "a://b://c.org/", "http://x.example.org/en/1" + "0" * 5000]
    t = pq.read_table(f"{SF_SMALL}/pages.parquet").to_pydict()
    rows = list(zip(t["page_id"], t["url"])) + [(None, u) for u in odd] + [(7, odd[4])] * 3
    pages = spark.createDataFrame([(*r, "k", "h") for r in rows], "page_id long, url string, key string, host string")
    rules = spark.createDataFrame(catalog.URL_RULES, "host string, path string, verdict string")
    got = url_filter.filter_urls(pages, rules, catalog.listed_urls(pages), [1, 4, 5]).collect()
    listed = set()
    for _, u in rows:
        host, path, *_ = brute_url(u, set())
        if set(host.split(".")) & set(catalog.LISTED_LABELS):
            listed.add(re.sub(r"^www\.", "", host) + re.sub("/+$", "", path))
    want = [(p, *brute_url(u, listed)) for p, u in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert {r.verdict for r in got if r.rule is None} == {"allow", "block"}
    assert url_filter.filter_urls(pages.limit(0), rules, pages.select("url").limit(0), [1]).collect() == []
    assert len(catalog.op2_url_filter(spark, SF_SMALL).collect()) == len(t["url"])


def test_licenses(spark, make_docs):
    rows = [
        (1, "Some prose here. Released under the MIT License."), (2, None), (3, ""), (4, "x\nLicensed under the Apache License, Version 2.0.\nend"),
        (5, "Licensed under the Apache License,\nVersion 2.0. You may not use this file except in\ncompliance with the License."),
        (6, "THIS WORK IS LICENSED UNDER THE GNU GENERAL PUBLIC LICENSE, VERSION 3.\n\nAll rights reserved"), (6, "driving license needed. " * 3000),
        (None, "Licensed under CC BY-NC 4.0. Licensed under CC BY-NC 4.0."),
    ]
    got = {(r.doc_id, r.licenses, r.unmatched) for r in licenses.scan(make_docs(rows)).collect()}
    assert got == {
        (1, "MIT", ""), (2, "", ""), (3, "", ""), (4, "Apache-2.0", ""), (5, "Apache-2.0", ""),
        (6, "GPL-3.0-only", "AllRights"), (6, "", ""), (None, "CC-BY-NC-4.0", ""),
    }
    assert licenses.scan(make_docs([])).collect() == []
    assert all(re.search(licenses.TRIGGER[4:], s) for s in licenses.SENTENCES)
    t = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pydict()
    planted = {"under the MIT License": "MIT", "Apache License, Version 2.0": "Apache-2.0", "Public License, version 3": "GPL-3.0-only", "CC BY-NC 4.0": "CC-BY-NC-4.0"}
    want = {d: {n for s, n in planted.items() if s in x} for d, x in zip(t["doc_id"], t["text"])}
    got = {r.doc_id: set(filter(None, r.licenses.split(","))) for r in catalog.op3_license_scan(spark, SF_SMALL).collect()}
    assert got == want


APACHE = """Copyright 2020 The Authors

Licensed under the Apache License, Version 2.0 (the "License"); you may
not use this file except in compliance with the License. You may obtain
a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the
License for the specific language governing permissions and limitations
under the License."""
BSD2 = """Copyright (c) 2020, Acme

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""
ADVERT = """

3. All advertising materials mentioning features or use of this software must
   display the following acknowledgement: This product includes software
   developed by Acme."""
ENDORSE = """

3. Neither the name of {} nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
GNU = """This {0} is free software: you can redistribute it and/or modify it
under the terms of the GNU {1}General Public License as published by the Free
Software Foundation, either version {2} of the License, or (at your option)
any later version.

This {0} is distributed in the hope that it will be useful, but WITHOUT ANY
WARRANTY. See the GNU {1}General Public License for more details."""


def test_whole_standard_headers_in_several_wrappers(make_docs):
    headers = [
        (APACHE, "Apache-2.0"), (BSD2, "BSD-2-Clause"), (BSD2 + ENDORSE.format("the copyright holder"), "BSD-3-Clause"),
        (BSD2 + ENDORSE.format("Acme Inc."), "BSD-3-Clause"), (BSD2 + ENDORSE.format("Acme"), "BSD-3-Clause"),
        (BSD2 + ADVERT + ENDORSE.format("Acme"), "BSD-4-Clause"), (GNU.format("program", "", "2"), "GPL-2.0-or-later"),
        (GNU.format("program", "", "3"), "GPL-3.0-or-later"), (GNU.format("program", "Affero ", "3"), "AGPL-3.0-or-later"),
        (GNU.format("library", "Lesser ", "2.1"), "LGPL-2.1-or-later"), (GNU.format("library", "Lesser ", "3"), "LGPL-3.0-or-later"),
        (GNU.format("library", "Library ", "2"), "LGPL-2.0-or-later"),
        (GNU.format("program", "", "2").replace(", or (at your option)\nany later version", ""), "GPL-2.0-only"),
        ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0.", "MPL-2.0"),
    ]
    wrappers = [
        lambda t: t,
        lambda t: "\n".join(f"# {x}" for x in t.split("\n")),
        lambda t: "/*\n" + "\n".join(f" * {x}" for x in t.split("\n")) + "\n */\nint x;",
        lambda t: "\n\n".join(" ".join(x.split()) for x in t.split("\n\n")),
        lambda t: " ".join(t.split()),
        lambda t: re.sub(r"\n\d\. {1,2}", "\n* ", t).replace("\n\n* ", "\n* "),
    ]
    rows = [(k, wrap(text)) for k, (text, wrap) in enumerate((t, w) for t, _ in headers for w in wrappers)]
    got = {r.doc_id: r.licenses for r in licenses.scan(make_docs(rows)).collect()}
    assert got == {k: headers[k // len(wrappers)][1] for k in got} and len(got) == len(rows)


def greedy(text: list[int], sample: list[int]) -> int:
    joined, phrases, i = bytes(sample), 0, 0
    while i < len(text):
        n = 1
        while i + n < len(text) and bytes(text[i : i + n + 1]) in joined:
            n += 1
        phrases, i = phrases + 1, i + n
    return phrases


def test_language_parse_equals_greedy_longest_matches():
    sample = {"en": ["the cat and the hat sat on the mat " * 3], "fr": ["le chat et la souris sont à la maison é " * 3]}
    models = language.Models.train(sample)
    texts = ["the mat sat", "la maison et le chat", "xyz the!", "à é", None, "12 ...", "the cat " * 200]
    lang, score = models.predict(texts)
    for t, got, s in zip(texts, lang, score):
        if not t or not any(c.isalpha() for c in t):
            assert (got, s) == ("und", 0.0)
            continue
        price = []
        for m in models.models:
            own = language._symbols(models.classes, np.frombuffer("".join(sample[m.lang]).lower().encode(), np.uint8)).tolist()
            symbols = language._symbols(models.classes, np.frombuffer(t.lower().encode(), np.uint8)).tolist()
            price.append((greedy(symbols, own) * math.log2(len(own) + 1), m.lang))
        price.sort()
        assert got == price[0][1] and abs(s - (1 - price[0][0] / price[1][0])) < 1e-9


def test_whole_texts_are_parsed_without_a_cut(spark, make_docs):
    sample = {"en": ["the cat and the hat sat on the mat " * 20], "fr": ["le chat et la souris sont à la maison é " * 20]}
    models = language.Models.train(sample)
    texts = ["the mat sat", "the cat and the hat sat on the mat " * 30, "la maison et le chat à " * 40, "xyz the! " * 99, "à é"]
    got = language.identify(make_docs([(i, x) for i, x in enumerate(texts)]), sample).collect()
    assert len(got) == len(texts)
    for r in got:
        price = []
        for m in models.models:
            own, symbols = (
                language._symbols(models.classes, np.frombuffer(x.lower().encode(), np.uint8)).tolist() for x in ("".join(sample[m.lang]), texts[r.doc_id])
            )
            price.append((greedy(symbols, own) * math.log2(len(own) + 1), m.lang))
        price.sort()
        assert r.lang_pred == price[0][1] and abs(r.score - (1 - price[0][0] / price[1][0])) < 1e-9


def test_a_label_with_a_few_characters_takes_no_texts():
    t = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pydict()
    rows = [(x, lang) for x, lang in zip(t["text"], t["lang"]) if x and lang]
    sample = {}
    for x, lang in rows[::2]:
        sample.setdefault(lang, []).append(x[:500])
    texts = [x for x, _ in rows[1::2] if len(x) > 100]
    for word in ("a", "ok", "in the", "information"):
        assert "rare" not in language.Models.train({**sample, "rare": [word]}).predict(texts)[0]


def test_language_query(spark, make_docs):
    t = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pydict()
    rows = catalog.op6_language_id(spark, SF_SMALL).collect()
    truth = dict(zip(t["doc_id"], t["lang"]))
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    odd = make_docs([(1, "abc def", "en"), (1, "abc def", "en"), (None, "abc", "xx"), (2, None, "en"), (3, "", None), (4, "123", None), (6, "word " * 30_000, "de")])
    got = sorted(((r.doc_id, r.held_out, r.lang_pred in ("en", "de"), r.lang_pred) for r in language.identify(odd).collect()), key=str)
    assert len(got) == 7 and {g[0]: g[3] for g in got if g[0] in (2, 3, 4)} == {2: "und", 3: "und", 4: "und"}
    assert all(g[3] != "xx" for g in got) and language.identify(make_docs([])).collect() == []
    unlearned = language.identify(make_docs([(1, "abc")])).collect()
    assert [(r.lang_pred, r.score) for r in unlearned] == [("und", 0.0)]
    assert {r.doc_id for r in language.keep_identified(odd).collect()} == {1, None, 6}


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_leaks(spark, make_docs):
    rng = np.random.default_rng(2)
    vocabulary = [f"w{i}" for i in range(300)]
    item = [list(rng.choice(vocabulary, n)) for n in (8, 15, 30, 59)]
    benchmark = [(i, " ".join(w)) for i, w in enumerate(item)] + [(9, None), (10, ""), (11, "...")]
    rows, want = [(900, None), (901, ""), (902, "clean " + " ".join(rng.choice(vocabulary, 4000)))], set()
    total = 0
    for d in range(120):
        i = d % 4
        w = list(item[i])
        for _ in range(int(rng.integers(0, int(0.2 * len(w)) + 1))):
            k, kind = int(rng.integers(0, len(w))), rng.integers(0, 3)
            if kind == 0:
                w[k] = "typo"
            elif kind == 1:
                del w[k]
            else:
                w.insert(k, "extra")
        if edits(w, item[i]) <= decontaminate.max_edits(len(item[i]), 0.8):
            want.add((d, i))
        around = [list(rng.choice(vocabulary, int(rng.integers(0, 40)))) for _ in range(2)]
        rows.append((d, ", ".join(around[0] + w + around[1]).upper()))
    bench = spark.createDataFrame(benchmark, "item_id long, text string")
    docs = make_docs(rows)
    found = decontaminate.leaks(docs, bench)
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    total = len(got & want)
    assert total >= 0.9 * len(want) and not got & {(900, 0), (901, 0), (902, 0)}
    words = {d: re.findall(r"[a-z0-9]+", (t or "").lower()) for d, t in rows}
    for r in found.collect():
        part, limit = words[r.doc_id], decontaminate.max_edits(len(item[r.item_id]), 0.8)
        near = [edits(item[r.item_id], part[a : a + n]) for a in range(len(part)) for n in range(len(item[r.item_id]) - limit, len(item[r.item_id]) + limit + 1)] if len(part) < 60 else [0]
        assert r.distance <= limit and min(near) <= r.distance
    blocks = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench, block_bytes=60).collect()}
    assert blocks == got
    left = {r.doc_id for r in decontaminate.without_leaks(docs, bench).collect()}
    assert left == {d for d, _ in rows} - {d for d, _ in got}
    assert decontaminate.leaks(make_docs([]), bench).collect() == []
    assert decontaminate.leaks(docs, bench.limit(0)).collect() == []


def test_every_leak_at_the_edit_limit_is_found(spark, make_docs):
    rng = np.random.default_rng(8)
    vocabulary = [f"w{i}" for i in range(20_000)]
    item = [list(rng.choice(vocabulary, n)) for n in (15, 57, 200)]
    rows, limits = [], {}
    for i, words in enumerate(item):
        limit = decontaminate.max_edits(len(words), 0.8)
        for kind in ("delete", "insert", "replace", "mixed"):
            for _ in range(10):
                w = list(words)
                for k in sorted(rng.choice(len(words), limit, replace=False).tolist(), reverse=True):
                    how = ("delete", "insert", "replace")[int(rng.integers(0, 3))] if kind == "mixed" else kind
                    w[k : k + (how != "insert")] = [] if how == "delete" else ["extra"]
                around = [list(rng.choice(vocabulary, 50)) for _ in range(2)]
                limits[len(rows), i] = limit
                rows.append((len(rows), " ".join(around[0] + w + around[1])))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(item)], "item_id long, text string")
    found = decontaminate.leaks(make_docs(rows), bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == set(limits)
    for r in found:
        stretch = rows[r.doc_id][1].split()[r.start : r.start + r.n_words]
        assert edits(item[r.item_id], stretch) == r.distance <= limits[r.doc_id, r.item_id]
    assert decontaminate.without_leaks(make_docs(rows), bench).collect() == []


def hashed(text):
    return Words([text.encode()], PUNCTUATION, lower=True).hash


@pytest.mark.parametrize("n", [10, 15, 57, 200])
@pytest.mark.parametrize("kind", ["delete", "insert", "replace", "mixed"])
def test_lsh_alone_finds_leaks_at_the_edit_limit(n, kind):
    rng = np.random.default_rng([n, len(kind)])
    vocabulary = [f"w{i}" for i in range(20_000)]
    item = list(rng.choice(vocabulary, n))
    texts = []
    for _ in range(50):
        w = list(item)
        for k in sorted(rng.choice(n, decontaminate.max_edits(n, 0.8), replace=False).tolist(), reverse=True):
            how = ("delete", "insert", "replace")[int(rng.integers(0, 3))] if kind == "mixed" else kind
            w[k : k + (how != "insert")] = [] if how == "delete" else ["extra"]
        around = [list(rng.choice(vocabulary, 50)) for _ in range(2)]
        texts.append(" ".join(around[0] + w + around[1]).encode())
    items = decontaminate.Items([1], [hashed(" ".join(item))], 0.8, 2)
    w = Words(texts, PUNCTUATION, lower=True)
    found = items.leaks(w, exact=False)
    assert len(found) >= 45 and all(v[3] == "lsh" for v in found.values())
    assert len(items.leaks(w)) == 50


def test_without_lsh_the_exact_way_finds_the_same(monkeypatch):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(200)]
    item = [list(rng.choice(vocabulary, n)) for n in (6, 20, 40)]
    texts = [" ".join(list(rng.choice(vocabulary, 9)) + x[:4] + ["more"] + x[4:]).encode() for x in item] * 2
    items = decontaminate.Items([0, 1, 2], [hashed(" ".join(x)) for x in item], 0.8, 2)
    w = Words(texts, PUNCTUATION, lower=True)
    want = items.leaks(w)
    assert {(d, d % 3) for d in range(6)} <= set(want) and items.leaks(w, exact=False)
    monkeypatch.setattr(decontaminate.Items, "collide", lambda self, w, doc, item, start, region: np.zeros(int(region[-1]) + 1, bool))
    got = items.leaks(w)
    assert items.leaks(w, exact=False) == {} and {k: v[:3] for k, v in got.items()} == {k: v[:3] for k, v in want.items()}
    assert {v[3] for v in got.values()} == {"exact"}


def test_leaks_of_repetitive_texts_in_bounded_memory():
    items = decontaminate.Items([1, 2], [hashed("a b c " * 100), hashed("x y " * 20)], 0.8, 2)
    tracemalloc.start()
    found = items.leaks(Words([b"a b c " * 80_000, b"x y " * 60, b"a b c " * 50], PUNCTUATION, lower=True))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {k: v[:3] for k, v in found.items()} == {(0, 0): (0, 0, 300), (1, 1): (0, 0, 40)}
    assert peak < 300 << 20


def test_leaks_in_parts_equal_leaks_at_once(monkeypatch):
    """Items that share many q-grams with a slice are searched in parts, pairs and embeddings in chunks."""
    rng = np.random.default_rng(6)
    vocabulary = ["a", "b", "c"] + [f"w{i}" for i in range(20)]
    item = [" ".join(rng.choice(vocabulary, n)) for n in (3, 5, 8, 12, 20, 35)] + ["a b " * 9]
    texts = [" ".join(rng.choice(vocabulary, int(rng.integers(0, 60)))) + " " + item[i % 7] + " " + " ".join(rng.choice(vocabulary, 9)) for i in range(40)]
    w = Words([t.encode() for t in texts] + [b"", b"a b " * 200], PUNCTUATION, lower=True)
    items = decontaminate.Items(list(range(7)), [hashed(x) for x in item], 0.8, 2)
    want = items.leaks(w)
    assert {(i, i % 7) for i in range(40)} <= set(want)
    monkeypatch.setattr(decontaminate, "_MOST_HITS", 50)
    monkeypatch.setattr(decontaminate, "_MOST_CELLS", 500)
    assert len(list(items.parts(w))) > 1 and items.leaks(w) == want


def test_all_exact_passages_are_found(spark):
    t = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pydict()
    b = pq.read_table(f"{SF_SMALL}/benchmark.parquet").to_pydict()
    plain = lambda x: " " + " ".join(re.findall(r"[^\x00-/:-@\[-`{-\x7f]+", x.lower())) + " "
    want = {(d, i) for d, x in zip(t["doc_id"], t["text"]) for i, y in zip(b["item_id"], b["text"]) if plain(y) in plain(x)}
    got = {(r.doc_id, r.item_id) for r in catalog.op10_decontaminate(spark, SF_SMALL).collect()}
    assert want and want <= got


def test_words_equal_split():
    texts = [b"a b\tc", b"", b"  x  ", "é\u00a0y z".encode()]
    w = Words(texts, BLANK)
    assert w.count.tolist() == [len(t.split()) for t in texts]
    assert len(set(w.hash.tolist())) == 6 and len(Words([b"A-a"], PUNCTUATION, lower=True).hash) == 2


def test_numbers_are_no_letters(spark, make_docs):
    """Number signs count as no letters, letters of any alphabet do."""
    rows = [(1, "the words of one language", "en"), (2, "die Wörter der anderen Sprache", "de"), (3, "the words", "en"), (4, "der Wörter", "de")]
    rows += [(10, "² ½ 12"), (11, "Ⅷ ①"), (12, "_ 3"), (13, "x²"), (14, "字")]
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(make_docs(rows)).collect()}
    assert {got[i] for i in (10, 11, 12)} == {("und", 0.0)} and "und" not in {got[13][0], got[14][0]}


def test_language_sample_takes_whole_texts(spark, make_docs):
    """Rows are bounded, texts are not cut; a language with long texts only learns from its shortest one."""
    learned = [i for i in range(1, 400) if zlib.crc32(str(i).encode()) % 5]
    rows = [(i, f"text {i} " * 40, "en") for i in learned[:100]]
    rows += [(i, "lang " * (300 + i), "de") for i in learned[100:110]] + [(learned[110], "court " * 100, "fr"), (learned[111], "long " * 999, "fr")]
    rows += [(i, "held out", "es") for i in range(1, 400) if zlib.crc32(str(i).encode()) % 5 == 0] + [(None, "no id", "it"), (learned[112], None, "nl")]
    got = language.training_sample(make_docs(rows))
    assert set(got) == {"en", "de", "fr"} and len(got["en"]) == language.DOCS_PER_LANG
    assert set(got["en"]) <= {t for _, t, lang in rows if lang == "en"}
    assert got["de"] == ["lang " * (300 + learned[100])] and got["fr"] == ["court " * 100]


def test_many_languages_share_the_rows_of_the_sample(spark, make_docs, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_DOCS", 12)
    learned = [i for i in range(1, 400) if zlib.crc32(str(i).encode()) % 5]
    got = language.training_sample(make_docs([(i, f"text {i}", f"l{n % 5}") for n, i in enumerate(learned[:100])]))
    assert [len(t) for t in got.values()] == [2] * 5
