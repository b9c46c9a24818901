"""The training-data operators against brute force, and their defined cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from cohortkit.llm import bpe, common, html, jaccard, lengths, licenses, mixing, quality, queries, substring, syncmer, topk

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, score double, node long"


def docs(spark, rows):
    """Documents with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "en", s, None, "x", 2.0, 7) for i, t, s in rows], DOCS).repartition(3)


def odd(r, n=40):
    words = ["a", "the", "é", "of\tthe", "x" * 50, "b", "c", "d", "###", "12", "\U0001f600"]
    rows = [(i, " ".join(r.choice(words) for _ in range(r.randint(0, 60))), f"s{i % 3}") for i in range(n)]
    rows += [(100, None, None), (101, "", "s1"), (102, " \n\t ", "s1"), (None, rows[2][1], "s0"), (7, rows[9][1], "s1"),
             (7, rows[9][1], "s1"), (200, rows[3][1], "s2"), (201, rows[3][1] + " z", None), (202, "long " * 20_000, "s0")]
    return rows


def words(text):
    return (text or "").encode().split()


@pytest.fixture(scope="module")
def rows():
    return odd(random.Random(4))


@pytest.fixture(scope="module")
def table(spark, rows):
    return docs(spark, rows).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return docs(spark, [])


def test_mix(spark, table, rows, empty):
    got = mixing.mix(table).collect()
    assert sorted((r.doc_id, r.size) for r in got if r.doc_id is not None) == sorted((i, len(words(t))) for i, t, _ in rows if i is not None)
    by_source = {}
    for r in got:
        by_source.setdefault(r.source, []).append(r)
        assert 0 <= r.taken <= 2 * r.size
    total = sum(r.size for r in got)
    assert sum(v[0].target for v in by_source.values()) == pytest.approx(1.5 * total)
    for own in by_source.values():
        assert own[0].source_size == sum(r.size for r in own)
        assert abs(sum(r.taken for r in own) - own[0].target) <= 1
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(table.repartition(5)).collect()))
    mixed = mixing.mixed_documents(table)
    assert mixed.columns == table.columns
    copies = {r.doc_id: r.copies for r in got if r.doc_id not in (7, None)}
    assert {k: v for k, v in copies.items() if v} == {k: v for k, v in Counter(r.doc_id for r in mixed.collect()).items() if k not in (7, None)}
    assert mixing.mix(empty).count() == 0


def test_quality(spark, empty):
    r = random.Random(1)
    rows = [(i, " ".join(r.choice(["alpha", "beta", "gamma", "delta"]) + ("###" if i % 2 else "") for _ in range(r.randint(5, 80))), "s")
            for i in range(600)] + [(1000, None, "s"), (1001, "", "s"), (1002, "alpha beta " * 20_000, None)]
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(600)] + [(1, None, 0), (3, 1, 0), (9999, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs(spark, rows), labels)
    got = {x.doc_id: x for x in quality.score(docs(spark, rows), model).collect()}
    assert len(got) == len(rows) and all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.5) for x in got.values())
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert [i for i in sorted(got) if got[i].held_out and i < 600] == held
    assert sum(got[i].predicted == 1 - i % 2 for i in held) >= 0.95 * len(held)
    assert quality.keep_good(docs(spark, rows), model).columns == docs(spark, rows).columns
    few = quality.fit(docs(spark, rows[:4]), labels)
    assert quality.score(empty, few).count() == 0 and few.dictionaries is None


@pytest.mark.parametrize("n_good, n_bad", [(19, 2000), (2000, 19), (2, 2), (1, 30), (0, 30)])
def test_quality_few_labels(spark, n_good, n_bad):
    r = random.Random(n_good)
    text = lambda good: " ".join(r.choice(["alpha", "beta", "gamma", "delta"]) + ("" if good else "###") for _ in range(60))
    ids = [i for i in range(6 * (n_good + n_bad) + 20) if zlib.crc32(str(i).encode()) % 3 != 1][:n_good + n_bad]
    labels = spark.createDataFrame([(i, int(k < n_good)) for k, i in enumerate(ids)], "doc_id long, quality int")
    known = docs(spark, [(i, text(k < n_good), "s") for k, i in enumerate(ids)])
    model = quality.fit(known, labels)
    new = docs(spark, [(10 ** 6 + i, text(i % 2), "s") for i in range(40)] + [(10 ** 7, None, "s"), (10 ** 7, "", "s")])
    kept = sorted(x.doc_id - 10 ** 6 for x in quality.keep_good(new, model).collect() if x.doc_id < 10 ** 7)
    if min(n_good, n_bad) > 1:
        assert kept == [i for i in range(40) if i % 2]
    else:
        assert model.dictionaries is None and kept == list(range(40))


def test_quality_repeated_label(spark):
    rows = [(i, f"text {i} of it", "s") for i in range(30)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    once, often = (quality.labelled_sample(docs(spark, own), labels).collect() for own in (rows, rows + rows[:3] * 50))
    assert len(often) == len(once) and sorted(often) == sorted(once)
    assert quality.labelled_sample(docs(spark, [(0, "b", "s"), (0, "a", "s"), (0, None, "s")]), labels).first().parts == [""]


def test_top_k(spark):
    r = random.Random(2)
    rows = [(i, [r.choice([-0.5, 0.0, 0.25, 1e-3]) for _ in range(4)], "x") for i in range(120)]
    rows += [(300, None, "x"), (301, [None, 1.0, 1.0, 1.0], "x"), (302, [float("nan")] * 4, "x"), (303, [float("inf")] * 4, "x"),
             (304, [1.0], "x"), (400, [1.0], "x"), (20, rows[20][1], "x"), (None, [1.0] * 4, "x"), (500, [1e300, -1e300, 0.0, 0.0], "x")]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string"), F.col("vec_id") % 20 == 0,
                     query_block=3, shard=16).collect()
    ints = [(i, [max(-2 ** 63, min(2 ** 63 - 1, math.floor(1024 * x))) for x in e]) for i, e, _ in rows
            if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    want = []
    for n, (q, v) in enumerate(ints):  # every row but the query's own is a candidate
        if q is not None and q % 20 == 0:
            s = sorted((-max(-2 ** 63, min(2 ** 63 - 1, sum(int(float(a)) * int(float(b)) for a, b in zip(v, e)))), i is None, i or 0)
                       for m, (i, e) in enumerate(ints) if m != n and len(e) == len(v))
            want += [(q, k + 1, None if z else i, -x) for k, (x, z, i) in enumerate(s[:10])]
    assert sorted(((x.query_id, x.rank, x.vec_id, x.score) for x in got), key=str) == sorted(want, key=str)
    few = topk.top_k(spark.createDataFrame([(100, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [2.0, 0.0]), (None, [3.0, 0.0])], "vec_id long, embedding array<double>"),
                     F.col("vec_id") % 100 == 0)
    assert [(x.vec_id, x.score) for x in few.orderBy("rank").collect()] == [(None, 3 * 2 ** 20), (1, 2 ** 21), (1, 2 ** 19)]
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0).count() == 0


def test_lengths(spark, table, rows, empty):
    ranks = lengths.read_ranks(public_tokenizers.path(queries.PLAIN_50K))
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    size = [len(enc.encode_ordinary(t or "")) for _, t, _ in rows]
    hist = lengths.histogram(lengths.token_counts(table, ranks, public_tokenizers.PATTERN)).cache()
    got = {r.context_limit: r for r in hist.collect()}
    assert {k: r.n_docs for k, r in got.items()} == dict(Counter(size))
    for k, r in got.items():
        assert (r.n_longer, r.tokens_longer, r.kept_tokens) == (
            sum(s > k for s in size), sum(s for s in size if s > k), sum(min(s, k) for s in size))
        assert r.quantile == pytest.approx(sum(s <= k for s in size) / len(size)) and r.total_tokens == sum(size)
    for r in lengths.at_limits(hist, [5, 33, 10 ** 6]).collect():
        assert r.kept_tokens == sum(min(s, r.limit) for s in size) and r.n_longer == sum(s > r.limit for s in size)
    assert lengths.quantiles(hist, [0.5]).first().length == sorted(size)[math.ceil(len(size) / 2) - 1]
    assert lengths.histogram(lengths.token_counts(empty, ranks, public_tokenizers.PATTERN)).count() == 0


PAGE = """<html><head><title>t</title><style>p{}</style><script>var t="</p>";</script></head><body><header>top</header>
<nav><a href="/">home</a></nav><div class="cookie-notice">cookies</div><article><header><h1>T &amp; t</h1></header>
<p><b>one<br><p>two  &eacute;<!-- no --> <i>x</i>y<div class="share-buttons">s</div><ul><li>l1<li>l2</ul><form>f</form>
<section id="comments"><p>me too</section></article><aside>side</aside><footer>foot</footer>"""


def test_html(spark):
    text = "T & t\n\none\n\ntwo é xy\n\nl1\n\nl2"
    assert html.Page(PAGE).text() == text
    plain = "<body><div>{}</div><div>{}</div>"
    frame = "all of this frame is the same on every page of the site"
    pages = [(1, "http://a.example/1", PAGE, "x"), (2, None, None, "x"), (3, "no url", "a &lt; b", "x"), (1, "http://a.example/1", PAGE, "x"),
             (4, "http://c.example", "<p>never <em>closed", "x"), (5, "http://c.example", "<script>no end <p>x", "x")]
    r = random.Random(3)
    body = {i: " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(30)) for i in range(10, 40)}
    pages += [(i, f"https://www.b.example/{i}", f"<body><div class=x>{frame}</div><div class=y><p>{t}</p></div>", "x") for i, t in body.items()]
    got = Counter((p.page_id, p.text) for p in html.extract(spark.createDataFrame(pages, "page_id long, url string, html string, low string")).collect())
    want = Counter([(1, text), (1, text), (2, ""), (3, "a < b"), (4, "never closed"), (5, "")] + list(body.items()))
    assert got == want and plain
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("source, text", [
    ('<body class="has-sidebar"><div class="no-sidebar"><article><p>all of it</article></div>', "all of it"),
    ('<body class="has-sidebar"><p>all of it', "all of it"),
    ('<body><div id="header-and-content"><article><p>all of it</article></div>', "all of it"),
    ('<body class="menu"><div class="sidebar">menu</div><div class="overlay"><main><p>all of it</main></div>', "all of it"),
    ('<article><h2 id="related-work">related</h2><p>a<h2 id="comments">on</h2><p>b<section id="comments-on-the-method"><p>c</section></article>',
     "related\n\na\n\non\n\nb\n\nc"),
    ('<article><h2>t</h2><h3 id="social-impact">social</h3><p>text of it<div class="share-buttons">s</div></article>', "t\n\nsocial\n\ntext of it"),
    ('<main><p>all of the long text stands here</p><article class="card">teaser</article></main>', "all of the long text stands here\n\nteaser"),
    ('<div><p>all of the long text stands here</p></div><article>teaser</article>', "all of the long text stands here\n\nteaser"),
    ('<main><p>a text</p></main><div class="related"><article>one</article></div>', "a text"),
    ('<body><form action="x"><div class="notice"><p>a page that is a form</p></div><div class="cookies">c</div></form>', "a page that is a form"),
])
def test_html_names_only_mark(source, text):
    assert html.Page(source).text() == text


def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near_classes(rows):
    sets, group, links = [shingles(t) for _, t, _ in rows], list(range(len(rows))), [0] * len(rows)
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) / len(a | sets[j]) >= 0.8:
                links[i] += 1
                links[j] += 1
                x, y = group[i], group[j]
                group = [y if g == x else g for g in group]
    least = {}
    for g, (i, _, _) in zip(group, rows):
        least[g] = i if least.get(g) is None else least[g] if i is None else min(least[g], i)
    return [(i, least[g], n) for (i, _, _), g, n in zip(rows, group, links)]


def test_jaccard(spark, table, rows, empty):
    r = random.Random(5)
    pool = ["".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(400)]
    base = [r.choice(pool) for _ in range(120)]
    near = []
    for i in range(300):
        own = list(base)
        for _ in range(r.randint(0, 4)):
            own[r.randrange(120)] = r.choice(pool)
        near.append((1000 - i, " ".join(own), "s"))
    more = rows + near
    got = jaccard.classes(docs(spark, more)).collect()
    assert sorted(((x.doc_id, x.class_id, x.n_links) for x in got), key=str) == sorted(near_classes(more), key=str)
    kept = jaccard.keep_first(docs(spark, more))
    assert kept.columns == table.columns
    firsts = {c for i, c, _ in near_classes(more) if i is not None} - {None}
    assert sorted(x.doc_id for x in kept.filter("doc_id IS NOT NULL").collect()) == sorted(firsts)
    assert jaccard.classes(empty).count() == 0


def test_jaccard_keeps_every_text(spark, rows):
    long = ["alpha beta gamma delta epsilon zeta eta theta " + " ".join(f"{c}{i}" for i in range(40)) for c in "abcdef"]
    more = [(5, long[0], "s"), (5, long[1], "s"), (3, long[1], "s"), (6, long[2], "s"), (6, long[3], "s"), (6, long[3], "s"), (None, long[4], "s"),
            (None, long[4] + " z", "s"), (None, " " + long[4], "s"), (None, long[5], "s"), (8, long[5], "s"), (None, "", "s"), (None, None, "s"), (9, "", "s"), (9, "", "s")]
    got = Counter((x.doc_id, x.text) for x in jaccard.keep_one_each(docs(spark, more)).collect())
    assert sum(got.pop((None, t), 0) for _, t, _ in more[6:9]) == 1  # of copies without ids one stays
    assert got == Counter([(5, long[0]), (3, long[1]), (6, long[2]), (6, long[3]), (8, long[5]), (None, ""), (None, None), (9, "")])
    # nothing but copies goes: each text kept or near one that is
    kept = jaccard.keep_one_each(docs(spark, rows)).collect()
    sets = [shingles(x.text) for x in kept]
    for _, text, _ in rows:
        own = shingles(text)
        assert not own or any(len(own & s) / len(own | s) >= 0.8 for s in sets)
    import corpus_pipeline
    assert corpus_pipeline.drop_near_copies(spark, docs(spark, more), SF).count() == 9


def deduped(rows, n=13):
    first, out = {}, []
    for i, t, _ in rows:
        w = words(t)
        for k in range(len(w) - n + 1):
            if i is not None:
                first[tuple(w[k:k + n])] = min(i, first.get(tuple(w[k:k + n]), i))
    for i, t, _ in rows:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - n + 1):
            if i is not None and first[tuple(w[k:k + n])] < i:
                gone[k:k + n] = [True] * n
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out, key=str)


@pytest.mark.parametrize("letters", [2, 6, 300])
def test_substring(spark, letters):
    r = random.Random(letters)
    pool = [str(i) for i in range(letters)]
    base = [[r.choice(pool) for _ in range(r.randint(0, 90))] for _ in range(40)]
    rows = [(i, " ".join(b), "s") for i, b in enumerate(base)]
    for i in range(60):
        own = []
        for _ in range(3):
            b = r.choice(base)
            a = r.randint(0, max(0, len(b) - 14))
            own += b[a:a + r.randint(8, 40)] + [r.choice(pool) for _ in range(r.randint(0, 5))]
        rows.append((500 - i, " ".join(own), "s"))
    rows += odd(r)
    got = substring.dedup(docs(spark, rows)).collect()
    assert sorted(((x.doc_id, x.n_words, x.n_removed, x.kept) for x in got), key=str) == deduped(rows)
    for x in got:
        assert sum(s.end - s.start for s in x.removed) == x.n_removed and x.lang == "en"


def test_substring_empty(empty):
    assert substring.dedup(empty).count() == 0


def test_bpe(spark, table, rows, empty):
    vocabulary = queries.multi_50k()
    ranks = lengths.read_ranks(public_tokenizers.path(queries.MULTI_50K))
    assert all(vocabulary.whole(t) == k for t, k in ranks.items()) and vocabulary.whole(b"\xff\xfe no token") == -1
    assert sorted(vocabulary.index.order) == list(range(len(ranks)))
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, t, _ in rows:
        ids = enc.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, bpe.digests(table, vocabulary).collect()), key=str) == sorted(want, key=str)
    back = bpe.decode(bpe.encode(table, vocabulary), vocabulary).collect()
    assert sorted((str(x.doc_id), bytes(x.decoded).decode()) for x in back) == sorted((str(i), t or "") for i, t, _ in rows)
    odd_ids = spark.createDataFrame([(1, None), (2, [None, -5, 10 ** 6])], "doc_id long, ids array<int>")
    assert [bytes(x.decoded) for x in bpe.decode(odd_ids, vocabulary).collect()] == [b"", b""]
    assert bpe.digests(empty, vocabulary).count() == 0


def text_hash(text):
    return xxhash.xxh64_intdigest((text or "").encode(), 42) >> 12


def test_fingerprints(spark, table, rows, empty):
    got = syncmer.fingerprints(table).collect()
    order = sorted(((-2 ** 63 if i is None else i, text_hash(t), t or "") for i, t, _ in rows))
    want = []
    for (i, _, t), (_, _, after) in zip(order, order[1:] + order[:1]):
        cut = len(t) // 4
        want.append((i, len(t), hashlib.sha256((t[:len(t) - cut] + after[:cut]).encode()).hexdigest()))
    assert sorted((-2 ** 63 if x.doc_id is None else x.doc_id, x.n_chars, x.edited_sha256) for x in got) == sorted(want)
    prints = {}
    for x in got:
        prints.setdefault(x.doc_id, set()).add(x.fingerprint)
        assert 0 <= x.near_edited <= 1 and 0 <= x.near_next <= 1
    assert prints[3] == prints[200] and prints[100] == {""} and all(len(v) == 1 for i, v in prints.items() if i != 7)  # 7 has two texts
    # a shift does not change the anchors of what it moves
    text = "one two three four five six seven eight nine ten eleven twelve"
    moved = spark.createDataFrame([(text,), ("zero and more " + text,)], "text string").select(syncmer.anchors(F.col("text")).alias("a")).collect()
    assert moved[0].a == moved[1].a[-len(moved[0].a):]
    plan = syncmer.fingerprints(table)._jdf.queryExecution().toString() + mixing.mix(table)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|InArrow", plan)
    assert syncmer.fingerprints(empty).count() == 0


def test_licenses(spark):
    files = [("a/LICENSE", "Released under the MIT License.", "x"), ("a/b/c.py", "# nothing here", "x"), ("a/b/d.py", "import os, sys and more\n// Licensed under the Apache License, Version 2.0.\nclass Other words of a program", "x"),
             ("z/e.py", None, "x"), (None, "", "x"), ("a/b/c.py", "# nothing here", "x")]
    got = Counter((r.path, r.license, r.how, r.license_path) for r in licenses.inherit(licenses.scan(
        spark.createDataFrame(files, "path string, text string, license string"))).collect())
    assert got == Counter({("a/LICENSE", "MIT", "file", "a/LICENSE"): 1, ("a/b/c.py", "MIT", "inherited", "a/LICENSE"): 2,
                           ("a/b/d.py", "Apache-2.0", "header", "a/b/d.py"): 1, ("z/e.py", None, "none", None): 1, ("", None, "none", None): 1})
    matcher = licenses.Matcher(licenses.TEMPLATES)
    r = random.Random(6)
    vocabulary = sorted(matcher.idf) + ["foo", "bar"]
    for _ in range(3000):  # lines without a heavy word cannot reach the threshold
        line = [r.choice(vocabulary) for _ in range(r.randint(1, 9))]
        if matcher.best(line)[1] >= matcher.least:
            assert not matcher.heavy.isdisjoint(line)
    assert licenses.inherit(licenses.scan(spark.createDataFrame([], "path string, text string"))).count() == 0


APACHE_HEADER = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
"""
GPL_HEADER = """/* This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version. */
"""


def test_license_texts_and_headers(spark):
    code = "".join(f"def f{i}(x{i}):\n    return g{i}(x{i})  # step {i}\n\n" for i in range(40))
    matcher = licenses.Matcher(licenses.TEMPLATES)
    mit = "Copyright (c) 2020 Someone\n\n" + licenses.TEMPLATES["MIT"][1].split("\n", 4)[4]
    assert matcher.scan(mit)[::2] == ("MIT", True)
    assert matcher.scan(mit.split("\n\nTHE SOFTWARE")[0])[::2] == ("MIT", True)  # without its last paragraph
    assert matcher.scan(GPL_HEADER)[0] == "GPL-3.0"
    assert matcher.scan("import a\n\n" + GPL_HEADER + code)[::2] == ("GPL-3.0", False)
    assert matcher.scan(code + GPL_HEADER.replace("version 3", "version 2") + code)[::2] == ("GPL-2.0", False)
    assert matcher.scan(code + APACHE_HEADER + code)[::2] == ("Apache-2.0", False)
    # the words of a line cut anywhere: no single line says enough
    assert matcher.scan(code + "\n".join(GPL_HEADER.split()) + "\n" + code)[::2] == ("GPL-3.0", False)
    assert matcher.scan(code + "\n# SPDX-License-Identifier: MPL-2.0\n" + code)[::2] == ("MPL-2.0", False)
    assert matcher.scan(code) == (None, 0.0, False) and matcher.scan("By.") == (None, 0.0, False)
    for name, texts in licenses.TEMPLATES.items():
        assert all(matcher.names[matcher.best(licenses.terms(t))[0]] == name for t in texts)
    files = [(None, "p/LICENSE", mit), (3, "p/a.py", code), (None, "q/b.py", code + GPL_HEADER)]
    found = licenses.inherit(licenses.scan(spark.createDataFrame(files, "doc_id long, path string, text string"))).collect()
    assert sorted(((r.path, r.doc_id, r.license, r.how) for r in found)) == [
        ("p/LICENSE", None, "MIT", "file"), ("p/a.py", 3, "MIT", "inherited"), ("q/b.py", None, "GPL-3.0", "header")]


def test_word_hashes():
    import pyarrow as pa
    texts = [None, "", " a  b\n", "é è\tz\x0b", "a b a", "c\x1cd"]
    hashes, counts = common.word_hashes(pa.chunked_array([pa.array(texts[:2]), pa.array(texts[2:])]))
    assert counts.tolist() == [len(words(t)) for t in texts]
    assert len({(h, w) for h, w in zip(hashes.tolist(), [w for t in texts for w in words(t)])}) == len(set(hashes.tolist()))


def test_pipeline(spark):
    import corpus_pipeline
    docs, names = common.read(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, common.cut(stage(spark, docs, SF), "test-stage")
        names.append(name)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == before.columns
    assert len(names) == 5 and docs.count() > 0
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, docs.collect()))
