"""Lexical search, whitening and secret scans against brute force, and their defined cases."""

import base64
import hashlib
import math
import random
import re
import struct
import time
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from cohortkit.llm import common, html, jaccard, lengths, lexical, mixing, secrets, substring, syncmer, whitening

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, term string, shard long, group long, base string, candidates string"
ITEMS = "item_id long, text string, block long, factor long"


def plain_search(docs, items, k):
    """Rows (doc_id, text) against rows (item_id, text), term by term."""
    bags = [(i, Counter(TERM.findall(t.translate(FOLD))) if t else Counter()) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    N, L = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in set(items):
        scores = []
        for i, b in bags:
            m = 75 + (25 * sum(b.values()) * N) // L
            score = 0
            for t, c in Counter(TERM.findall((text or "").translate(FOLD))).items():
                if t in b:
                    score += c * math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * ((10 ** 9 * b[t]) // (1000 * b[t] + 12 * m))
            if score:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def texts(r, n, most=60):
    vocabulary = ["the", "The", "é", "Ünï", "a1", "b-c", "x" * 50, "of\x00it", "\U0001f600"] + [f"w{i}" for i in range(60)]
    weights = [40, 20, 5, 5, 5, 5, 1, 3, 2] + [1 + 60 // (i + 1) for i in range(60)]
    return [" ".join(r.choices(vocabulary, weights, k=r.randint(0, most))) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(11)
    rows = list(enumerate(texts(r, 700)))
    rows += [(7, rows[9][1]), (7, rows[9][1]), (None, rows[3][1]), (None, rows[5][1]), (900, None), (901, ""), (902, " -- "),
             (903, "w1 w2 the " * 20_000)] + [(1000 + i, rows[4][1]) for i in range(200)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "t", 1, 2, "b", "c") for i, t in rows], DOCS).repartition(4)


def test_search_equals_plain_scores(spark, corpus):
    r = random.Random(12)
    items = [(i, t) for i, t in enumerate(texts(r, 25, 12))] + [(3, "w1 w1 the"), (None, "w2 w40"), (50, None), (51, ""), (52, "none-such"), (4, "w5")]
    asked = spark.createDataFrame([(i, t, 9, 9) for i, t in items + items[:3]], ITEMS)
    for k, chars, shards, block in ((20, 8_000_000, 6, 256), (5, 3_000, 2, 4)):
        found = lexical.search(lexical.index(frame(spark, corpus), chars), asked, k, shards, block)
        got = sorted((tuple(x) for x in found.collect()), key=repr)
        assert got == plain_search(corpus, items, k)


def test_search_of_empty_tables(spark, corpus):
    items = spark.createDataFrame([(1, "w1", 0, 0)], ITEMS)
    assert lexical.search(lexical.index(frame(spark, [])), items).collect() == []
    assert lexical.search(lexical.index(frame(spark, [(1, None)])), items).collect() == []
    few = frame(spark, corpus[:50])
    assert lexical.search(lexical.index(few), items.filter("false")).collect() == []


def test_blocks_are_passed_over(spark):
    """A list that isn't essential is opened only where a candidate can still enter."""
    r = np.random.default_rng(1)
    n = r.integers(50, 60, 5000)
    rare, common = np.sort(r.choice(5000, 40, replace=False)), np.arange(5000)
    term = np.concatenate([np.zeros(40, int), np.ones(5000, int)])
    doc = np.concatenate([rare, common])
    heads, bodies = lexical._lists(term, doc, np.concatenate([np.full(40, 3), np.ones(5000, int)]), n, 2)
    lists = [lexical.Postings(h.as_py(), b.as_py()) for h, b in zip(heads, bodies)]
    assert [list(x.all()[0]) for x in lists] == [list(rare), list(common)]
    lists = [lexical.Postings(h.as_py(), b.as_py()) for h, b in zip(heads, bodies)]
    m = lexical.length_norm(n, 5000, int(n.sum()))
    norm = lambda x: lexical.length_norm(x, 5000, int(n.sum()))
    bound = lambda f, p: int((f * lexical.part(p.tf.max(), norm(p.n).min())))
    asked = [(5000, bound(5000, lists[0]), lists[0]), (10, bound(10, lists[1]), lists[1])]
    floor = 5000 * int(lexical.part(np.array([3]), m.min()[None])[0])
    found, score = lexical.search_shard(asked, m, norm, floor, 5)
    assert lists[1].opened < len(lists[1].last) / 2
    exact = np.zeros(5000, int)
    exact[rare] += 5000 * lexical.part(np.full(40, 3), m[rare])
    exact += 10 * lexical.part(np.ones(5000, int), m)
    best = np.sort(exact)[::-1][:5]
    assert list(np.sort(score)[::-1][:5])[0] == best[0] and set(score[score >= floor]) <= set(exact)


def test_varints():
    values = np.array([0, 1, 127, 128, 300, 2 ** 31, 2 ** 40, 5])
    raw, size = lexical._varints(values)
    assert list(lexical._read_varints(raw)) == list(values) and size.sum() == len(raw)


def plain_whitening(rows):
    """n, deviations, covariance of rows (id, vector), by fractions."""
    kept = [(i, tuple(math.floor(256 * float(c)) for c in v)) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    distinct = sorted({x for _, x in kept})
    n, d = len(distinct), len(distinct[0])
    sums = [sum(x[k] for x in distinct) for k in range(d)]
    centre = [[Fraction(x[k]) - Fraction(sums[k], n) for k in range(d)] for x in distinct]
    cov = [[sum(c[a] * c[b] for c in centre) / n for b in range(d)] for a in range(d)]
    deviations = {(i, x): sum((n * x[k] - sums[k]) ** 2 for k in range(d)) for i, x in kept}
    return kept, n, sums, cov, deviations


VECTORS = "vec_id long, embedding array<float>, x string, dim int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 3) for i, v in rows], VECTORS).repartition(3)


def test_whitening_equals_fractions(spark):
    r = random.Random(5)
    rows = [(i, [100.0 + r.gauss(0, 1), r.gauss(0, 3), -0.0, r.gauss(0, .5), r.uniform(-4, 0), 7.25]) for i in range(300)]
    rows += [(400 + i, rows[2][1]) for i in range(200)] + [(1, rows[3][1]), (None, rows[4][1])]
    rows += [(700, None), (701, [1.0, None, 0, 0, 0, 0]), (702, [1.0, math.inf, 0, 0, 0, 0]), (703, [math.nan] * 6), (704, [])]
    # floats as the table has them
    rows = [(i, v and [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows]
    kept, n, sums, cov, deviations = plain_whitening([x for x in rows if x[1] != []])
    got = whitening.whiten(vectors(spark, rows)).collect()
    assert Counter(g.vec_id for g in got) == Counter({i: 4 * c for i, c in Counter(i for i, _ in kept).items()})
    values, axes = np.linalg.eigh(np.array([[float(c) for c in row] for row in cov]))
    values, axes = values[::-1][:4], axes[:, ::-1][:, :4]
    trace = float(sum(cov[k][k] for k in range(len(cov))))
    first = {(i, x): np.array([float(Fraction(x[k]) - Fraction(sums[k], n)) for k in range(len(x))]) for i, x in kept}
    sign = {}
    for g in got:
        k = g.component - 1
        options = [(x, c) for (i, x), c in first.items() if i == g.vec_id]
        near = [(x, float(c @ axes[:, k] / math.sqrt(values[k]))) for x, c in options]
        x, z = min(near, key=lambda e: abs(abs(e[1]) - abs(g.whitened)))
        assert abs(abs(z) - abs(g.whitened)) < 1e-9
        if abs(z) > 1e-3:
            assert sign.setdefault(k, z * g.whitened > 0) == (z * g.whitened > 0)
        assert g.n == n and g.deviation in [deviations[g.vec_id, x] for x, _ in options]
        assert abs(g.explained - values[k] / trace) < 1e-12 and g.identity_error < 1e-9


def test_scatter_is_exact():
    r = np.random.default_rng(3)
    for top in (1, 2, 2 ** 20, 2 ** 62):
        y = r.integers(0, top, (1000, 5), dtype=np.uint64)
        y[:, 2] = 0
        bits = [int(c.max()).bit_length() for c in y.T]
        into = np.zeros((whitening._digits(bits), 5, 5), dtype=np.int64)
        whitening.scatter(y[:700], bits, into)
        whitening.scatter(y[700:], bits, into)
        for i in range(5):
            for j in range(i, 5):
                got = sum(int(p) << (whitening.DIGIT * d) for d, p in enumerate(into[:, i, j]))
                assert got == sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j]))


def test_whitening_cases(spark):
    assert whitening.whiten(vectors(spark, [])).collect() == []
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    mixed = whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [3.0, 2.0]), (3, [5.0]), (4, [6.0]), (5, [8.0])])).collect()
    assert sorted((g.vec_id, g.component, g.n) for g in mixed) == [(1, 1, 2), (2, 1, 2), (3, 1, 3), (4, 1, 3), (5, 1, 3)]
    far = whitening.whiten(vectors(spark, [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 5.0])])).collect()
    assert {g.deviation for g in far} == {None, 1 + 2304 ** 2} and len(far) >= 3  # beyond 64 bits: null


def plain_base(text):
    """The base spans as the contract words them."""
    out = []
    for kind, pattern, group, least in ((0, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
                                        (1, r"AKIA[A-Z0-9]+", 0, 20), (2, r"[0-9a-f]+", 0, 24)):
        out += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text, re.ASCII) if len(m[group]) >= least]
    return sorted(out)


def secret_texts(r, n):
    hexa = lambda k: "".join(r.choices("0123456789abcdef", k=k))
    upper = lambda k: "".join(r.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=k))
    made = [lambda: f"PassWord = '{hexa(10)}'", lambda: f"api_key:{upper(12)}", lambda: f'token="{hexa(5)}"', lambda: f"AKIA{upper(16)}",
            lambda: f"AKIA{upper(15)}", lambda: hexa(24), lambda: hexa(23), lambda: f"secret:token:{upper(9)}", lambda: f"token{' ' * 300}= {hexa(40)}",
            lambda: "toKen: abcdef12", lambda: "ordinary", lambda: "é\U0001f600", lambda: "incomprehensibilities", lambda: "uncharacteristically"]
    return [" ".join(r.choice(made)() for _ in range(r.randint(0, 12))) for _ in range(n)]


def test_base_spans_equal_plain_patterns(spark):
    rows = list(enumerate(secret_texts(random.Random(8), 400)))
    rows += [(500, None), (501, ""), (7, rows[1][1]), (None, rows[1][1]), (502, "a" * 200_000), (503, ("token " * 20_000) + "= abcdef")]
    got = secrets.scan(frame(spark, rows)).collect()
    told = lambda s: ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in s)
    expected = Counter()
    for i, t in rows:
        base = plain_base(t or "")
        kinds = [k for _, k, _ in base]
        expected[i, kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(told(base).encode()).hexdigest(), told(base)] += 1
    # learned spans are of a kind of their own; without them the spans are the base
    bare = lambda s: ",".join(x for x in s.split(",") if not x.startswith("format"))
    assert Counter((g.doc_id, g.n_assign, g.n_access, g.n_hex, g.base_sha256, bare(g.spans)) for g in got) == expected
    assert all(g.n_format == g.spans.count("format:") for g in got)
    starts = [[int(x.split(":")[1]) for x in g.spans.split(",") if x] for g in got]
    assert all(s == sorted(s) for s in starts)


def test_formats_are_learned(spark):
    """Held-out credentials that no pattern names are found, ordinary words are not."""
    r = random.Random(9)
    upper = lambda k: "".join(r.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=k))
    word = lambda: "".join(r.choice(["con", "ter", "a", "ti", "on", "al", "re", "in", "ment"]) for _ in range(9))
    hexa = lambda k: "".join(r.choices("0123456789abcdef", k=k))
    known = [f"AKIA{upper(16)} password={hexa(18)}" for _ in range(300)]
    common = [" ".join(word() for _ in range(70)) + f" {r.randint(10 ** 15, 10 ** 16)}" for _ in range(700)]
    hidden = [f"see {hexa(18)} here" for _ in range(50)]  # neither assigned nor long enough for a run
    rows = list(enumerate(known + common + hidden))
    got = {g.doc_id: g for g in secrets.scan(frame(spark, rows)).collect()}
    assert sum(got[i].n_format > 0 for i in range(1000, 1050)) >= 42
    assert sum(got[i].n_format for i in range(300, 1000)) <= 70  # of 49,700 words
    assert all(got[i].spans.count("access:") == 1 for i in range(300))


def test_formats_are_learned_from_all_strings(spark):
    """Half of the credentials have one format, those of the greater hashes another; unlabelled ones of either are found."""
    r = random.Random(10)
    shape = {False: "0123456789abcdef", True: "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"}
    word = lambda: "".join(r.choice(["con", "ter", "a", "ti", "on", "al", "re", "in", "ment"]) for _ in range(9))
    made = lambda late: "".join(r.choices(shape[late], k=18))
    labelled = {False: [], True: []}
    for late, values in labelled.items():
        while len(values) < 2400:
            value = made(late)
            if (xxhash.xxh64_intdigest(value.encode(), 42) < 2 ** 63) == late:  # as a signed number: not below zero
                values.append(value)
    known = [f"password={v}" for values in labelled.values() for v in values]
    common = [" ".join(word() for _ in range(70)) for _ in range(700)]
    hidden = [f"see {made(late)} here" for late in (False, True) for _ in range(20)]
    got = {g.doc_id: g for g in secrets.scan(frame(spark, list(enumerate(known + common + hidden)))).collect()}
    first = len(known) + len(common)
    assert sum(got[i].n_format > 0 for i in range(first, first + 20)) >= 16
    assert sum(got[i].n_format > 0 for i in range(first + 20, first + 40)) >= 16


def test_fit_counts_every_string(spark):
    r = random.Random(12)
    texts_of = secret_texts(r, 300) + [f"secret={'x' * r.randint(6, 40)}{i}" for i in range(100)] + [None, ""]
    found = secrets.spans(frame(spark, list(enumerate(texts_of)) * 2))
    expected = {k: set() for k in range(4)}
    for text in texts_of:
        base = secrets.base_spans(text or "")
        for _, kind, _, value in base:
            expected[kind].add(value)
        expected[3].update(v for _, _, v in secrets.runs(text or "", base))
    halves = secrets.strings(found)
    rows = halves.collect()
    assert Counter((x.kind, x.value) for x in rows) == Counter((k, v) for k, values in expected.items() for v in values)
    ordered = {k: sorted(v, key=lambda s: (np.uint64(xxhash.xxh64_intdigest(s.encode(), 42)).astype(np.int64), s)) for k, v in expected.items()}
    learned = {k: v[::2] for k, v in ordered.items()}
    assert {(x.kind, x.value) for x in rows if x.learned} == {(k, s) for k, v in learned.items() for s in v}

    half = halves.filter("learned").select("kind", "value")
    for least in (1, 3):
        trees = secrets.trees(half, {k: least for k in learned})
        for kind, values in learned.items():
            words = ["".join(secrets.symbols(v)) for v in values]
            passed = Counter(w[:i] for w in words for i in range(len(w) + 1))
            moves, seen, ends = trees[kind]
            names = {0: ""}
            for state, to in enumerate(moves):
                names.update({t: names[state] + s for s, t in to.items()})
            assert set(names.values()) == {p for p, n in passed.items() if n >= least or not p}
            for state, name in names.items():
                assert ends[state] == words.count(name)
                assert seen[state] == {p[-1]: n for p, n in passed.items() if p and p[:-1] == name}
        automata = {k: secrets.Automaton([], tree=tree) for k, tree in trees.items()}
        counted = secrets.frequencies(half, automata)
        for kind, values in learned.items():
            sizes = [round(math.exp(-never)) for _, _, never in counted[kind]]
            assert sum(round(math.exp(end) * n) - 1 for n, (end, _, _) in zip(sizes, counted[kind])) == len(values)
            assert sum(n - secrets.ALPHABET - 1 for n in sizes) == sum(len(v) + 1 for v in values)
            if least == 1:  # the whole tree: its merged counts are those of the strings
                own = automata[kind].compact()
                assert len(counted[kind]) == len(own) + len(secrets.CLASSES) and counted[kind][:len(own)] == own

    aside = halves.filter("not learned")
    score = lambda k, v: len(v) + 1 / len(set(v))
    plain = {k: sorted(score(k, s) for s in v[1::2]) for k, v in ordered.items()}
    ranks = {k: [1, (len(v) + 1) // 2, len(v)] for k, v in plain.items()}
    assert secrets._at_ranks(aside, score, ranks, {k: len(v) for k, v in plain.items()}) == {k: [plain[k][i - 1] for i in at] for k, at in ranks.items()}


def test_automaton():
    machine = secrets.Automaton(["ab" * k for k in range(1, 8)] * 20)
    table = machine.compact()
    assert len(machine.states) < machine.n_prefixes
    assert secrets.log_likelihood(table, "abab") > secrets.log_likelihood(table, "aabb")


def test_secrets_cases(spark):
    assert secrets.scan(frame(spark, [])).collect() == []
    nothing = hashlib.sha256(b"").hexdigest()
    only = secrets.scan(frame(spark, [(1, None), (2, "")])).collect()
    assert {(g.doc_id, g.n_assign, g.base_sha256, g.spans) for g in only} == {(1, 0, nothing, ""), (2, 0, nothing, "")}
    few = secrets.scan(frame(spark, [(1, "token=abcdef and unquestionablywords")])).collect()
    assert few[0].n_assign == 1 and few[0].n_format == 0


def thue_morse(letters):
    """A word over "ab" and its complement: alike under every polynomial modulo 2^64."""
    bits = [bin(i).count("1") % 2 for i in range(letters)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("letters", [16, 512, 1024, 4096])
def test_words_are_told_apart(spark, letters):
    one, two = thue_morse(letters)
    around = [f"w{i}" for i in range(20)]
    texts = [" ".join(around[:10] + [w] + around[10:]) for w in (one, two)]
    high, low, counts = common.word_ids(pa.array([*texts, f"{one} {two}", None, "x" * 15, "x" * 16, "x" * 15 + "\x00"]))
    assert list(counts) == [21, 21, 2, 0, 1, 1, 1]
    ids = list(zip(high.tolist(), low.tolist()))
    assert len({ids[10], ids[31], *ids[-3:]}) == 5 and ids[42:44] == [ids[10], ids[31]]
    rows = frame(spark, [(1, texts[0]), (2, texts[1]), (3, texts[0])])
    assert sorted((x.doc_id, x.n_removed) for x in substring.dedup(rows).collect()) == [(1, 0), (2, 0), (3, 21)]
    assert sorted((x.doc_id, x.class_id) for x in jaccard.classes(rows).collect()) == [(1, 1), (2, 2), (3, 1)]
    assert sorted(x.doc_id for x in jaccard.keep_one_each(rows).collect()) == [1, 2]


def test_weak_hashes_do_not_join_texts(spark, monkeypatch):
    """However badly shingles are hashed, no text is linked with one that isn't similar."""
    batch = pa.array(["a b c d e f g", "a b c d e f h", "q r s t u v w", "a b", "a b c d e f g", None, ""])
    monkeypatch.setattr(jaccard, "hashed", lambda high, low, seed=0: high * np.uint64(0))
    exact = jaccard.Texts(batch, 5, exact=True)
    sets = [set(exact.set_of(i).tolist()) for i in range(7)]
    assert sets[0] == sets[4] and len(sets[0] & sets[1]) == 2 and not sets[0] & sets[2] and not sets[3] & sets[0]
    assert [len(s) for s in sets] == [3, 3, 3, 1, 3, 0, 0]


def test_stages_keep_all_columns(spark):
    """Columns that are named like helpers, repeated and null ids, through the stages that return documents."""
    import corpus_pipeline
    r = random.Random(6)
    names = ["_id", "kept", "n_words", "copies", "_n", "row", "number", "rest", "size", "_key", "row_key", "removed", "weight"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names)
    pool = [f"w{i}" for i in range(3000)]
    rows = []
    for k in range(200):
        text = " ".join(r.choices(pool, k=r.randint(1, 80)))
        rows.append((r.choice([5, None, k, k, k]), text, "en", f"s{k % 4}", len(text), *[f"{n}-{k}" for n in names]))
    rows += [(k, None, "en", None, None, *[f"{n}-{k}" for n in names]) for k in (300, None)]
    docs = spark.createDataFrame(rows, schema).repartition(3)
    known = {x[5]: x for x in rows}
    for stage in (corpus_pipeline.drop_near_copies, corpus_pipeline.drop_repeats, corpus_pipeline.mix_sources):
        got = stage(spark, docs, "").collect()
        assert stage(spark, docs, "").columns == docs.columns and got
        assert all(tuple(x) == known[x["_id"]] for x in got)
        assert stage(spark, docs.filter("false"), "").count() == 0


def test_mix_meets_its_target_with_repeated_ids(spark):
    rows = [(1, " ".join(["w"] * (300 + 10 * k)), f"s{k % 2}", k) for k in range(40)] + [(None, "a b c", "s0", 90), (None, "a b c d", "s1", 91)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, row long")
    plan = mixing.mix(docs).collect()
    aims = {x.source: x.target for x in plan}
    largest = 300 + 390
    got = Counter()
    for x in mixing.mixed_documents(docs).collect():
        got[x.source] += len(x.text.split())
    assert all(abs(got[s] - t) <= largest for s, t in aims.items())


def test_lengths_encode_once(spark):
    import public_tokenizers
    ranks = lengths.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    found = lengths.histogram(lengths.token_counts(frame(spark, [(1, "a b"), (2, None)]), ranks, public_tokenizers.PATTERN))
    assert "MapInArrow" not in found._jdf.queryExecution().toString() and found.count() == 2


def spark_hash(*values):
    """Spark's xxhash64 of strings and longs."""
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else struct.pack("<q", v), h)
    return h - 2 ** 64 if h >= 2 ** 63 else h


def plain_anchors(text):
    w = text.encode().split()
    w = [x.decode() for x in w]
    if not w:
        return []
    pairs = [spark_hash(a, b) for a, b in zip(w, w[1:])]
    found = [spark_hash(*pairs[i:i + 4]) for i in range(len(w) - 4) if min(pairs[i], pairs[i + 3]) <= min(pairs[i + 1:i + 3])]
    if not found:
        h = 42
        for x in w:
            h = xxhash.xxh64_intdigest(x.encode(), h)
        found = [h - 2 ** 64 if h >= 2 ** 63 else h]
    return [(a % 2 ** 64) >> 24 for a in found]


def plain_likeness(a, b):
    a, b = list(dict.fromkeys(a)), list(dict.fromkeys(b))
    in_a, in_b = set(a), set(b)
    one, two = [x for x in a if x in in_b], [x for x in b if x in in_a]
    every = len(a) + len(b) - len(one)
    matched = len(set(zip(one, one[1:])) & set(zip(two, two[1:]))) + 1 if one else 0
    return matched / every if every else 1.0


def check_fingerprints(spark, rows):
    order = sorted((-2 ** 63 if i is None else i, xxhash.xxh64_intdigest((t or "").encode(), 42) >> 12, t or "") for i, t in rows)
    want = []
    for (i, _, t), (_, _, after) in zip(order, order[1:] + order[:1]):
        edited = t[:len(t) - len(t) // 4] + after[:len(t) // 4]
        a, b, c = plain_anchors(t), plain_anchors(edited), plain_anchors(after)
        told = [base64.b64encode(b"".join(x.to_bytes(5, "big") for x in s)).decode() for s in (a, b)]
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), *told, plain_likeness(a, b), plain_likeness(a, c)))
    got = [(-2 ** 63 if x.doc_id is None else x.doc_id, x.n_chars, x.edited_sha256, x.fingerprint, x.edited_fingerprint,
            x.near_edited, x.near_next) for x in syncmer.fingerprints(frame(spark, rows)).collect()]
    assert sorted(got) == sorted(want)
    return {g[0]: g for g in got}


def test_fingerprints_equal_plain_anchors(spark):
    r = random.Random(21)
    pool = [f"w{i}" for i in range(300)] + ["é", "\U0001f600"]
    rows = [(i, " ".join(r.choices(pool, k=r.randint(0, 150)))) for i in range(60)]
    rows += [(60 + i, rows[i][1] + " and " + rows[i + 1][1]) for i in range(10)] + [(5, rows[6][1]), (5, rows[6][1]), (70, "a b"), (71, None), (72, ""), (73, "\n a \x0b")]
    rows += [(i, " ".join(r.choices(pool, k=30))) for i in [9] * 300 + [None] * 200]  # an id, and no id, of many rows
    check_fingerprints(spark, rows)
    check_fingerprints(spark, [(1, "the only document of them all is this")])


def test_long_texts_show_what_they_share(spark):
    r = random.Random(22)
    own = [[f"{c}{r.randrange(10 ** 9)}" for _ in range(40_000)] for c in "ab"]
    common = [f"c{i}" for i in range(300)]
    got = check_fingerprints(spark, [(i, " ".join(w[:20_000] + common + w[20_000:])) for i, w in enumerate(own)])
    assert 0.002 < got[0][-1] < 0.01
    assert len(base64.b64decode(got[0][3])) // 5 > 15_000


def test_hot_ids_are_dealt_to_many_ranges(spark):
    rows = [(7, f"text {i} of one id") for i in range(3000)] + [(i, f"other {i}") for i in range(1000)]
    texts = frame(spark, rows).select("doc_id", F.col("doc_id").alias("_id"), "text")
    sizes = syncmer.with_next(texts, ["text"], 1).groupBy("_range").count().collect()
    assert max(x["count"] for x in sizes) < 1500 and sum(x["count"] for x in sizes) == 4000


def test_html_quotes_and_malformed_tags():
    text = lambda source: html.Page(source).text()
    assert text("<article><p title=it's>first words</p><p>second</p><p>it's last</p></article>") == "first words\n\nsecond\n\nit's last"
    assert text('<article><p title="a > b">one</p><p title=\'c > "d\'>two</p>') == "one\n\ntwo"
    assert text('<p class=">">one</p><p \'>two</p><p ">three</p>') == "one\n\ntwo\n\nthree"
    assert text('<p title="never closed>one</p><p>two</p>') == "one\n\ntwo"
    assert text("<p>a < b and c <d") == "a < b and c <d" and text("<p>one<!-- never closed <p>two") == "one"
    assert text("<p>x<![CDATA[<b>]]>y</p><!doctype html><?php echo ?>z") == "x<b>y\n\nz"


@pytest.mark.parametrize("source", [
    '<a "' * 250_000, '<a x="' * 160_000, "<a x='\"" * 140_000, "<div>" * 200_000 + "x", "<div><p>word</p>" * 60_000, '<div class="comment"><p>words</p>' * 30_000,
    "<form>" * 100_000 + "text", "<p>" * 250_000, "</p>" * 250_000, "<!--" * 250_000, "<![CDATA[" * 100_000, "<li>" * 200_000, "&" * 10 ** 6, "<" * 10 ** 6,
    "".join(f'<div class="comment">{"w " * 3}</div>' for _ in range(20_000)), "<article>" * 50_000 + "deep" + "</article>" * 50_000])
def test_html_is_linear(source):
    began = time.process_time()
    page = html.Page(source)
    page.text(frozenset([1, 2]))
    assert time.process_time() - began < 12, (source[:20], len(source))


def test_html_tree_removes_an_untold_frame(spark):
    """No tag, class or id says what the frame is: what repeats on the host's pages goes, from two pages on."""
    r = random.Random(31)
    frame = "all of this frame stands on every page of the site and says the same"
    body = lambda: " ".join("".join(r.choice("abcdefgh") for _ in range(7)) for _ in range(40))
    pages = []
    for host, n in (("two.example", 2), ("five.example", 5), ("many.example", 40)):
        for _ in range(n):
            text = body()
            pages.append((len(pages), f"http://{host}/{len(pages)}", f"<body><div><div>{frame}</div><p>{text}</p><div>{frame} <b>too</b></div></div>", text))
    got = html.extract(spark.createDataFrame(pages, "page_id long, url string, html string, text string")).collect()
    assert {x.page_id: x.text for x in got} == {i: t for i, _, _, t in pages}


@pytest.mark.parametrize("threshold", [0.05, 0.2, 0.5, 0.8, 0.95, 1.0])
def test_forest_reaches_its_recall(threshold):
    prefix, trees = jaccard.forest(threshold)
    assert 1 - (1 - threshold ** prefix) ** trees >= jaccard.RECALL - 1e-12
    assert jaccard.forest(0.8) == (5, jaccard.TREES)
