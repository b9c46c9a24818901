"""Document fingerprints from closed syncmers (operator 9).

A text is its words. Every run of ``K`` = 5 words is a k-mer, and its inner
substrings are its pairs of neighbouring words, hashed. A k-mer is a closed
syncmer, and its hash an anchor, if the smallest pair hash stands at one of its
edges. That depends on nothing but the k-mer, so an edit only changes the
anchors it touches, and the anchors of unchanged text match wherever it stands.

The fingerprint has all anchors of a text in text order, 40 bits of each, as
base64 of their bytes; it grows with the text, and nothing is left out. Likeness
matches anchors by what they are and by their order: of the anchors that both
texts have (the first place of each counts), those are matched that follow the
same common anchor in both, and the first. Likeness is their number over that
of all anchors of either text. A passage that two texts share, however long they
are, shows, and a passage that moves costs no more than its two ends.

Only DataFrame functions are used. The successor of a document comes from one
shuffle of the texts: rows are cut into ranges of (id, text hash) at approximate
quantiles, the rows that start a range are also sent to the range before, and a
window per range looks one row ahead. An id that spans several ranges is cut at
quantiles of its texts' hashes, so that an id, or a missing one, of a third of all
rows is dealt like any other (rows equal in id and text stay together). A range
has about ``RANGE_CHARS`` characters; from ``MOST_RANGES`` ranges on, ranges grow
instead (their starts are part of the plan); a range is sorted and read as a
stream, which spills and never needs to fit into memory.

Defined cases: a null text is empty and has an empty fingerprint; a text whose
k-mers give no anchor has one anchor, all its words; two empty fingerprints are
alike (1.0), an empty and another are not (0.0); a null id comes before all
others; rows of one id follow each other in order of a hash of their texts; the only
document is followed by itself; an empty table gives an empty result; extra
columns are left behind.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.llm.common import bins_for, id_or_none, shuffle_partitions, text_or_empty

#: Words of a k-mer. Its inner substrings are pairs of words.
K = 5
#: Bits of an anchor.
BITS = 40
#: Characters of a range of ids, roughly, and the most ranges there can be.
RANGE_CHARS, MOST_RANGES = 16_000_000, 100_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def anchors(text: Column, k: int = K) -> Column:
    """The hashes of the closed syncmers of a text, in text order."""
    inner = k - 1  # pairs in a k-mer

    def of_pairs(h: Column) -> Column:
        def closed(i: Column) -> Column:
            edge = F.least(F.get(h, i), F.get(h, i + (inner - 1)))
            between = [F.get(h, i + j) for j in range(1, inner - 1)]
            return F.lit(True) if not between else edge <= (F.least(*between) if len(between) > 1 else between[0])

        at = F.filter(F.sequence(F.lit(0), F.size(h) - inner), closed)
        return F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(inner)]))

    def of_words(w: Column) -> Column:
        n = F.size(w)
        pairs = F.zip_with(F.slice(w, F.lit(1), n - 1), F.slice(w, F.lit(2), n - 1), lambda a, b: F.xxhash64(a, b))
        found = F.when(n >= k, _bind(pairs, of_pairs)).otherwise(F.array().cast("array<bigint>"))
        return _bind(found, lambda a: F.when((F.size(a) > 0) | (n == 0), a).otherwise(F.array(F.xxhash64(w))))

    return _bind(words(text), of_words)


def _bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def sketch(text: Column, k: int = K) -> Column:
    """All anchors in text order, ``BITS`` bits of each."""
    return F.transform(anchors(text, k), lambda a: F.shiftrightunsigned(a, 64 - BITS))


def fingerprint(of_sketch: Column) -> Column:
    digits = F.transform(of_sketch, lambda a: F.lpad(F.hex(a), BITS // 4, "0"))
    return F.translate(F.base64(F.unhex(F.array_join(digits, ""))), "\r\n", "")  # lines are cut at 76 characters


def likeness(a: Column, b: Column) -> Column:
    """The share of anchors matched in order; ``a`` and ``b`` are sketches."""
    steps = lambda c: F.zip_with(F.slice(c, F.lit(1), F.size(c) - 1), F.slice(c, F.lit(2), F.size(c) - 1), lambda x, y: F.xxhash64(x, y))

    def of(pair: Column) -> Column:
        a, b = pair["a"], pair["b"]

        def of_common(c: Column) -> Column:
            # the anchors that both have, in the order of a and in that of b
            n = F.size(c["a"])
            matched = F.when(n > 0, F.size(F.array_intersect(steps(c["a"]), steps(c["b"]))) + 1).otherwise(0)
            every = F.size(a) + F.size(b) - n
            return F.when(every == 0, F.lit(1.0)).otherwise(matched.cast("double") / every.cast("double"))

        return _bind(F.struct(F.array_intersect(a, b).alias("a"), F.array_intersect(b, a).alias("b")), of_common)

    return _bind(F.struct(F.array_distinct(a).alias("a"), F.array_distinct(b).alias("b")), of)


def _starts(rows: DataFrame, ranges: int) -> list[tuple[int, int]]:
    """(id, hash) that start a range, the smallest first: hash -1 is the beginning of
    an id. Every one is that of some row."""
    share = [i / ranges for i in range(1, ranges)]
    got = rows.agg(F.min("_id").alias("least"), F.percentile_approx("_id", share or [0.0], 20 * ranges).alias("at")).first()
    if got["least"] is None:
        return []
    times = Counter(got["at"] if share else [])
    starts = {(got["least"], -1), *((i, -1) for i in times)}
    # an id that starts several ranges is cut inside
    often = {i: n for i, n in times.items() if n > 1}
    for n in sorted(set(often.values())):
        same = [i for i, m in often.items() if m == n]
        cuts = rows.filter(F.col("_id").isin(same)).groupBy("_id").agg(
            F.min("_hash").alias("least"), F.percentile_approx("_hash", [j / n for j in range(1, n)], 20 * n).alias("at")).collect()
        starts |= {(r["_id"], h) for r in cuts for h in r["at"] if h > r["least"]}
    return sorted(starts)


def _range_of(doc_id: Column, hash_: Column, starts: list[tuple[int, int]]) -> Column:
    """The last range that starts at or before the row, by bisection."""
    ids, hashes = F.lit([i for i, _ in starts]), F.lit([h for _, h in starts])
    steps = [2 ** b for b in reversed(range(len(starts).bit_length()))]

    def reached(at: Column) -> Column:
        i = F.get(ids, at)
        return F.coalesce((i < doc_id) | ((i == doc_id) & (F.get(hashes, at) <= hash_)), F.lit(False))

    return F.aggregate(F.lit(steps), F.lit(0), lambda acc, step: F.when(reached(acc + step), acc + step).otherwise(acc))


def with_next(rows: DataFrame, values: list[str], chars: int) -> DataFrame:
    """``rows`` (with ``_id``, ``text`` and ``values``) and, as ``next_<value>``,
    the values of the row that follows in order of id and text hash; the first row
    follows the last. ``chars`` is the number of characters of all texts."""
    spark = rows.sparkSession
    ranges = min(MOST_RANGES, max(shuffle_partitions(spark), bins_for(chars, RANGE_CHARS)))
    # 52 bits, so that a quantile of them is one of them
    rows = rows.withColumn("_hash", F.shiftrightunsigned(F.xxhash64("text"), 12))
    starts = _starts(rows.select("_id", "_hash"), ranges)
    if not starts:
        return rows.select("*", *[F.col(v).alias(f"next_{v}") for v in values])
    last = len(starts) - 1
    rows = rows.withColumn("_range", _range_of(F.col("_id"), F.col("_hash"), starts))
    before = F.when(F.col("_range") == 0, F.lit(last)).otherwise(F.col("_range") - 1)
    start_id, start_hash = (F.get(F.lit([s[x] for s in starts]), F.col("_range")) for x in (0, 1))
    own = F.struct(F.col("_range").alias("r"), F.lit(False).alias("ahead"))
    first = (start_id == F.col("_id")) & ((start_hash == -1) | (start_hash == F.col("_hash")))
    copies = F.when(first, F.array(own, F.struct(before.alias("r"), F.lit(True).alias("ahead")))).otherwise(F.array(own))
    dealt = rows.withColumn("_c", F.explode(copies)).withColumn("_range", F.col("_c.r")).withColumn("_ahead", F.col("_c.ahead")).drop("_c")
    order = Window.partitionBy("_range").orderBy("_ahead", "_id", "_hash", "text")
    return dealt.select("*", *[F.lead(v).over(order).alias(f"next_{v}") for v in values]).filter(~F.col("_ahead"))


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, n_chars, fingerprint, and the same of the edited text: its last
    quarter replaced by the beginning of the next document."""
    texts = docs.select("doc_id", id_or_none().alias("_id"), text_or_empty().alias("text"))
    chars = texts.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    rows = with_next(texts, ["text"], chars)
    rows = rows.withColumn("n_chars", F.length("text").cast("long")).withColumn("_cut", F.floor(F.length("text") / 4).cast("int"))
    edited = F.concat(F.substr("text", F.lit(1), F.length("text") - F.col("_cut")), F.substr("next_text", F.lit(1), F.col("_cut")))

    def results(s: Column) -> Column:
        return F.struct(fingerprint(s["own"]).alias("fingerprint"), fingerprint(s["edited"]).alias("edited_fingerprint"),
                        likeness(s["own"], s["edited"]).alias("near_edited"), likeness(s["own"], s["next"]).alias("near_next"))

    sketches = F.struct(sketch(F.col("text"), k).alias("own"), sketch(F.col("edited"), k).alias("edited"), sketch(F.col("next_text"), k).alias("next"))
    rows = rows.withColumn("edited", edited).select(
        "doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"), _bind(sketches, results).alias("r"))
    return rows.select("doc_id", "n_chars", "edited_sha256", "r.fingerprint", "r.edited_fingerprint", "r.near_edited", "r.near_next")
