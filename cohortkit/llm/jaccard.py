"""N-gram Jaccard join with a MinHash LSH forest (operator 6).

Two texts are linked if the sets of their ``SHINGLE``-word shingles have a
Jaccard similarity of at least ``THRESHOLD``. Linked texts, and what is linked
with them in turn, are one class.

* Texts of the same words (of equal 128-bit digests) are one node, whatever
  their number.
* Every node has a signature in each of ``TREES`` prefix trees. Two nodes meet
  in a tree if their signatures begin alike. Prefixes are shortened from
  ``LONGEST`` values until the trees find a pair at the threshold with a
  probability of at least ``RECALL``. That holds for the pairs that are hardest to
  find, so where it stops depends on the threshold alone and is worked out
  beforehand (``forest``); nodes are then grouped by prefixes of that length.
  Longer prefixes find a part of the same pairs, shorter ones only more that
  are not similar.
* Nodes that meet are compared by their whole signatures. Those that may be
  similar (an estimate ``SLACK`` below the threshold, four standard errors)
  are joined to groups.
* Within a group, all pairs are verified exactly, by sets of shingles: of the texts
  compared, equal shingles and only those have equal numbers, so that no hash
  decides.

Nodes that meet in large numbers, and large groups, are cut into blocks; each
pair of blocks is a tile of bounded size, compared as one matrix. What leaves a
tile is a count and at most one edge per node, never its pairs. All links
between different texts are counted.

Defined cases: texts without words (null, empty) are each a class of their own
without links; a text of fewer words than a shingle is one shingle of all its
words; equal texts are linked; rows of one id are separate documents; a class
has the smallest id of its documents (null where all are null); an empty table
gives an empty result; extra columns are left behind by ``classes`` and kept by
``keep_one_each`` and ``keep_first``, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import WORD, bins_for, column_batches, cut, hashed, id_or_none, mixed, shuffle_partitions, span_hashes, word_ids, words_key

SHINGLE = 5
THRESHOLD = 0.8
TREES = 20
LONGEST = 12
RECALL = 0.999
SLACK = 0.2
#: Nodes of a block: of those that meet in a tree, and of a group.
MEET_BLOCK, VERIFY_BLOCK = 512, 128
#: Rows and bytes of text that are compared in one call, roughly.
BIN_ROWS, BIN_TEXTS = 20_000, 2_000
#: Documents whose signatures are computed at a time, and their characters.
ROWS = 500

_U = np.uint64


def prefix_length(threshold: float = THRESHOLD, trees: int = TREES, recall: float = RECALL, longest: int = LONGEST) -> int:
    """The longest prefix with which the trees reach the recall at the threshold."""
    for n in range(longest, 1, -1):
        if 1 - (1 - threshold ** n) ** trees >= recall:
            return n
    return 1


def forest(threshold: float = THRESHOLD, trees: int = TREES, recall: float = RECALL) -> tuple[int, int]:
    """Prefix length and number of trees that reach the recall at the threshold: where
    even prefixes of one value don't, more trees are grown."""
    prefix = prefix_length(threshold, trees, recall)
    if threshold >= 1:
        return prefix, trees
    return prefix, max(trees, math.ceil(math.log(1 - recall) / math.log(1 - threshold ** prefix)))


def _numbered(*columns: np.ndarray) -> np.ndarray:
    """Numbers of rows; equal rows, and only those, have equal numbers."""
    order = np.lexsort(columns)
    new = np.zeros(len(order), dtype=np.int64)
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(new)
    return out


class Texts:
    """Shingles of a column of texts, all texts one after the other: as hashes,
    or ``exact`` as numbers, equal for equal shingles only (of these texts)."""

    def __init__(self, column, shingle: int, exact: bool = False):
        high, low, self.sizes = word_ids(column)
        begin = np.cumsum(self.sizes) - self.sizes
        # a text shorter than a shingle is one shingle
        self.counts = np.where(self.sizes >= shingle, self.sizes - shingle + 1, np.minimum(self.sizes, 1))
        self.begin = np.cumsum(self.counts) - self.counts
        long = np.repeat(self.sizes >= shingle, self.counts)
        at = np.repeat(begin - self.begin, self.counts) + np.arange(int(self.counts.sum()))
        if exact:
            number = _numbered(high, low) + 1
            width = np.minimum(np.repeat(self.sizes, self.counts), shingle)
            spans = np.zeros(len(at), dtype=np.int64)
            for i in range(shingle):  # words beyond a short text's end count as none
                word = np.where(i < width, number[np.minimum(at + i, max(0, len(number) - 1))], 0) if len(number) else spans
                spans = _numbered(spans, word)
            self.shingles = spans.astype(np.uint64)
            return
        words = hashed(high, low)
        self.shingles = np.zeros(len(at), dtype=np.uint64)
        self.shingles[long] = span_hashes(words, at[long], shingle, 5)
        for n in range(1, shingle):
            own = np.flatnonzero(self.sizes == n)
            self.shingles[self.begin[own]] = span_hashes(words, begin[own], n, 50 + n)

    def set_of(self, i: int) -> np.ndarray:
        return np.unique(self.shingles[self.begin[i]:self.begin[i] + self.counts[i]])

    def signatures(self, n: int) -> np.ndarray:
        """(texts, n): the n smallest-hash values of every text with words."""
        full = np.flatnonzero(self.counts)
        out = np.empty((len(full), n), dtype=np.uint32)
        a = mixed(np.arange(1, n + 1, dtype=np.uint64)) | _U(1)
        b = mixed(np.arange(n + 1, 2 * n + 1, dtype=np.uint64))
        for j in range(n):
            h = self.shingles * a[j]
            h += b[j]
            h ^= h >> _U(32)
            h *= a[n - 1 - j]
            out[:, j] = np.minimum.reduceat(h, self.begin[full]) >> _U(32)
        return out


def signed(docs: DataFrame, shingle: int = SHINGLE, trees: int = TREES, prefix: int | None = None) -> DataFrame:
    """doc_id, row_key (of the text as it is), key (of its words), n_words, bands
    (one hash per tree) and sig (a byte per value). Keys are cryptographic digests."""
    prefix = prefix or prefix_length(trees=trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in column_batches(batches, ROWS):
            texts = Texts(batch.column(2), shingle)
            full = texts.counts > 0
            bands = np.zeros((len(full), trees), dtype=np.int64)
            low = np.zeros((len(full), trees * prefix), dtype=np.uint8)
            if full.any():
                values = texts.signatures(trees * prefix)
                low[full] = values.astype(np.uint8)
                wide = values.reshape(-1, trees, prefix).astype(np.uint64)
                h = mixed(np.arange(trees, dtype=np.uint64) + _U(77))[None, :].repeat(len(wide), 0)
                for p in range(prefix):
                    h = mixed(h + wide[:, :, p])
                bands[full] = h.view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, bands.size + 1, trees, dtype=np.int32)), pa.array(bands.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([words_key(t) for t in batch.column(2).to_pylist()], pa.binary()), pa.array(texts.sizes), lists, pa.array([r.tobytes() for r in low], pa.binary())],
                ["doc_id", "row_key", "key", "n_words", "bands", "sig"])

    return docs.select(F.col("doc_id").cast("long"), _row_key(), "text").mapInArrow(
        run, "doc_id long, row_key binary, key binary, n_words long, bands array<long>, sig binary")


def _row_key() -> Column:
    """16 bytes of the text's SHA-256 (null: as of an empty text)."""
    return F.substring(F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)), 1, 16).alias("row_key")


def _first_row() -> Column:
    """Orders rows by id, nulls last, then by text."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")


def _tiled(rows: DataFrame, by: str, sizes: DataFrame, block: int, per_bin: int, rows_in: int) -> DataFrame:
    """``rows`` joined with ``sizes`` (by, n), cut into tiles: a row of block b
    goes to the tiles (b, j) of all j. ``_bin`` packs whole tiles."""
    parts = F.ceil(F.col("n") / block).cast("int")
    # merge joins: the same plan at every size, and skewed keys can be split
    many = rows.join(sizes.hint("merge"), by).withColumn("_parts", parts).withColumn("_b", F.pmod(F.xxhash64("node", F.lit(3)), F.col("_parts")).cast("int"))
    many = many.withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    many = many.withColumn("_lo", F.least("_b", "_j")).withColumn("_hi", F.greatest("_b", "_j"))
    bins = max(shuffle_partitions(rows.sparkSession), bins_for(rows_in, per_bin))
    return many.withColumn("_bin", F.pmod(F.xxhash64(by, "_lo", "_hi"), F.lit(bins))).drop("n", "_parts", "_j")


def _runs(table: pa.Table, by: str) -> tuple[np.ndarray, np.ndarray]:
    """An order of the rows in which tiles are together, and where each begins."""
    cols = [table.column(c).to_numpy() for c in ("_hi", "_lo", by)]
    order = np.lexsort(cols)
    new = np.zeros(len(order), dtype=bool)
    for c in cols:
        new[1:] |= c[order][1:] != c[order][:-1]
    new[:1] = True
    return order, np.append(np.flatnonzero(new), len(order))


def _leaders(near: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """For each row the smallest node it is connected with. ``near`` is symmetric."""
    label = nodes.copy()
    top = np.iinfo(np.int64).max
    while True:
        lower = np.minimum(label, np.where(near, label[None, :], top).min(axis=1))
        if (lower == label).all():
            return label
        label = lower


def _across(block: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Pairs that a tile has to compare: those of its two blocks."""
    pairs = block[:, None] != block[None, :] if lo != hi else np.ones((len(block), len(block)), dtype=bool)
    np.fill_diagonal(pairs, False)
    return pairs


def _meet(least: float):
    """Edges (a, b) that connect the nodes of each tile that may be similar."""

    def run(table: pa.Table) -> pa.Table:
        order, cuts = _runs(table, "band")
        node = table.column("node").to_numpy()[order]
        b, lo, hi = (table.column(c).to_numpy()[order] for c in ("_b", "_lo", "_hi"))
        raw = table.column("sig").to_pylist()
        sig = np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), -1)[order]
        enough = least * sig.shape[1]
        size = np.diff(cuts)
        two = cuts[:-1][(size == 2) & (lo[cuts[:-1]] == hi[cuts[:-1]])]
        two = two[(sig[two] == sig[two + 1]).sum(axis=1) >= enough]
        a_out, b_out = [node[two]], [node[two + 1]]
        for i in np.flatnonzero((size > 2) | ((size == 2) & (lo[cuts[:-1]] != hi[cuts[:-1]]))):
            own = slice(cuts[i], cuts[i + 1])
            same = np.zeros((size[i], size[i]), dtype=np.uint16)
            for column in sig[own].T:
                same += column[:, None] == column[None, :]
            lead = _leaders((same >= enough) & _across(b[own], lo[cuts[i]], hi[cuts[i]]), node[own])
            some = lead != node[own]
            a_out.append(node[own][some]), b_out.append(lead[some])
        a, b = np.concatenate(a_out), np.concatenate(b_out)
        pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], axis=1), axis=0) if len(a) else np.empty((0, 2), np.int64)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return run


def _similar(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which sets have the threshold's Jaccard similarity, exactly."""
    size = np.array([len(s) for s in sets], dtype=np.float64)
    if len(sets) == 2:
        common = len(np.intersect1d(*sets, assume_unique=True))
        yes = common > 0 and common / (size[0] + size[1] - common) >= threshold
        return np.array([[False, yes], [yes, False]])
    every, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), size.astype(int))
    _, number, count = np.unique(every, return_inverse=True, return_counts=True)
    shared = count[number] > 1
    number, row = number[shared], row[shared]
    _, number = np.unique(number, return_inverse=True)
    common = np.zeros((len(sets), len(sets)))
    order = np.argsort(number, kind="stable")
    number, row = number[order], row[order]
    width = 8192
    for start in range(0, int(number[-1]) + 1 if len(number) else 0, width):
        a, b = np.searchsorted(number, [start, start + width])
        has = np.zeros((len(sets), width), dtype=np.float32)
        has[row[a:b], number[a:b] - start] = 1
        common += has @ has.T
    return (common > 0) & (common / (size[:, None] + size[None, :] - common + (common == 0)) >= threshold)


def _verify(shingle: int, threshold: float):
    """node, links (documents it is linked with here), lead (the smallest node
    it is connected with here)."""

    def run(table: pa.Table) -> pa.Table:
        texts = Texts(table.column("text"), shingle, exact=True)
        keys, wanted = [words_key(t) for t in table.column("text").to_pylist()], table.column("key").to_pylist()
        order, cuts = _runs(table, "grp")
        node, b, lo, hi, copies = (table.column(c).to_numpy() for c in ("node", "_b", "_lo", "_hi", "copies"))
        out_node, out_links, out_lead = [], [], []
        for x, y in zip(cuts, cuts[1:]):
            own = [i for i in order[x:y] if keys[i] == wanted[i]]
            own = np.array(list({node[i]: i for i in own}.values()), dtype=np.int64)
            if len(own) < 2:
                continue
            near = _similar([texts.set_of(i) for i in own], threshold) & _across(b[own], lo[own[0]], hi[own[0]])
            out_node.append(node[own])
            out_links.append(near @ copies[own])
            out_lead.append(_leaders(near, node[own]))
        cat = lambda parts: np.concatenate([np.empty(0, np.int64), *parts]).astype(np.int64)
        return pa.table({"node": cat(out_node), "links": cat(out_links), "lead": cat(out_lead)})

    return run


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(a, b) -> (node, grp): the smallest node of each connected component.

    Every round takes the smallest label among a node's neighbours and then the
    label of its label, so that chains halve; a round is written before the next.
    """
    both = cut(edges.select("a", "b").union(edges.select("b", "a")).distinct(), f"{name}-edges")
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("grp")), f"{name}-start")
    while True:
        around = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("_a")).agg(F.min("grp").alias("_m"))
        lower = cut(labels.join(around, F.col("node") == F.col("_a")).select(
            "node", F.col("grp").alias("old"), F.least("grp", "_m").alias("grp")), f"{name}-lower")
        heads = lower.select(F.col("node").alias("_n"), F.col("grp").alias("_g"))
        jumped = cut(lower.join(heads, F.col("grp") == F.col("_n")).select(
            "node", "old", F.least("grp", "_g").alias("grp")), f"{name}-jump")
        labels = jumped.select("node", "grp")
        if jumped.filter(F.col("old") != F.col("grp")).isEmpty():
            return labels


def classes(docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, trees: int = TREES,
            recall: float = RECALL) -> DataFrame:
    """doc_id, class_id, n_links, n_copies (documents of the same words, itself
    included) for every document; n_links counts the copies too."""
    return _classes(docs, threshold, shingle, trees, recall).select("doc_id", "class_id", "n_links", "n_copies")


def _classes(docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, trees: int = TREES,
             recall: float = RECALL) -> DataFrame:
    """What ``classes`` says, with row_key, n_words and first: the id and row key
    of the first row of the class (null: the row stands alone)."""
    prefix, trees = forest(threshold, trees, recall)
    rows = cut(signed(docs, shingle, trees, prefix), "jaccard-signed")
    nodes = rows.filter(F.col("n_words") > 0).groupBy("key").agg(
        F.count("*").alias("copies"), F.min(_first_row()).alias("rep"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))
    nodes = cut(nodes.withColumn("node", F.monotonically_increasing_id()), "jaccard-nodes")

    # who meets in a tree
    met = nodes.select("node", F.explode("bands").alias("band"))
    sizes = cut(met.groupBy("band").agg(F.count("*").alias("n")).filter(F.col("n") > 1), "jaccard-meetings")
    n_met = sizes.agg(F.sum("n").alias("n")).first()["n"] or 0
    tiles = _tiled(met, "band", sizes, MEET_BLOCK, BIN_ROWS, n_met).join(nodes.select("node", "sig").hint("merge"), "node")
    edges = tiles.groupBy("_bin").applyInArrow(_meet(max(0.0, threshold - SLACK)), "a long, b long").distinct()
    groups = components(edges, "jaccard-groups")

    # all pairs of a group, exactly
    members = cut(groups.join(nodes.select("node", "key", "copies", "rep"), "node"), "jaccard-members")
    sizes = cut(members.groupBy("grp").agg(F.count("*").alias("n")), "jaccard-sizes")
    # one text per node, found by its row's id and text: rows that share an id never meet
    texts = docs.select(id_or_none().alias("_id"), _row_key(), F.coalesce("text", F.lit("")).alias("text"))
    found = members.select("node", "key", "grp", "copies", id_or_none("rep.doc_id").alias("_id"), F.col("rep.row_key").alias("row_key")).join(
        texts.hint("merge"), ["_id", "row_key"])
    members = found.groupBy("node", "key", "grp", "copies").agg(F.first("text").alias("text"))
    tiles = _tiled(members, "grp", sizes, VERIFY_BLOCK, BIN_TEXTS, sizes.agg(F.sum("n").alias("n")).first()["n"] or 0)
    checked = cut(tiles.groupBy("_bin").applyInArrow(_verify(shingle, threshold), "node long, links long, lead long"), "jaccard-checked")
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    final = components(checked.filter(F.col("lead") != F.col("node")).select(F.col("node").alias("a"), F.col("lead").alias("b")), "jaccard-classes")

    # one row per document; what stands alone needs no join
    known = nodes.select("node", "key", "copies", "rep").join(links, "node", "left").join(final, "node", "left").filter(
        (F.col("copies") > 1) | (F.col("links") > 0))
    known = cut(known.withColumn("grp", F.coalesce("grp", "node")), "jaccard-known")
    first = known.groupBy("grp").agg(F.min("rep").alias("first"))
    known = cut(known.join(cut(first, "jaccard-first"), "grp").select(
        "key", "first", "copies", F.coalesce("links", F.lit(0)).alias("links")), "jaccard-classes")
    out = rows.select("doc_id", "row_key", "key", "n_words").withColumn(
        "key", F.when(F.col("n_words") > 0, F.col("key"))).join(known, "key", "left")
    return out.select("doc_id", F.when(F.col("copies").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
                      (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"),
                      F.coalesce("copies", F.lit(1)).alias("n_copies"), "row_key", "n_words", "first")


def keep_one_each(docs: DataFrame, **options) -> DataFrame:
    """Of each class the first row by id (nulls last) and text, with all its columns.

    Rows are told apart by id and text, so nothing is lost where different texts
    share an id, and copies without ids are reduced to one. Rows equal in both
    are one document, but for those without an id and without words: each is a
    class of its own.
    """
    found = _classes(docs.select("doc_id", "text"), **options)
    own = F.col("first").isNull() | (F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.row_key") == F.col("row_key")))
    firsts = found.filter(own & ~(F.col("doc_id").isNull() & (F.col("n_words") == 0))).select(
        id_or_none().alias("_id"), "row_key").distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), id_or_none().alias("_id"), _row_key())
    kept = rows.join(cut(firsts, "jaccard-kept"), ["_id", "row_key"], "left_semi")
    kept = kept.dropDuplicates(["_id", "row_key"]).select("row.*")
    wordless = ~F.coalesce(F.col("text"), F.lit("")).rlike(WORD)
    return kept.unionByName(docs.filter(F.col("doc_id").isNull() & wordless))


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """Of each class the document with the smallest id, with all its columns.

    For tables in which an id stands for one text: repeated rows of an id are one
    document, even of different texts; rows without an id stay. ``keep_one_each``
    goes by id and text.
    """
    firsts = classes(docs, **options).filter(F.col("class_id") == F.col("doc_id")).select(F.col("doc_id").alias("_id")).distinct()
    kept = docs.join(cut(firsts, "jaccard-kept"), F.col("doc_id") == F.col("_id"), "left_semi").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.filter(F.col("doc_id").isNull()))
