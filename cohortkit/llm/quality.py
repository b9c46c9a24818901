"""Quality classifier by compression (operator 2).

One zstandard dictionary is built from good labelled text, one from bad. Every
text is compressed with each; text that looks like the good sample gets shorter
with the good dictionary. The difference of the two sizes over their sum, with
the share the shorter one is of the text (repetitive text shrinks to almost
nothing), goes through a logistic fit on labelled documents that had no part in
the dictionaries, which calibrates it to a score between 0 and 1.

A text is compressed in blocks of ``BLOCK`` bytes, so that a dictionary counts
as much at the end of a long text as at its beginning. The whole text counts.

The fit sees a bounded sample: at most ``PER_CLASS`` labelled documents of each
class, those with the smallest hashes, and of each at most ``BLOCKS`` blocks
spread evenly over the whole text. Scoring is row by row: no shuffle, and every
task is sent two dictionaries of ``DICTIONARY`` bytes.

Defined cases: null and empty texts get the score of a text of no length;
labels that are null, of unlabelled documents or contradicting each other are
left out; of rows that repeat a labelled id the fit sees one, the first in order
of its blocks; a class of ``LEAST`` documents, one for its dictionary and one to
calibrate, is enough; where a class has fewer nothing can be learned, every score
is the share of good labels (0.5 without any), and ``keep_good`` rejects nothing;
repeated rows are scored alike; an empty table gives an empty result; only ``text`` and
the id are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled documents of a class that a fit sees at most.
PER_CLASS = 2000
#: Blocks of a labelled document that a fit sees at most, and their characters.
BLOCKS, BLOCK_CHARS = 8, 1500
#: Bytes that are compressed at a time.
BLOCK = 1500
#: Bytes of a dictionary.
DICTIONARY = 112_640
#: zstandard's level.
LEVEL = 3
#: Documents a class must have.
LEAST = 2
#: One document in so many calibrates; the others build the dictionaries.
CALIBRATE = 3


class Model:
    """Two dictionaries (bad, good) and the weights of the logistic."""

    def __init__(self, dictionaries: tuple[bytes, bytes] | None, weights: list[float], prior: float):
        self.dictionaries, self.weights, self.prior = dictionaries, weights, prior

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        out = []
        for raw in self.dictionaries:
            d = zstandard.ZstdCompressionDict(raw)
            d.precompute_compress(level=LEVEL)
            out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False))
        return out

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not self.dictionaries:
            return np.full(len(texts), self.prior)
        with_ = self.compressors()
        rows = np.array([features(with_, blocks(t)) for t in texts]).reshape(len(texts), -1)
        return _logistic(rows @ np.array(self.weights)) if len(texts) else np.empty(0)


def blocks(text: str | None) -> list[bytes]:
    raw = (text or "").encode()
    return [raw[i:i + BLOCK] for i in range(0, len(raw), BLOCK)]


def features(with_: list[zstandard.ZstdCompressor], parts: list[bytes]) -> list[float]:
    bad, good = (sum(len(c.compress(p)) for p in parts) for c in with_)
    n = sum(map(len, parts))
    share = min(bad, good) / max(n, 1)
    return [1.0, (bad - good) / max(bad + good, 1), (bad - good) / (10 * max(n, 1) ** 0.5), share, share * share,
            1 / (1 + n / 50)]


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _fit_logistic(rows: np.ndarray, good: np.ndarray, ridge: float = 1e-2) -> list[float]:
    """Newton's method with a small ridge."""
    w = np.zeros(rows.shape[1])
    for _ in range(60):
        p = _logistic(rows @ w)
        h = (rows * np.maximum(p * (1 - p), 1e-9)[:, None]).T @ rows + ridge * np.eye(len(w))
        step = np.linalg.solve(h, rows.T @ (good - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def held_out(doc_id: Column) -> Column:
    """Documents whose labels no fit sees."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """(doc_id, good, parts): the bounded sample of labelled documents.

    At most ``2 * per_class`` ids are sent to every task, and as many rows come back.
    """
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("good"), F.max("quality").alias("_most"))
    known = known.filter(F.col("good") == F.col("_most")).select("doc_id", "good")
    order = F.xxhash64(F.col("doc_id").cast("long"))
    some = [known.filter(F.col("good") == q).orderBy(order, "doc_id").limit(per_class) for q in (0, 1)]
    few = some[0].unionByName(some[1]).withColumnRenamed("doc_id", "_id")
    n = F.greatest(F.length("text"), F.lit(1))
    starts = F.when(n <= BLOCKS * BLOCK_CHARS, F.sequence(F.lit(0), n - 1, F.lit(BLOCK_CHARS))).otherwise(
        F.transform(F.sequence(F.lit(0), F.lit(BLOCKS - 1)),
                    lambda i: F.floor(i * (n - BLOCK_CHARS) / (BLOCKS - 1)).cast("int")))
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(few), F.col("doc_id") == F.col("_id")).select(
        "doc_id", "good", F.transform(starts, lambda i: F.substr(F.col("text"), i + 1, F.lit(BLOCK_CHARS))).alias("parts"))
    return rows.groupBy("doc_id", "good").agg(F.min("parts").alias("parts"))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Learns from labelled documents that are not held out."""
    rows = sorted(((r.doc_id, r.good, r.parts) for r in labelled_sample(docs, labels, per_class).collect()),
                  key=lambda r: (r[0], r[2]))
    sample = [(good, [p.encode()[:4 * BLOCK] for p in parts]) for _, good, parts in rows]
    n_good, n = sum(g for g, _ in sample), len(sample)
    prior = n_good / n if n else 0.5
    if min(n_good, n - n_good) < LEAST:
        return Model(None, [], prior)
    by_class = [[parts for g, parts in sample if g == q] for q in (0, 1)]
    dictionaries, rest = [], []
    for q, docs_of in enumerate(by_class):
        build = [p for i, parts in enumerate(docs_of) if i % CALIBRATE for p in parts if p]
        try:
            raw = zstandard.train_dictionary(DICTIONARY, build, k=200, d=8).as_bytes()
        except zstandard.ZstdError:  # too little text for a trained one: the text itself
            raw = b"\n".join(build)[-DICTIONARY:] or b"\n"
        dictionaries.append(raw)
        rest += [(q, parts) for i, parts in enumerate(docs_of) if i % CALIBRATE == 0]
    model = Model((dictionaries[0], dictionaries[1]), [], prior)
    with_ = model.compressors()
    x = np.array([features(with_, blocks(b"".join(parts).decode())) for _, parts in rest])
    model.weights = _fit_logistic(x, np.array([q for q, _ in rest], dtype=float))
    return model


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(model.score(batch.column(2).to_pylist()), pa.float64())],
                ["doc_id", "held_out", "score"])

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    kind = dict(rows.dtypes)["doc_id"]
    scored = rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The documents that the model does not reject, with all their columns; all
    of them if nothing could be learned."""
    if not model.dictionaries:
        return docs

    @F.pandas_udf("double")
    def quality(texts):
        import pandas as pd
        return pd.Series(model.score([t if isinstance(t, str) else None for t in texts]))

    return docs.filter(quality(F.col("text")) >= threshold)
