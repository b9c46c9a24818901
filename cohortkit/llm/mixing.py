"""Mixing sources to target weights (operator 1).

Every source gets a target number of words. A target of ``e`` whole sizes plus
a rest takes every document of the source ``e`` times (complete epochs) and
fills the rest with a weighted random sample without replacement: document
``i`` draws the exponential key ``-ln(u_i) / w_i`` (Efraimidis and Spirakis),
the documents of a source are put in order of their keys and taken until the
rest is used up; of the document in which that happens only so many words count
as taken (``copies`` rounds it to a whole document or none). ``u_i`` is a hash
of the id, so a rerun draws the same sample.

The order within a source is never produced by one sort, since one source may
hold a third of all documents. Keys fall into ``BINS`` x ``BINS`` cells of equal
expected share; sizes are summed per cell, the prefix sums of the cells tell in
which cell the budget ends, and only the documents of that one cell are sorted.
All of it is DataFrame expressions; the text is read once, for its words.

Defined cases: a null text has size 0; a null source is a source of its own,
last in order; a source without words has target 0; a null, negative or
non-finite weight counts as ``LEAST_WEIGHT``; a null id draws the key of the
empty id; repeated rows are separate documents with the same key, taken one
after the other; an empty table gives an empty result; extra columns of the
input are ignored by ``mix`` and kept by ``mixed_documents``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.llm.common import WORD, cut

#: Weights that the sources get in turn, in order of their names.
WEIGHTS = (5, 2, 1)
#: What all targets add up to, as a share of all sizes.
SHARE = 1.5
#: No source is read more often than this.
MOST_EPOCHS = 2
#: Cells of the key space per level; two levels.
BINS = 1024
#: Quality weights lie between this and 1.
LEAST_WEIGHT = 0.05
#: Characters that lower a document's weight.
SYMBOLS = "#$%&*+/<=>@^_|~!0123456789"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"{WORD}+")), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """The share of a text's characters that are no digits or symbols."""
    kept = F.length(text) - F.regexp_count(text, F.lit(f"[{SYMBOLS}]"))
    share = kept.cast("double") / F.greatest(F.length(text), F.lit(1)).cast("double")
    return F.coalesce(F.greatest(share, F.lit(LEAST_WEIGHT)), F.lit(LEAST_WEIGHT))


def uniform(doc_id: Column) -> Column:
    """A number in (0, 1) from 52 bits of the id's MD5."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / float(2 ** 52)


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
            most: int = MOST_EPOCHS) -> DataFrame:
    """(source, source_size) -> (source, source_size, target).

    One row per source throughout. Sharing out again what capped sources leave
    keeps the others' targets in proportion to their weights, so it ends where
    target = min(cap, level * weight) for one common level; in order of
    cap / weight the capped sources come first, and prefix sums give the level.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*[F.lit(float(w)) for w in weights])
    rows = sizes.withColumn("_w", F.get(turn, (F.row_number().over(by_name) - 1) % len(weights)))
    rows = rows.withColumn("_cap", (F.col("source_size") * most).cast("double"))
    by_cap = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # the level if this source and all later ones were not capped
    left = F.lit(share) * F.sum("source_size").over(Window.partitionBy()).cast("double")
    rows = rows.withColumn("_level", (left - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
                           / F.sum("_w").over(after))
    rows = rows.withColumn("_open", F.col("_level") * F.col("_w") <= F.col("_cap"))
    # every source after the first open one is open, at that one's level
    level = F.min(F.when(F.col("_open"), F.struct(
        (F.col("_cap") / F.col("_w")).alias("r"), F.col("_level").alias("l")))).over(Window.partitionBy())
    rows = rows.withColumn("_l", level["l"])
    target = F.when(F.col("_l").isNull(), F.col("_cap")).otherwise(
        F.least(F.col("_cap"), F.col("_l") * F.col("_w")))
    return rows.select("source", "source_size", target.alias("target"))


def _same_source(a: str, b: str) -> Column:
    return F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))


def _cells(rows: DataFrame, cell: str) -> DataFrame:
    """Prefix sums of the sizes over the cells of each source."""
    sums = rows.groupBy("source", cell).agg(F.sum("size").alias("_sum"), F.max("_rest").alias("_rest"))
    upto = Window.partitionBy("source").orderBy(cell).rowsBetween(Window.unboundedPreceding, 0)
    return sums.withColumn("_upto", F.sum("_sum").over(upto))


def _last_cell(rows: DataFrame, cell: str) -> DataFrame:
    """For each source the first cell whose prefix passes the rest, and the sum before it."""
    over = _cells(rows, cell).filter(F.col("_upto") > F.col("_rest"))
    return over.groupBy("source").agg(
        F.min(F.struct(F.col(cell), (F.col("_upto") - F.col("_sum")).alias("b"))).alias("_m")).select(
        "source", F.col("_m")[cell].alias(f"_end_{cell}"), F.col("_m")["b"].alias(f"_before_{cell}"))


def mix(docs: DataFrame, weight: Column | None = None, weights=WEIGHTS, share: float = SHARE,
        most: int = MOST_EPOCHS, row: Column | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken, and copies, epochs, source, and
    ``row`` as ``number`` if that is given: a number of each row.

    ``taken`` is the words the mix takes of a document, ``copies`` how often
    it is in a mix of whole documents. ``weight`` is the document's quality weight.
    """
    w = quality_weight(F.col("text")) if weight is None else weight
    w = F.when(w.isNull() | F.isnan(w) | (w < LEAST_WEIGHT), F.lit(LEAST_WEIGHT)).otherwise(F.least(w, F.lit(1.0)))
    key = -F.log(uniform(F.col("doc_id"))) / w
    # the share of a source of weight 1 that has a smaller key
    part = (1.0 - F.exp(-F.col("_key"))) * float(BINS * BINS)
    more = [] if row is None else [row.alias("number")]
    sized = docs.select(F.col("doc_id"), F.col("source"), word_count(F.col("text")).alias("size"), key.alias("_key"), *more)
    sized = sized.withColumn("_at", F.least(F.floor(part), F.lit(BINS * BINS - 1)).cast("int"))
    sized = cut(sized.withColumn("_hi", F.shiftright("_at", 10)).withColumn("_lo", F.col("_at").bitwiseAND(BINS - 1)).drop("_at"),
                "mix-sizes")
    aims = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    aims = aims.withColumn("epochs", epochs)
    rest = F.floor(F.col("target") - (F.col("epochs") * F.col("source_size")).cast("double") + 0.5)
    aims = cut(aims.withColumn("_rest", rest.cast("long")), "mix-targets")

    def with_(rows: DataFrame, more: DataFrame, how: str = "left") -> DataFrame:
        return rows.alias("a").join(more.alias("b"), _same_source("a", "b"), how).select(
            "a.*", *[f"b.{c}" for c in more.columns if c != "source"])

    slim = with_(sized, aims.select("source", "_rest"))
    high = cut(_last_cell(slim, "_hi"), "mix-high")
    inside = with_(slim, high, "inner").filter(F.col("_hi") == F.col("_end__hi"))
    inside = inside.withColumn("_rest", F.col("_rest") - F.col("_before__hi"))
    low = cut(_last_cell(inside, "_lo").withColumnRenamed("_before__lo", "_before_lo"), "mix-low")
    ends = cut(with_(with_(aims, high), low), "mix-ends")
    rows = with_(sized, ends)
    place = F.when(F.col("_end__hi").isNull() | (F.col("_rest") <= 0), F.lit(0)) \
        .when(F.col("_hi") != F.col("_end__hi"), F.when(F.col("_hi") < F.col("_end__hi"), 1).otherwise(0)) \
        .when(F.col("_lo") != F.col("_end__lo"), F.when(F.col("_lo") < F.col("_end__lo"), 1).otherwise(0)) \
        .otherwise(2)
    rows = rows.withColumn("_place", place)
    more = [] if row is None else ["number"]
    out = ["doc_id", "source", "size", "source_size", "target", "epochs", *more]
    whole = F.col("_place").cast("long")
    clear = rows.filter(F.col("_place") != 2).select(*out, (whole * F.col("size")).alias("_part"), whole.alias("_more"))
    # the one cell of each source in which its budget ends
    order = Window.partitionBy("source").orderBy("_key", "doc_id", "size", *more).rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("_before__hi") + F.col("_before_lo") + F.sum("size").over(order)
    last = rows.filter(F.col("_place") == 2).withColumn("_upto", upto)
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("_rest") - F.col("_upto") + F.col("size")))
    last = last.select(*out, part.alias("_part"),
                       F.when(F.col("size") > 0, part * 2 >= F.col("size")).otherwise(F.col("_upto") <= F.col("_rest"))
                       .cast("long").alias("_more"))
    rows = clear.unionByName(last).withColumn("copies", F.col("epochs") + F.col("_more"))
    return rows.select("doc_id", "size", "source_size", "target",
                       (F.col("epochs") * F.col("size") + F.col("_part")).alias("taken"), "copies", "epochs", "source", *more)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as the mix takes it, with all
    columns of ``docs``. Every row is taken by itself, also where rows share an
    id; a document without words is repeated like any other of its place in the
    order. ``weight`` may be a column of ``docs``."""
    weight = options.pop("weight", None)
    # once written, a row keeps its number
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.monotonically_increasing_id().alias("number"),
                      "doc_id", "source", (quality_weight(F.col("text")) if weight is None else weight).alias("weight"))
    own = cut(own, "mix-rows")
    slim = own.select("doc_id", "source", F.col("row.text").alias("text"), "weight", "number")
    copies = cut(mix(slim, F.col("weight"), row=F.col("number"), **options).filter(F.col("copies") > 0).select("number", "copies"), "mix-copies")
    many = own.select("row", "number").join(copies, "number")
    return many.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("row.*")


#: The same mix in DuckDB, with plain sorts.
SQL = f"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         greatest(coalesce(length(translate(text, '{SYMBOLS}', '')) / greatest(length(text), 1)::DOUBLE, {LEAST_WEIGHT}), {LEAST_WEIGHT}) AS w,
         (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5) / {2 ** 52}.0::DOUBLE AS u
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, 2.0::DOUBLE * source_size AS cap,
        [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS sw FROM s),
v AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
          - coalesce(sum(cap) OVER (ORDER BY cap / sw, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
          / sum(sw) OVER (ORDER BY cap / sw, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM r),
t AS (SELECT v.*, least(cap, sw * coalesce((SELECT arg_min(lev, cap / sw) FROM v x WHERE x.lev * x.sw <= x.cap), cap / sw)) AS target FROM v),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM t),
k AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs, d.source,
        floor(e.target - e.epochs * e.source_size + 0.5)::BIGINT AS rest,
        sum(d.size) OVER (PARTITION BY d.source ORDER BY -ln(d.u) / least(d.w, 1.0), d.doc_id, d.size ROWS UNBOUNDED PRECEDING)::BIGINT AS upto
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source),
p AS (SELECT *, greatest(0, least(size, rest - upto + size)) AS part FROM k)
SELECT doc_id, size, source_size, target, (epochs * size + part)::BIGINT AS taken,
       (epochs + CASE WHEN rest <= 0 THEN 0 WHEN size > 0 THEN (2 * part >= size)::INT ELSE (upto <= rest)::INT END)::BIGINT AS copies,
       epochs, source
FROM p
"""
