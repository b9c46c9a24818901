"""Per-entity ordered scans that never put a whole entity into one task.

``LAG``/``LEAD``/running ``SUM`` windows partitioned by the entity alone
send every row of an entity to one task. One patient (or supplier, user)
holding a third of all rows would make that task the whole job. Here the
ordered sequence of an entity is cut into time slices:

1. rows are windowed per ``(entity, slice)``: lag/lead/running sums inside a
   slice, so a task sees one slice of one entity;
2. a per-``(entity, slice)`` summary (first row, last row, slice total) is
   built with a partially aggregated ``groupBy`` and scanned per entity
   (a few rows per non-empty slice, however many rows the entity has);
3. the summary is joined back on ``(entity, slice)`` to fill the first/last
   row of each slice and to offset running sums.

The result equals the plain window over the entity, ordered by
``(time, tiebreak)``. Slices are a deterministic function of the row, so a
retried task recomputes the same slices: time buckets of a fixed width, or
(``"auto"``) pieces of about equally many rows between splitters sampled from the
entity's own rows. Windows, aggregates and joins are keyed by one struct of
(entity, slice): an input partitioned by the entity alone, as a join leaves
it, doesn't satisfy that, so the slices do divide a hot entity.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timecalc import epoch_micros, time_bucket

SLICE = "_slice"


def _keys(entity: str | Sequence[str]) -> list[str]:
    return [entity] if isinstance(entity, str) else list(entity)


def _order(time: str, tiebreak: str | Sequence[str] | None) -> list[str]:
    if tiebreak is None:
        return [time]
    return [time] + ([tiebreak] if isinstance(tiebreak, str) else list(tiebreak))


AUTO_TARGET_ROWS = 1_000_000
#: Rows that are sampled per slice; every so-manyth of them is a splitter.
SAMPLES = 8


def _splitters(d: DataFrame, keys: Sequence[str], order: Sequence[Column], target_rows: int
               ) -> DataFrame:
    """``keys`` and ``_cuts``: the entity's splitters, in order. A row is sampled
    by a hash of its entity and place, whatever task reads it."""
    place = F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order)])
    one_in = max(1, target_rows // SAMPLES)
    sampled = d.filter(F.pmod(F.xxhash64(*keys, *order), F.lit(one_in)) == 0)
    places = F.sort_array(F.collect_set(place))
    return (sampled.groupBy(*keys)
                   .agg(F.filter(places, lambda p, i: (i + 1) % SAMPLES == 0).alias("_cuts"))
                   .filter(F.size("_cuts") > 0))


def add_slice(df: DataFrame, time: str, slice_hours: float | str,
              keys: Sequence[str] = (), target_rows: int | None = None,
              tiebreak: str | Sequence[str] | None = None) -> DataFrame:
    """Add the slice column. Rows without an entity or a time cannot be
    placed in an entity's sequence and are excluded; filtering them here,
    before the first shuffle, also lets the row side and the summary side
    share one scan and one exchange (identical plans are reused).

    ``slice_hours="auto"`` cuts each entity at splitters: one pass samples
    about ``SAMPLES`` rows in ``target_rows`` by a hash, and every ``SAMPLES``-th of
    an entity's sampled (time, tiebreak) is a splitter. A slice then has about
    ``target_rows`` rows however they lie in time: also the rows of one instant
    are cut, by their tiebreak. An entity with fewer rows is one slice. The list of
    splitters has rows / ``target_rows`` entries and is joined without a hint.
    """
    cond = F.col(time).isNotNull()
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    d = df.filter(cond)
    if slice_hours != "auto":
        # time is non-NULL here, so the bucket is too; the coalesce only tells
        # Catalyst so, which keeps it from inferring a different filter per branch
        return d.withColumn(SLICE, F.coalesce(time_bucket(time, slice_hours),
                                              F.lit(0).cast("long")))
    order = [epoch_micros(time), *[F.col(c) for c in _order(time, tiebreak)[1:]]]
    d = d.join(_splitters(d, keys, order, target_rows or AUTO_TARGET_ROWS), list(keys), "left")
    own = F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order)])
    # bisection: how many splitters come before the row or are its equal
    steps = F.lit([2 ** b for b in reversed(range(31))])
    reached = lambda n: (n <= F.size("_cuts")) & (F.get(F.col("_cuts"), n - 1) <= own)
    n = F.aggregate(steps, F.lit(0), lambda acc, step: F.when(
        F.coalesce(reached(acc + step), F.lit(False)), acc + step).otherwise(acc))
    sl = F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(n).cast("long")
    return d.withColumn(SLICE, F.coalesce(sl, F.lit(0).cast("long"))).drop("_cuts")


def _placed(df: DataFrame, keys: Sequence[str], time: str, slice_hours: float | str,
            tiebreak: str | Sequence[str] | None) -> DataFrame:
    """``df`` with the slice column as one struct of (entity, slice)."""
    d = df if SLICE in df.columns else add_slice(df, time, slice_hours, keys, tiebreak=tiebreak)
    return d.withColumn(SLICE, F.struct(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)],
                                        F.col(SLICE).alias("n")))


def _entity_window(keys: Sequence[str]):
    """Orders the slices of an entity in a summary."""
    return Window.partitionBy(*[f"{SLICE}._{i}" for i in range(len(keys))]).orderBy(f"{SLICE}.n")


def with_neighbors(df: DataFrame, entity: str | Sequence[str], time: str,
                   tiebreak: str | Sequence[str] | None, cols: Sequence[str], *,
                   prev: bool = True, next: bool = False,
                   slice_hours: float | str = 24.0, keep_slice: bool = False) -> DataFrame:
    """Add ``prev_<c>`` / ``next_<c>`` for each ``c`` in ``cols``.

    Same values as ``lag(c)`` / ``lead(c)`` over
    ``PARTITION BY entity ORDER BY time, tiebreak``.

    One window pass over ``(entity, slice)`` computes the in-slice
    neighbours and flags each slice's first and last row. Those boundary
    rows (at most two per non-empty slice) are the summary: a second window
    over them per entity carries the last row of the previous slice forward
    (and the first row of the next slice backward), and a join on
    ``(entity, slice)`` fills the slice edges. The big side keeps its
    ``(entity, slice)`` partitioning through the join.
    """
    keys = _keys(entity)
    order = _order(time, tiebreak)
    d = _placed(df, keys, time, slice_hours, tiebreak)

    w = Window.partitionBy(SLICE).orderBy(*order)
    rows = d.select(
        "*",
        F.lag(F.lit(1)).over(w).isNull().alias("_first_in_slice"),
        F.lead(F.lit(1)).over(w).isNull().alias("_last_in_slice"),
        *([F.lag(c).over(w).alias(f"_lp_{c}") for c in cols] if prev else []),
        *([F.lead(c).over(w).alias(f"_ln_{c}") for c in cols] if next else []),
    )

    edge = F.struct(*[F.col(c) for c in cols])
    ws = _entity_window(keys)
    summ = (rows.filter(F.col("_first_in_slice") | F.col("_last_in_slice"))
                .groupBy(SLICE)
                .agg(F.max_by(edge, F.col("_last_in_slice").cast("int")).alias("_l"),
                     F.max_by(edge, F.col("_first_in_slice").cast("int")).alias("_f")))
    carry = []
    if prev:
        carry.append(F.lag("_l").over(ws).alias("_cp"))
    if next:
        carry.append(F.lead("_f").over(ws).alias("_cn"))
    summ = summ.select(SLICE, *carry)

    out = rows.join(summ, on=SLICE, how="inner")
    fills = {}
    if prev:
        for c in cols:
            fills[f"prev_{c}"] = F.when(F.col("_first_in_slice"), F.col("_cp")[c]) \
                                  .otherwise(F.col(f"_lp_{c}"))
    if next:
        for c in cols:
            fills[f"next_{c}"] = F.when(F.col("_last_in_slice"), F.col("_cn")[c]) \
                                  .otherwise(F.col(f"_ln_{c}"))
    out = out.withColumns(fills)
    drop = [c for c in out.columns if c.startswith(("_lp_", "_ln_"))]
    drop += ["_first_in_slice", "_last_in_slice"] + [c for c in ("_cp", "_cn") if c in out.columns]
    out = out.drop(*drop)
    return out.withColumn(SLICE, F.col(f"{SLICE}.n")) if keep_slice else out.drop(SLICE)


def running_sum(df: DataFrame, entity: str | Sequence[str], time: str,
                tiebreak: str | Sequence[str] | None, value: str, out: str, *,
                slice_hours: float | str = 24.0, keep_slice: bool = False) -> DataFrame:
    """``SUM(value) OVER (PARTITION BY entity ORDER BY time, tiebreak
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)`` without an
    entity-wide window."""
    return running_sums(df, entity, time, tiebreak, {out: value}, slice_hours=slice_hours,
                        keep_slice=keep_slice)


def running_sums(df: DataFrame, entity: str | Sequence[str], time: str,
                 tiebreak: str | Sequence[str] | None, values: dict[str, str], *,
                 slice_hours: float | str = 24.0, keep_slice: bool = False) -> DataFrame:
    """``running_sum`` of several columns in one scan: ``values`` maps each new
    column to the one it sums up."""
    add = lambda before, within: F.coalesce(before, F.lit(0)) + within
    return _running(df, entity, time, tiebreak, values, F.sum, add, slice_hours, keep_slice)


def running_max(df: DataFrame, entity: str | Sequence[str], time: str,
                tiebreak: str | Sequence[str] | None, value: str, out: str, *,
                slice_hours: float | str = 24.0, keep_slice: bool = False) -> DataFrame:
    """``MAX(value)`` over the entity's rows up to and including each one."""
    return _running(df, entity, time, tiebreak, {out: value}, F.max, F.greatest, slice_hours, keep_slice)


def _running(df: DataFrame, entity: str | Sequence[str], time: str,
             tiebreak: str | Sequence[str] | None, values: dict[str, str],
             aggregate: Callable[..., Column], merge: Callable[[Column, Column], Column],
             slice_hours: float | str, keep_slice: bool) -> DataFrame:
    """Running aggregates. On a slice's last row the in-slice running value is the
    slice's own; those rows (one per non-empty slice) give each slice what came
    before it through a running aggregate per entity over slices, joined back on
    ``(entity, slice)`` and merged.
    """
    keys = _keys(entity)
    order = _order(time, tiebreak)
    d = _placed(df, keys, time, slice_hours, tiebreak)

    # the next row is asked for whole, so that the summary side prunes no column and
    # both sides read one scan and one exchange
    whole = F.struct(*[F.col(f"`{c}`") for c in d.columns])
    w = Window.partitionBy(SLICE).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = d.select("*", *[aggregate(v).over(upto).alias(f"_within_{i}") for i, v in enumerate(values.values())],
                    F.lead(whole).over(w).isNull().alias("_last_in_slice"))

    ws = _entity_window(keys).rowsBetween(Window.unboundedPreceding, -1)
    tot = (rows.filter(F.col("_last_in_slice"))
               .select(SLICE, *[aggregate(f"_within_{i}").over(ws).alias(f"_before_{i}")
                                for i in range(len(values))]))

    res = rows.join(tot, on=SLICE, how="inner")
    res = res.withColumns({out: merge(F.col(f"_before_{i}"), F.col(f"_within_{i}")) for i, out in enumerate(values)})
    res = res.drop("_last_in_slice", *[f"{c}_{i}" for i in range(len(values)) for c in ("_before", "_within")])
    return res.withColumn(SLICE, F.col(f"{SLICE}.n")) if keep_slice else res.drop(SLICE)


def segment_numbers(df: DataFrame, entity: str | Sequence[str], time: str,
                    tiebreak: str | Sequence[str] | None,
                    is_new: Callable[[Column, Column], Column], out: str, *,
                    slice_hours: float | str = 24.0) -> DataFrame:
    """Number the segments of each entity's ordered sequence in one scan.

    ``is_new(prev_time, time)`` says whether a row starts a new segment
    given the previous row's time (the first row of an entity always does).
    Equivalent to ``lag`` + a running ``SUM`` of the start flags, but with a
    single slice summary: per (entity, slice) the first and last time and the
    number of starts after the slice's first row; one window over the
    summaries per entity resolves each slice's first-row flag and its offset,
    and one join on (entity, slice) numbers every row.
    """
    keys = _keys(entity)
    order = _order(time, tiebreak)
    d = _placed(df, keys, time, slice_hours, tiebreak)

    w = Window.partitionBy(SLICE).orderBy(*order)
    prev_in = F.lag(time).over(w)
    inner = F.when(prev_in.isNotNull() & is_new(prev_in, F.col(time)), 1).otherwise(0)
    rows = d.select("*", inner.alias("_inner"),
                    F.lag(F.lit(1)).over(w).isNull().alias("_first_in_slice"),
                    F.lead(F.lit(1)).over(w).isNull().alias("_last_in_slice"))
    rows = rows.withColumn("_cum_inner", F.sum("_inner").over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))

    edges = rows.filter(F.col("_first_in_slice") | F.col("_last_in_slice"))
    summ = edges.groupBy(SLICE).agg(
        F.max_by(F.col(time), F.col("_first_in_slice").cast("int")).alias("_t_first"),
        F.max_by(F.col(time), F.col("_last_in_slice").cast("int")).alias("_t_last"),
        F.max_by(F.col("_cum_inner"), F.col("_last_in_slice").cast("int")).alias("_starts"))
    ws = _entity_window(keys)
    prev_last = F.lag("_t_last").over(ws)
    summ = summ.select(SLICE, "_starts",
                       F.when(prev_last.isNull() | is_new(prev_last, F.col("_t_first")), 1)
                        .otherwise(0).alias("_first_flag"))
    summ = summ.select(SLICE, "_first_flag",
                       F.coalesce(F.sum(F.col("_first_flag") + F.col("_starts")).over(
                           ws.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
                        .alias("_offset"))
    res = rows.join(summ, on=SLICE, how="inner")
    res = res.withColumn(out, F.col("_offset") + F.col("_first_flag") + F.col("_cum_inner"))
    return res.drop("_inner", "_cum_inner", "_first_in_slice", "_last_in_slice",
                    "_first_flag", "_offset", SLICE)
