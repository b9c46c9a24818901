"""Schema-first wide table: declare, fill by passes, check ownership.

T1 ``WideSchema`` (columns, types, defaults), T2/T4 reset and empty frame,
T3/T5 base rows, T6/T8/T9 ``update_where``, T7 ``update_from``,
T10 idempotent passes, T11 ``assemble`` with disjoint column ownership,
T12 ``snapshot``; ``CatalogTable`` keeps the snapshots of a table in the catalogue.

Spark's built-in Parquet tables have no row-level UPDATE, so every pass is
a DataFrame function and the table is a fresh snapshot: a pass returns
``(key, own columns)`` and is folded in with a left join on the key. The
left join keeps the table's partitioning by key, so a chain of passes
shuffles each new pass once and the table not at all after the first.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


@dataclass(frozen=True)
class WideColumn:
    name: str
    dtype: str                # Spark SQL type name, e.g. 'decimal(38,9)'
    default: object = None    # NULL = not filled yet; 0 = a valid zero


class WideSchema:
    """The declared wide table (``CREATE TABLE`` with defaults)."""

    def __init__(self, columns: Sequence[WideColumn], key: Sequence[str] = ("person_id",)):
        names = [c.name for c in columns]
        if len(set(names)) != len(names):
            raise ValueError("duplicate column in wide schema")
        self.columns = list(columns)
        self.key = list(key)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, T._parse_datatype_string(c.dtype), True)
                             for c in self.columns])

    def default_of(self, name: str) -> Column:
        col = next(c for c in self.columns if c.name == name)
        return F.lit(col.default).cast(col.dtype)

    def empty(self, spark: SparkSession) -> DataFrame:
        """A table with the declared schema and no rows."""
        return spark.createDataFrame([], self.struct())

    def base_rows(self, df: DataFrame) -> DataFrame:
        """T5: ``INSERT INTO t (cols...) SELECT ...``: given columns are cast,
        every other column takes its default."""
        return df.select(*[F.col(c.name).cast(c.dtype).alias(c.name) if c.name in df.columns
                           else F.lit(c.default).cast(c.dtype).alias(c.name)
                           for c in self.columns])

    def conform(self, df: DataFrame) -> DataFrame:
        """Cast and order to the declared schema (missing columns default)."""
        return self.base_rows(df)

    def ddl(self, table: str) -> str:
        """The declaration as Spark SQL DDL (``DEFAULT`` for non-NULL
        defaults), for teams that keep the table in a catalogue."""
        parts = []
        for c in self.columns:
            d = "" if c.default is None else f" DEFAULT {c.default!r}"
            parts.append(f"  {c.name} {c.dtype.upper()}{d}")
        return f"CREATE TABLE {table} (\n" + ",\n".join(parts) + "\n) USING parquet"


def update_where(df: DataFrame, sets: dict[str, Column], where: Column | None = None
                 ) -> DataFrame:
    """``UPDATE t SET c1 = e1, c2 = e2 WHERE p``.

    All expressions see the row as it was before the update (one
    projection), like SQL. Rows failing ``p`` (or where ``p`` is NULL) keep
    their values.
    """
    cols = {}
    for c, e in sets.items():
        old = F.col(c) if c in df.columns else F.lit(None)
        cols[c] = e if where is None else F.when(where, e).otherwise(old)
    return df.withColumns(cols)


def update_from(target: DataFrame, source: DataFrame, key: str | Sequence[str],
                columns: Sequence[str] | None = None) -> DataFrame:
    """``UPDATE t SET c = s.c FROM (source) s WHERE t.key = s.key``.

    Matched rows take the source values, even NULL ones; unmatched rows keep
    theirs. This is a left join with a match marker, not ``coalesce``. The
    source must have at most one row per key (as the reference's warehouse
    requires); ``assert_unique`` checks it where that is not known.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = list(columns) if columns is not None else [c for c in source.columns
                                                       if c not in keys]
    src = source.select(*keys, *[F.col(c).alias(f"__s_{c}") for c in cols],
                        F.lit(True).alias("__hit"))
    j = target.join(src, keys, "left")
    sets = {}
    for c in cols:
        old = F.col(c) if c in target.columns else F.lit(None)
        sets[c] = F.when(F.col("__hit"), F.col(f"__s_{c}")).otherwise(old)
    out = j.withColumns(sets)
    return out.select(*target.columns, *[c for c in cols if c not in target.columns])


def assert_unique(df: DataFrame, key: str | Sequence[str]) -> None:
    """Raise if ``df`` has more than one row for some key (one small job)."""
    keys = [key] if isinstance(key, str) else list(key)
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"source has duplicate keys, e.g. {dup[0].asDict()}")


Pass = Callable[[DataFrame], DataFrame]


def assemble(base: DataFrame, key: str | Sequence[str], passes: Sequence[Pass] = (),
             derived: Sequence[Pass] = ()) -> DataFrame:
    """Fold feature passes into the base, then derived steps.

    Each pass reads the base and returns ``(key, own columns)``; passes must
    own disjoint columns, so their order does not matter. Derived steps run
    last on the assembled table (slopes, ratios).
    """
    keys = [key] if isinstance(key, str) else list(key)
    outs = [p(base) for p in passes]
    owned: dict[str, int] = {}
    for i, o in enumerate(outs):
        for c in o.columns:
            if c in keys:
                continue
            if c in owned:
                raise ValueError(f"column {c!r} written by passes {owned[c]} and {i}")
            owned[c] = i
    table = base
    for o in outs:
        table = update_from(table, o, keys)
    for d in derived:
        table = d(table)
    return table


def snapshot(df: DataFrame, path: str, mode: str = "errorifexists") -> DataFrame:
    """Write the table as a new Parquet snapshot and read it back.

    A snapshot is never overwritten while it is read: each stage of a
    chain of passes writes its own path.
    """
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.parquet(path)


class CatalogTable:
    """A declared wide table in Spark's catalogue, as a chain of versions.

    ``name`` is a view of the current version; every version is a table of its own,
    ``name__<version>``, in the shared checkpoint folder. A change writes a new version
    and then points the view at it, so a reader stays on the version it began
    with (Spark resolves the view when a query is planned), a failed write changes
    nothing, and a change may read the table it replaces. ``expire`` drops
    versions that no one reads any more.
    """

    def __init__(self, spark: SparkSession, name: str, schema: WideSchema):
        self.spark, self.name, self.schema = spark, name, schema
        self.versions: list[str] = []

    def _commit(self, df: DataFrame) -> DataFrame:
        version = f"{self.name}__{uuid.uuid4().hex}"
        path = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/{version}"
        self.schema.conform(df).write.option("path", path).saveAsTable(version)
        self.spark.sql(f"CREATE OR REPLACE VIEW `{self.name}` AS SELECT * FROM `{version}`")
        self.versions.append(version)
        return self.read()

    def read(self) -> DataFrame:
        """The current version; later changes do not show."""
        return self.spark.table(f"`{self.versions[-1]}`")

    def create(self) -> DataFrame:
        """The declaration, without rows."""
        return self._commit(self.schema.empty(self.spark))

    def reset(self) -> DataFrame:
        """The table declared anew: the view goes and comes back empty."""
        self.spark.sql(f"DROP VIEW IF EXISTS `{self.name}`")
        return self.create()

    def truncate(self) -> DataFrame:
        """T4: the declared columns of the current version and none of its rows."""
        return self._commit(self.read().limit(0))

    def insert(self, df: DataFrame) -> DataFrame:
        """Adds rows; columns that ``df`` lacks take their defaults."""
        return self._commit(self.read().unionByName(self.schema.conform(df)))

    def apply(self, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Any pass over the whole table (``update_where``, ``update_from``...)."""
        return self._commit(change(self.read()))

    def expire(self, keep: int = 1) -> None:
        """Drops all but the last ``keep`` versions from the catalogue."""
        while len(self.versions) > keep:
            self.spark.sql(f"DROP TABLE IF EXISTS `{self.versions.pop(0)}`")
