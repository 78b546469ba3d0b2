"""Relational building blocks of the survey tables.

All of them are DataFrame plans.  Two helpers look at the data while the plan
is built (``HotRanges.find`` and ``SaltedKeys.detect``: one small sampling job
each, whose result stays a DataFrame); neither collects rows to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (F1: ROW_NUMBER() = 1).

    NULL keys form one group, as in SQL window partitions.  The rank filter
    becomes a WindowGroupLimit that runs before the shuffle as well as after
    it, so a hot key ships at most one row per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    rn = "__rn"
    return df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) == 1).drop(rn)


def count_sum_by(df: DataFrame, key: str, count_col: str, sum_col: str,
                 count_alias: str, sum_alias: str) -> DataFrame:
    """COUNT(col) and SUM(col) per key (partial aggregation before the shuffle)."""
    return df.groupBy(key).agg(F.count(count_col).alias(count_alias), F.sum(sum_col).alias(sum_alias))


def presence_flags(df: DataFrame, key: str, label_col: Column, labels: dict) -> DataFrame:
    """Per key, 1 if any row carries the label, else 0 (MAX(CASE ... 1 ELSE 0))."""
    return df.groupBy(key).agg(*[
        F.max(F.when(label_col == lab, 1).otherwise(0)).alias(out) for lab, out in labels.items()])


def conditional_counts(df: DataFrame, key: str, conds: dict) -> DataFrame:
    """E5: per key, number of rows meeting each condition (SUM(CASE ... 1 ELSE 0))."""
    return df.groupBy(key).agg(*[F.sum(F.when(c, 1).otherwise(0)).alias(out) for out, c in conds.items()])


def previous_value(df: DataFrame, value: Column, partition: Sequence[str], order: Sequence[Column],
                   alias: str) -> DataFrame:
    """value of the previous row in ``order`` within ``partition`` (LAG 1)."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(alias, F.lag(value, 1).over(w))


HOT_KEY_ROWS_CONF = "wayfarer.skew.hotKeyRows"
DEFAULT_HOT_KEY_ROWS = 1_000_000
HOT_BROADCAST_BYTES = 64 << 20


def _hot_rows(spark) -> int:
    return int(spark.conf.get(HOT_KEY_ROWS_CONF, str(DEFAULT_HOT_KEY_ROWS)))


def _kept(df: DataFrame) -> DataFrame:
    """``df`` written to the session's checkpoint folder (small tables of hot keys)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@dataclass
class HotRanges:
    """Contiguous pieces of the rows of leading-key values that hold very many rows.

    ``table`` has one row per hot value: its sorted bounds, cut into groups of
    about equal size (``tops`` holds each group's first bound), so that a row
    finds its piece with two short scans.  Values that are not in the table
    are one piece, number 0.  ``table`` is None if no value is hot.
    Keys may be of any orderable type; NULLs sort first, as in the windows.
    """

    lead: str
    keys: list
    table: DataFrame | None

    #: sampled rows per ``hotKeyRows`` rows: each is a bound, so pieces hold hotKeyRows / 8 rows on average
    PER_HOT = 8

    @classmethod
    def find(cls, df: DataFrame, lead: str, keys: Sequence[str], seed: int = 17) -> "HotRanges":
        """Bounds from one Bernoulli sample of the key columns at a rate of ``PER_HOT`` rows per
        ``hotKeyRows``: it grows with the table by a factor of about 1/100,000 and is grouped on Spark.
        A value is hot if at least half of ``PER_HOT`` of its rows are sampled.  The sample shapes the
        pieces only; results never depend on it."""
        keys = [k for k in keys if k != lead]
        rate = min(1.0, cls.PER_HOT / _hot_rows(df.sparkSession))
        bounds = F.sort_array(F.collect_set(F.struct(*keys)))
        hot = (df.select(lead, *keys).sample(False, rate, seed).groupBy(F.col(lead).alias("__lead"))
               .agg(bounds.alias("__bounds"), F.count(F.lit(1)).alias("__n"))
               .where(F.col("__n") >= max(2, cls.PER_HOT // 2)).drop("__n"))
        hot = hot.withColumn("__side", F.ceil(F.sqrt(F.size("__bounds"))).cast("int"))
        hot = hot.withColumn("__groups", F.transform(
            F.sequence(F.lit(0), F.col("__side") - 1),
            lambda i: F.slice("__bounds", i * F.col("__side") + 1, F.col("__side"))))
        hot = hot.withColumn("__groups", F.filter("__groups", lambda g: F.size(g) > 0))
        hot = hot.select("__lead", "__side", "__groups", F.transform("__groups", lambda g: F.element_at(g, 1)).alias("__tops"),
                         F.size("__bounds").alias("__pieces"))
        hot = _kept(hot)
        return cls(lead, keys, None if hot.isEmpty() else hot)

    def _hinted(self) -> DataFrame:
        size = self.table.agg(F.sum("__pieces")).first()[0] * 32 * (1 + len(self.keys))
        return F.broadcast(self.table) if size <= HOT_BROADCAST_BYTES else self.table

    def with_piece(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` with the number of each row's piece."""
        if self.table is None:
            return df.withColumn(name, F.lit(0))
        key = F.struct(*[F.col(k).alias(k) for k in self.keys])

        def not_above(bounds: Column) -> Column:
            return F.size(F.filter(bounds, lambda b: b <= key))

        x = df.join(self._hinted(), F.col(self.lead).eqNullSafe(F.col("__lead")), "left")
        x = x.withColumn("__top", not_above(F.col("__tops")))
        piece = F.when(F.col("__top") > 0, (F.col("__top") - 1) * F.col("__side")
                       + not_above(F.get("__groups", F.col("__top") - 1))).otherwise(0)
        return (x.withColumn(name, F.when(F.col("__lead").isNull() & F.col("__side").isNull(), 0).otherwise(piece))
                .drop("__lead", "__side", "__groups", "__tops", "__pieces", "__top"))

    def all_pieces(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` (a lookup keyed by the leading key) with one copy per piece of its value."""
        if self.table is None:
            return df.withColumn(name, F.lit(0))
        few = self.table.select("__lead", "__pieces")
        x = df.join(few, F.col(self.lead).eqNullSafe(F.col("__lead")), "left")
        return (x.withColumn(name, F.explode(F.sequence(F.lit(0), F.coalesce("__pieces", F.lit(0)))))
                .drop("__lead", "__pieces"))


def lag_in_pieces(df: DataFrame, ranges: HotRanges, piece: str, value: Column, alias: str, order: Sequence[str],
                  boundary_rows: DataFrame) -> DataFrame:
    """LAG(value) by ``ranges.lead`` over ascending ``order``, on rows that carry their ``piece``.

    ``order`` starts with ``ranges.keys``: pieces are cut on that prefix, later
    columns only order rows inside a piece.  Without hot values this is one
    plain window.  With them the window runs per (value, piece), and the first
    row of a piece takes the last value of the nearest earlier piece, from
    ``boundary_rows`` (same keys and value as ``df``, hot values only).
    """
    order = [c for c in order if c != ranges.lead]
    if order[:len(ranges.keys)] != ranges.keys:
        raise ValueError("order must extend the range keys")
    asc = [F.col(c).asc() for c in order]
    if ranges.table is None:
        return df.withColumn(alias, F.lag(value, 1).over(Window.partitionBy(ranges.lead).orderBy(*asc)))
    w = Window.partitionBy(ranges.lead, piece).orderBy(*asc)
    x = df.withColumns({alias: F.lag(value, 1).over(w), "__first": F.lag(F.lit(1), 1).over(w).isNull()})
    hot = boundary_rows.join(ranges.table.select(F.col("__lead").alias("__hot")),
                             F.col(ranges.lead).eqNullSafe(F.col("__hot")), "left_semi")
    last = (ranges.with_piece(hot, piece).groupBy(F.col(ranges.lead).alias("__lead"), F.col(piece).alias("__at"))
            .agg(F.max(F.struct(*order, value.alias("__v")))["__v"].alias("__v")))
    # one row per piece of one value: a value's pieces are as many as its bounds
    before = last.withColumn("__before", F.lag("__v").over(Window.partitionBy("__lead").orderBy("__at"))).drop("__v")
    x = x.join(F.broadcast(before) if ranges.table.agg(F.sum("__pieces")).first()[0] * 48 <= HOT_BROADCAST_BYTES else before,
               F.col(ranges.lead).eqNullSafe(F.col("__lead")) & (F.col(piece) == F.col("__at")), "left")
    return (x.withColumn(alias, F.when(F.col("__first") & F.col("__at").isNotNull(), F.col("__before")).otherwise(F.col(alias)))
            .drop("__first", "__lead", "__at", "__before"))


def previous_value_balanced(df: DataFrame, value: Column, partition: str, order: Sequence[str], alias: str,
                            key_source: DataFrame | None = None, range_keys: int | None = None) -> DataFrame:
    """LAG(value) OVER (PARTITION BY partition ORDER BY order ASC) that splits hot partitions.

    A plain window sends every row of one ``partition`` value to one task.
    Here values with very many rows are cut into contiguous pieces of the
    order and shuffled by (value, piece); all others are one piece, so the
    usual case is the plain window on one shuffle.

    ``key_source``: a cheaper table with the same rows' keys and values (the
    source before lookups) for the sample and the piece boundaries; default
    ``df``.  ``range_keys``: cut on this many leading columns of ``order``.
    """
    keys = [c for c in order if c != partition]
    source = key_source if key_source is not None else df
    ranges = HotRanges.find(source, partition, keys[:range_keys or len(keys)])
    x = ranges.with_piece(df, "__piece")
    return lag_in_pieces(x, ranges, "__piece", value, alias, keys, source).drop("__piece")


HOT_SAMPLE_CONF = "wayfarer.skew.sampleFraction"
DEFAULT_HOT_SAMPLE = 0.01


@dataclass
class SaltedKeys:
    """Salting of a many-to-one left join on composite keys (probe side skewed).

    * Left rows with a NULL key can never match; they get a salt spread by a
      row hash, so a mass of NULL keys is split over ``null_salts`` tasks.
    * Hot keys - about ``hotKeyRows`` left rows or more, counted on a Bernoulli
      sample of the left keys - are a DataFrame with a number of salts each,
      one per ``hotKeyRows`` rows; their left rows are spread over the salts by
      a row hash, and the one right row per key is copied once per salt.
    Which keys are salted only affects balance, never the result: the join
    runs on (keys, salt) and returns exactly the unsalted join.
    """

    keys: list
    hot: DataFrame | None      # keys as __h0.., __salts
    null_salts: int
    small: bool = True

    @classmethod
    def detect(cls, left: DataFrame, keys: Sequence[str], hot_rows: int | None = None) -> "SaltedKeys":
        spark = left.sparkSession
        hot_rows = hot_rows or _hot_rows(spark)
        rate = float(spark.conf.get(HOT_SAMPLE_CONF, str(DEFAULT_HOT_SAMPLE)))
        k = left.select(*keys).dropna("any")
        if rate < 1.0:
            k = k.sample(False, rate, 23)
        least = max(2, int(hot_rows * rate / 2)) if rate < 1.0 else hot_rows
        hot = _kept(k.groupBy(*[F.col(c).alias(f"__h{i}") for i, c in enumerate(keys)]).count()
                    .where(F.col("count") >= least)
                    .select(*[f"__h{i}" for i in range(len(keys))],
                            F.ceil(F.col("count") / F.lit(rate * hot_rows) + 1).cast("int").alias("__salts")))
        n = hot.count()
        return cls(list(keys), hot if n else None, int(spark.conf.get("spark.sql.shuffle.partitions")),
                   n * 64 <= HOT_BROADCAST_BYTES)

    def _any_null(self) -> Column:
        out = F.lit(False)
        for c in self.keys:
            out = out | F.col(c).isNull()
        return out

    def _with_salts(self, df: DataFrame) -> DataFrame:
        if self.hot is None:
            return df.withColumn("__salts", F.lit(1))
        cond = F.lit(True)
        for i, c in enumerate(self.keys):
            cond = cond & (F.col(c) == F.col(f"__h{i}"))
        return (df.join(F.broadcast(self.hot) if self.small else self.hot, cond, "left")
                .drop(*[f"__h{i}" for i in range(len(self.keys))]).withColumn("__salts", F.coalesce("__salts", F.lit(1))))

    def salt_left(self, df: DataFrame, row_hash: Column, name: str) -> DataFrame:
        x = self._with_salts(df.withColumn("__row_hash", row_hash))
        return x.withColumn(name, F.when(self._any_null(), F.pmod("__row_hash", F.lit(self.null_salts))).otherwise(
            F.pmod("__row_hash", F.col("__salts"))).cast("int")).drop("__salts", "__row_hash")

    def salt_right(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` (one row per key) with salt column ``name``: rows of hot keys once per salt."""
        if self.hot is None:
            # always 0, but no literal: that would be folded out of the join keys, the join would then shuffle
            # both sides once more without the salt, and a mass of NULL keys would meet in one task
            return df.withColumn(name, F.pmod(F.xxhash64(*self.keys), F.lit(1)).cast("int"))
        return (self._with_salts(df).withColumn(name, F.explode(F.sequence(F.lit(0), F.col("__salts") - 1)))
                .drop("__salts"))


def gap_since_previous(start: Column, prev_end: Column) -> Column:
    """start - previous end; negative -> -1; no previous (or missing time) -> 0."""
    gap = start - prev_end
    return F.when(gap < 0, -1).otherwise(F.coalesce(gap, F.lit(0)))


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose ``keys`` repeat (opt-in check; joins assume unique lookup keys)."""
    return df.groupBy(*keys).count().where(F.col("count") > 1)
