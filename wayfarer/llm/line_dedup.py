"""Line dedup by distinct-site spread, DataFrame functions only.

Every line (blank-trimmed, ASCII lower-cased) is hashed; a HyperLogLog sketch
of the sites it occurs on is aggregated per hash (partial sketches merge, so a
line on millions of pages is a few KB per map task).  A line whose estimate is
clearly above ``min_sites`` is boilerplate, clearly below is not; in the band
where the sketch could err either way, distinct sites are counted exactly.
Boilerplate lines are removed from every document, except from documents that
consist of them for more than ``max_share`` of their characters: such a
document is a copy as a whole, which is the business of document dedup.

The sketch's relative error is 0.8325 / sqrt(2^lg_k) at most (1.04 / sqrt for
merged sketches); the band is ``guard`` such errors wide.

Defined cases: null, empty and blank texts have no lines and stay as they are;
a null site counts as one site of its own; lines that repeat within one
document count once; repeated rows are all cleaned alike; an empty table gives
an empty result.  Other columns pass through; ``n_chars`` is not touched.
Documents are cleaned by a join on the row's identity (hashes of the text and of
the other columns that can be hashed), so ids need not be unique, and copies of
one text do not meet in one task unless they are equal in those columns too.

Lines that hold more than 1 / ``HEAVY`` of the occurrences of frequent lines, at most
``HEAVY`` of them, are broadcast with a number of salts in proportion to their
occurrences; joins on lines use (line, salt), so no line's rows meet in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfarer.llm.common import BLANKS, ascii_lower, stored, text_key

MIN_SITES, LG_K, GUARD, MAX_SHARE = 10, 12, 4.0, 0.5
#: Most lines that are ever broadcast as heavy; lines below FREQUENT occurrences never are.
HEAVY, FREQUENT = 10_000, 1_000


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _normal(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def _hashes(text: Column) -> Column:
    """One hash per line of ``text``, null for lines without a word."""
    return F.transform(_lines(ascii_lower(text)), lambda x: F.when(
        _normal(x) != "", F.xxhash64(_normal(x))))


def _seen(docs: DataFrame, text_col: str, site_col: str) -> DataFrame:
    """(site, line): the distinct line hashes of every document."""
    return docs.select(F.coalesce(F.col(site_col).cast("string"), F.lit("\0none")).alias("site"),
                       F.explode(F.array_distinct(_hashes(F.col(text_col)))).alias("line")).where("line is not null")


def _spread(seen: DataFrame, least: float, lg_k: int) -> DataFrame:
    """(line, n_sites by sketch, n): the lines on at least ``least`` sites, and all frequent ones."""
    return stored(seen.groupBy("line").agg(F.hll_sketch_agg("site", lg_k).alias("sketch"), F.count("*").alias("n"))
                  .select("line", F.hll_sketch_estimate("sketch").alias("n_sites"), "n")
                  .where((F.col("n_sites") >= least) | (F.col("n") >= FREQUENT)), "line-spread")


def _heavy(spread: DataFrame) -> DataFrame:
    """(line, salts) of the heavy lines: as each has over 1 / HEAVY of the sum, at most HEAVY rows."""
    total = spread.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    share = max(FREQUENT, total / HEAVY)
    return spread.where(F.col("n") > share).select("line", F.ceil(F.col("n") / share).cast("int").alias("salts"))


def _on_lines(rows: DataFrame, lines: DataFrame, heavy: DataFrame, by: Column) -> DataFrame:
    """The ``rows`` whose line is among ``lines``; rows of a heavy line are dealt to its salts by the hash of ``by``."""
    dealt = (rows.join(F.broadcast(heavy), "line", "left")
             .withColumn("salt", F.pmod(F.xxhash64(by), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts"))
    copied = (lines.select("line").join(F.broadcast(heavy), "line", "left")
              .select("line", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt")))
    return dealt.join(copied, ["line", "salt"], "left_semi").drop("salt")


def _decided(seen: DataFrame, spread: DataFrame, heavy: DataFrame, min_sites: int, error: float) -> DataFrame:
    clear = spread.where(F.col("n_sites") > min_sites * (1 + error)).select("line", "n_sites")
    near = spread.where(F.col("n_sites").between(math.floor(min_sites * (1 - error)), min_sites * (1 + error)))
    exact = (_on_lines(seen.distinct(), near, heavy, F.col("site")).groupBy("line").agg(F.count("*").alias("n_sites"))
             .where(F.col("n_sites") >= min_sites))
    return clear.unionByName(exact)


def _error(lg_k: int, guard: float) -> float:
    return guard * 1.04 / math.sqrt(1 << lg_k)


def boilerplate_lines(docs: DataFrame, text_col: str = "text", site_col: str = "source",
                      min_sites: int = MIN_SITES, lg_k: int = LG_K, guard: float = GUARD) -> DataFrame:
    """(line, n_sites): hashes of lines on at least ``min_sites`` sites, with the count that decided."""
    seen, error = _seen(docs, text_col, site_col), _error(lg_k, guard)
    spread = _spread(seen, math.floor(min_sites * (1 - error)), lg_k)
    return _decided(seen, spread, _heavy(spread), min_sites, error)


def _row_key(docs: DataFrame, text_col: str) -> Column:
    """Identity of a row of the struct ``doc``: its text's, and a hash of its other columns (maps and variants left out)."""
    rest = [F.col(f"doc.`{c}`") for c, kind in docs.dtypes
            if c != text_col and not any(x in kind for x in ("map<", "variant"))]
    return F.struct(text_key(F.col(f"doc.`{text_col}`")).alias("text"),
                    (F.xxhash64(*rest) if rest else F.lit(0).cast("long")).alias("rest"))


def dedup_lines(docs: DataFrame, text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES,
                lg_k: int = LG_K, guard: float = GUARD, max_share: float = MAX_SHARE) -> DataFrame:
    """``docs`` as one struct ``doc`` plus the struct ``line_dedup`` (n_lines, n_removed, text)."""
    seen, error = _seen(docs, text_col, site_col), _error(lg_k, guard)
    spread = _spread(seen, math.floor(min_sites * (1 - error)), lg_k)
    heavy = _heavy(spread)
    common = stored(_decided(seen, spread, heavy, min_sites, error).select("line"), "boilerplate")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    body = F.col(f"doc.`{text_col}`")
    keyed = packed.withColumn("key", _row_key(docs, text_col))
    hits = (_on_lines(keyed.select("key", F.posexplode(_hashes(body)).alias("at", "line")).where("line is not null"),
                      common, heavy, F.col("key"))
            .groupBy("key").agg(F.collect_set("at").alias("cut")))
    joined = (keyed.join(hits, "key", "left").withColumn("lines", _lines(body))
              .withColumn("stay", F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "cut")))

    def length(lines):
        return F.aggregate(lines, F.lit(0), lambda n, x: n + F.length(_normal(x)))

    # each array is a column of its own: an array built inside a lambda would be rebuilt per element
    kept = joined.withColumn("left", F.when(F.col("cut").isNotNull(), F.transform("stay", lambda i: F.get("lines", i))))
    good = length(F.col("lines")) - length(F.col("left")) <= max_share * F.length(F.translate(body, "\n", ""))
    return kept.withColumn("good", F.coalesce(good, F.lit(False))).select("doc", F.struct(
        F.size(F.filter("lines", lambda x: _normal(x) != "")).cast("long").alias("n_lines"),
        F.when(F.col("good"), F.size("cut")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("good"), F.array_join("left", "\n")).otherwise(body).alias("text")).alias("line_dedup"))
