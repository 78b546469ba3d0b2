"""Benchmark decontamination by template canonicalisation, DataFrame functions only.

A text becomes a template: numbers, units after numbers, and names (capitalised
words inside a sentence) are replaced by typed placeholders, the rest is
lower-cased without punctuation.  Five-token windows of document templates are
hash-joined with those of benchmark items.  A document that holds at least
``min_share`` (0.8) of an item's windows is a candidate; then the slots are
checked: inside one alignment of document and item, equal slot values of the
item must meet equal values of the document, and different ones different
values.  An alignment is a shift between document and item; a window of the item
that shift misses may lie up to ``max_drift`` tokens off (words put in or left
out), where its nearest hit counts.  The best alignment decides: a candidate is
contaminated if one that holds at least ``min_share`` of the item's windows has
at least ``min_share`` of its recurring slot values consistent (a value that
occurs once cannot be otherwise), as ``verbatim`` if all values of such an
alignment are the item's own, else as ``reparameterised``.  An item whose parts
lie farther apart is judged over all its hits together.

Scale: each document window is a hash and a position; the benchmark's windows
are broadcast only if their counted size is at most ``max_broadcast_bytes``
(else a plain join); hits are pre-aggregated per text and item; raw tokens are
cut out for candidates only.  Equal texts share one identity (``text_key``), so
thousands of copies are one candidate.

Defined cases: null, empty and blank texts, and texts with fewer than five
tokens, have no window and are never contaminated; items with fewer than five
tokens can't be searched and match nothing; windows of placeholders alone do not
count (an item of nothing else matches nothing); repeated items are reported
each under its own id; repeated rows are all reported; null ids stay null;
empty tables give an empty result.  Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfarer.llm.common import BLANK_RE, stored, text_key

WINDOW, MIN_SHARE, MAX_DRIFT, MAX_BROADCAST_BYTES = 5, 0.8, 4, 32 << 20

#: Unit words that become a placeholder after a number.
UNITS = ("km kilometer kilometers kilometre kilometres m meter meters metre metres cm mm mile miles feet foot ft "
         "inch inches yard yards kg kilogram kilograms g gram grams mg lb lbs pound pounds oz ounce ounces "
         "l liter liters litre litres ml s sec second seconds min minute minutes h hour hours day days week weeks "
         "month months year years percent dollar dollars euro euros cent cents usd eur mph kmh degree degrees").split()
NUM, NAME, UNIT = "§n", "§p", "§u"
#: Characters that a template drops.
PUNCTUATION = ".,;:!?\"'()[]{}<>|/\\*#$%&+=_~^`-–—…«»“”„‘’¿¡"


def _split(text: Column) -> Column:
    return F.filter(F.split(text, BLANK_RE), lambda w: w != "")


def raw_tokens(text: Column) -> Column:
    """The tokens of ``text`` without punctuation, as many as ``template_tokens`` has."""
    return _split(F.translate(F.coalesce(text, F.lit("")), PUNCTUATION, ""))

#: Number of the alignment of an item whose parts lie farther apart than any alignment allows.
APART = -(1 << 31)


def template_tokens(text: Column) -> Column:
    t = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?<=[^.!?:;\s§] )\p{Lu}[\p{L}’'-]*", NAME)
    t = F.regexp_replace(t, r"(?<![\p{L}\d§])[+-]?[$€£]?\d[\d.,:/]*%?", NUM)
    t = F.regexp_replace(t, rf"({NUM}[ -]?)(?i:{'|'.join(UNITS)})(?![\p{{L}}\d])", rf"$1{UNIT}")
    return _split(F.translate(F.lower(t), PUNCTUATION, ""))


def _windows(df: DataFrame, *keys: str) -> DataFrame:
    """(keys, at, window) per window of ``df.tokens`` that has a plain token.

    Windows come from zipped shifted copies of the hash array (a column of its own, computed once
    per text), so the cost is linear in the text.
    """
    held = df.select(*keys, F.transform("tokens", lambda w: F.xxhash64(w)).alias("h"))
    zipped = F.arrays_zip(*[F.slice("h", k + 1, F.size("h")) for k in range(WINDOW)])
    holes = [F.xxhash64(F.lit(p)) for p in (NUM, NAME, UNIT)]

    def one(x):
        parts = [x[str(k)] for k in range(WINDOW)]
        plain = parts[0].isin(*holes)
        for p in parts[1:]:
            plain = plain & p.isin(*holes)
        return F.when(parts[-1].isNotNull() & ~plain, F.xxhash64(*parts)).alias("window")

    return held.select(*keys, F.posexplode(F.transform(zipped, one)).alias("at", "window")).where("window is not null")


def contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", min_share: float = MIN_SHARE, max_drift: int = MAX_DRIFT,
                 max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """(key, item_id, share, kind) for every distinct contaminated text and item."""
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("item_text"),
                             text_key(F.col(item_text_col)).alias("item_key"))
    # equal item texts are searched once and named at the end
    texts = items.groupBy("item_key").agg(F.min("item_text").alias("item_text"))
    wanted = stored(_windows(texts.select("item_key", template_tokens(F.col("item_text")).alias("tokens")), "item_key")
                    .withColumnRenamed("at", "item_at"), "benchmark-windows")
    sizes = wanted.groupBy("item_key").agg(F.count_distinct("window").alias("n_windows"))
    small = wanted.count() * 48 <= max_broadcast_bytes
    hint = F.broadcast if small else (lambda x: x)

    body = docs.select(text_key(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    found = (_windows(body.select("key", template_tokens(F.col("text")).alias("tokens")), "key").drop("at")
             .join(hint(wanted.select("item_key", "window").distinct()), "window")
             .groupBy("key", "item_key", "window").agg(F.lit(1).alias("one"))
             .groupBy("key", "item_key").agg(F.count("*").alias("n_found")))
    candidates = stored(found.join(hint(sizes), "item_key").where(F.col("n_found") >= min_share * F.col("n_windows"))
                        .select("key", "item_key", (F.col("n_found") / F.col("n_windows")).alias("share")), "candidates")

    # alignments, on numbers alone: where the candidates' windows stand in text and item
    held = stored(body.join(candidates.select("key").distinct(), "key", "left_semi")
                  .groupBy("key").agg(F.min("text").alias("text"))
                  .select("key", template_tokens(F.col("text")).alias("tokens"), raw_tokens(F.col("text")).alias("raw")), "candidate-texts")
    hits = stored(candidates.select("key", "item_key").join(_windows(held, "key"), "key").join(hint(wanted), ["item_key", "window"])
                  .select("key", "item_key", "item_at", "window", (F.col("at") - F.col("item_at")).alias("shift")), "hits")
    # each hit counts for the alignments near its shift; of a window's hits the nearest is taken
    near = hits.withColumn("align", F.explode(F.sequence(F.col("shift") - max_drift, F.col("shift") + max_drift)))
    aligned = near.groupBy("key", "item_key", "align", "item_at", "window").agg(
        F.min(F.struct(F.abs(F.col("shift") - F.col("align")), "shift"))["shift"].alias("shift"))
    full = stored(aligned.groupBy("key", "item_key", "align").agg(F.count_distinct("window").alias("n_held"))
                  .join(hint(sizes), "item_key").where(F.col("n_held") >= min_share * F.col("n_windows"))
                  .select("key", "item_key", "align"), "alignments")
    # an item whose parts lie farther apart has no such alignment: its windows' first hits together are one
    apart = candidates.select("key", "item_key").join(full.select("key", "item_key").distinct(), ["key", "item_key"], "left_anti")
    first = (hits.join(apart, ["key", "item_key"], "left_semi").groupBy("key", "item_key", "item_at", "window").agg(F.min("shift").alias("shift"))
             .withColumn("align", F.lit(APART)))
    compared = aligned.join(full, ["key", "item_key", "align"], "left_semi").unionByName(first)

    # slots: raw tokens under the placeholders, compared inside one alignment, whatever its hits' shifts
    def holes(df: DataFrame, key: str, raw: str) -> DataFrame:
        return (df.select(key, F.posexplode(F.arrays_zip("tokens", "raw")).alias("pos", "s")).where(F.startswith("s.tokens", F.lit("§")))
                .select(key, "pos", F.col("s.tokens").alias("kind"), F.col("s.raw").alias(raw)))

    item_slots = holes(texts.select("item_key", template_tokens(F.col("item_text")).alias("tokens"),
                                    raw_tokens(F.col("item_text")).alias("raw")), "item_key", "a")
    by = ["key", "item_key", "align", "kind"]
    spots = compared.select("key", "item_key", "align", "shift",
                            F.explode(F.sequence(F.col("item_at"), F.col("item_at") + WINDOW - 1)).alias("pos")).distinct()
    slotted = (spots.join(hint(item_slots), ["item_key", "pos"]).withColumn("at", F.col("pos") + F.col("shift"))
               .join(holes(held, "key", "b").withColumnRenamed("pos", "at"), ["key", "at", "kind"])
               .select(*by, "pos", "a", "b").distinct())

    def tests(one: str, other: str) -> DataFrame:
        """Per slot value: does it recur (only then can it be inconsistent), and does it always meet the same value?"""
        return slotted.groupBy(*by, one).agg(
            (F.count("*") > 1).alias("recurs"), (F.min(other) == F.max(other)).alias("agrees"),
            F.min(F.col("a") == F.col("b")).alias("same")).drop(one)

    slots = tests("a", "b").unionByName(tests("b", "a")).groupBy("key", "item_key", "align").agg(
        F.avg(F.when(F.col("recurs"), F.col("agrees").cast("double"))).alias("consistent"), F.min("same").alias("same"))
    judged = (full.unionByName(apart.withColumn("align", F.lit(APART))).join(slots, ["key", "item_key", "align"], "left")
              .where(F.coalesce("consistent", F.lit(1.0)) >= min_share)
              .groupBy("key", "item_key").agg(F.max(F.coalesce("same", F.lit(True))).alias("same")))
    return (candidates.join(judged, ["key", "item_key"])
            .withColumn("kind", F.when(F.col("same"), "verbatim").otherwise("reparameterised"))
            .join(items.select("item_id", "item_key"), "item_key").select("key", "item_id", "share", "kind"))


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """(doc_id, item_id, share, kind): one row per row of ``docs`` and item that it leaks."""
    found = contaminated(docs, benchmark, text_col, **kw)
    return (docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("key")).join(found, "key")
            .select("doc_id", "item_id", "share", "kind"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **kw) -> DataFrame:
    """``docs`` without contaminated documents, same columns."""
    bad = stored(contaminated(docs, benchmark, text_col, **kw).select("key").distinct(), "contaminated")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                         text_key(F.col(text_col)).alias("key"))
    return packed.join(bad, "key", "left_anti").select("doc.*")
