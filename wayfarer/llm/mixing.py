"""Mixing sources to target weights by temperature, as budgeted block permutations.

Weights: with p_s the sources' token shares, w_s is proportional to p_s^a.  The
exponent a in [0, 1] is found by section search (each round evaluates 31
exponents in one aggregate, so a round halves the interval five times), such
that either the entropy of w reaches ``entropy`` times the logarithm of the
number of sources, or no source is repeated more than ``max_repeats`` times.
Both are monotone in a; the smallest (flattest) admissible exponent is taken
for the repetition limit, the largest (least changed) for the entropy.

Budget: ``budget_tokens`` is dealt out by the weights; by default the least
budget that shows every source at least once, so no document is left out.

Realisation: a source with budget b_s and T_s tokens gives every document
floor(b_s / T_s) times, each time as another permutation, and the rest from one
partial permutation.  A permutation orders blocks of about ``block_tokens``
tokens (a document's block is fixed by hash) by a hash of (seed, epoch, source,
block), and documents inside a block by a hash of (seed, epoch, document).  The
partial epoch takes whole blocks in that order, then documents of one more
block, up to the budget; hence per source one cut (block order, document
order) describes it.  Sorting draws by (block_order, doc_order) gives the
training order: blocks of all sources and epochs interleave at random.

Scale: nothing is gathered per source.  The cut is found by prefix sums over
1024 ranges of block orders, then over the blocks of one range, then over the
documents with tokens of one block.  What is known per source reaches the rows by
a broadcast while the table's names and numbers take at most ``MAX_BROADCAST_BYTES``
(measured).  Beyond it only sources with over 1 / ``HEAVY`` of all rows are broadcast,
so at most ``HEAVY``, and the rest meet their rows in a shuffle.

Defined cases: a null source is a source of its own; null, empty and blank
texts have no tokens, cost nothing and are given in every epoch of their
source; if no document has tokens each is drawn once; equal rows have equal
orders and are drawn alike; an empty table gives an empty result.  Only the
named columns are read; ``draw`` returns the document as one struct.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfarer.llm.common import stored

MAX_REPEATS, BLOCK_TOKENS, SEED = 4.0, 1_000_000, 42
MAX_BROADCAST_BYTES, HEAVY = 32 << 20, 1_000
_STEPS, _ROUNDS = 31, 8
_RANGE_BITS = 10


def _tokens(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _source(source: Column) -> Column:
    return F.struct(source.isNull().alias("none"), F.coalesce(source.cast("string"), F.lit("")).alias("name"))


def _doc_hash(doc_id: Column, text: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), doc_id.cast("string"), text)


def _block(h: Column, n_blocks: Column) -> Column:
    return F.pmod(h, n_blocks)


def _block_order(seed: int, epoch: Column, source: Column, block: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), epoch.cast("long"), source, block), 1)


def _doc_order(seed: int, epoch: Column, h: Column) -> Column:
    return F.xxhash64(F.lit(seed), epoch.cast("long"), h)


def _sum(x: Column) -> Column:
    """Sum in decimals, so that it does not depend on the order of the rows."""
    return F.sum(x.cast("decimal(38,18)"))


def _by_source(rows: DataFrame, known: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """``rows`` joined with ``known`` (stored, one row per source, with its number of rows ``docs``) on the source."""
    wide = 16 * len(known.columns)
    size, total = known.agg(F.sum(F.octet_length("s.name") + wide), F.sum("docs")).first()
    limit = MAX_BROADCAST_BYTES if max_bytes is None else max_bytes
    if (size or 0) <= limit:
        return rows.join(F.broadcast(known.drop("docs")), "s")
    heavy = known.where(F.col("docs") * HEAVY > F.lit(total)).drop("docs")
    light = rows.join(F.broadcast(heavy.select("s")), "s", "left_anti")
    return rows.join(F.broadcast(heavy), "s").unionByName(light.join(known.drop("docs"), "s"))


def exponent(shares: DataFrame, max_repeats: float | None = MAX_REPEATS, entropy: float | None = None,
             budget_share: float | None = None) -> float:
    """The exponent for ``shares(p)``; ``budget_share`` is the budget over all tokens, or None for the default budget."""
    n, least, most = shares.agg(F.count("*"), F.min("p"), F.max("p")).first()
    if n < 2 or least == most:
        return 1.0
    low, high = 0.0, 1.0

    def admissible(a: float, z: float, plogp: float) -> bool:
        # z = sum p^a, plogp = sum p^a ln p^a; w = p^a / z
        if entropy is not None:
            return math.log(z) - plogp / z >= entropy * math.log(n)
        budget = budget_share if budget_share is not None else z * most ** (1 - a)
        return budget * least ** (a - 1) / z <= max_repeats

    for _ in range(_ROUNDS):
        grid = [low + (high - low) * i / (_STEPS + 1) for i in range(_STEPS + 2)]
        sums = [float(x) for x in shares.agg(*[_sum(F.pow("p", F.lit(a))) for a in grid],
                                             *[_sum(F.pow("p", F.lit(a)) * F.log("p") * a) for a in grid]).first()]
        ok = [admissible(a, sums[i], sums[len(grid) + i]) for i, a in enumerate(grid)]
        if entropy is not None:  # true up to some exponent
            last = max((i for i, x in enumerate(ok) if x), default=0)
            low, high = grid[last], grid[min(last + 1, len(grid) - 1)]
        else:  # true from some exponent on
            first = min((i for i, x in enumerate(ok) if x), default=len(grid) - 1)
            low, high = grid[max(first - 1, 0)], grid[first]
    return round(low if entropy is not None else high, 9)


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         max_repeats: float | None = MAX_REPEATS, entropy: float | None = None, budget_tokens: int | None = None,
         block_tokens: int = BLOCK_TOKENS, seed: int = SEED, max_broadcast_bytes: int | None = None) -> DataFrame:
    """One row per source: source (struct none, name), tokens, docs, weight, budget, full (whole epochs), n_blocks,
    cut_block and cut_doc (the partial epoch's last block order, and the first document order beyond the budget)."""
    narrow = stored(docs.select(_source(F.col(source_col)).alias("s"), _tokens(F.col(text_col)).alias("n"),
                                _doc_hash(F.col(id_col), F.col(text_col), seed).alias("h")), "mix-docs")
    sources = stored(narrow.groupBy("s").agg(F.sum("n").alias("tokens"), F.count("*").alias("docs")), "mix-sources")
    total = sources.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    if not total:
        return sources.select("s", "tokens", "docs", F.lit(0.0).alias("weight"), F.lit(0).cast("long").alias("budget"),
                              F.lit(1).cast("long").alias("full"), F.lit(1).cast("long").alias("n_blocks"),
                              F.lit(None).cast("long").alias("cut_block"), F.lit(None).cast("long").alias("cut_doc"))
    shares = sources.where("tokens > 0").withColumn("p", F.col("tokens") / F.lit(total))
    a = exponent(shares, max_repeats, entropy, None if budget_tokens is None else budget_tokens / total)
    z, most = map(float, shares.agg(_sum(F.pow("p", F.lit(a))), F.max("p")).first())
    budget = budget_tokens if budget_tokens is not None else total * z * most ** (1 - a)
    p = F.col("tokens") / F.lit(total)
    weighted = (sources.withColumn("weight", F.when(F.col("tokens") > 0, F.pow(p, F.lit(a)) / z).otherwise(0.0))
                .withColumn("budget", F.round(F.col("weight") * budget).cast("long"))
                .withColumn("full", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.greatest("tokens", F.lit(1))))
                            .otherwise(1).cast("long"))
                .withColumn("rest", F.greatest(F.lit(0), F.col("budget") - F.col("full") * F.col("tokens")))
                .withColumn("n_blocks", F.greatest(F.lit(1), F.ceil(F.col("tokens") / block_tokens)).cast("long")))
    weighted = stored(weighted, "mix-weights")

    # the partial epoch's cut, by prefix sums over ranges, blocks and documents
    partial = weighted.where("rest > 0").select("s", "full", "rest", "n_blocks", "docs")
    blocks = stored(_by_source(narrow.where("n > 0"), partial, max_broadcast_bytes).withColumn("block", _block(F.col("h"), F.col("n_blocks")))
                    .groupBy("s", "full", "rest", "block").agg(F.sum("n").alias("n"))
                    .withColumn("order", _block_order(seed, F.col("full"), F.col("s"), F.col("block")))
                    .withColumn("range", F.shiftright("order", 63 - _RANGE_BITS)), "mix-blocks")

    def crossing(df: DataFrame, order: str, by: list[str]) -> DataFrame:
        """Per group the first row at which the running sum of n exceeds ``rest``, with the sum before it."""
        w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        run = df.withColumn("upto", F.sum("n").over(w)).where(F.col("upto") > F.col("rest"))
        return (run.groupBy(*by).agg(F.min(F.struct(order, F.col("rest") - (F.col("upto") - F.col("n")))).alias("x"))
                .select(*by, F.col(f"x.{order}").alias(order), F.col("x.col2").alias("rest")))

    ranges = blocks.groupBy("s", "full", "rest", "range").agg(F.sum("n").alias("n"))
    at_range = crossing(ranges, "range", ["s", "full"])
    at_block = crossing(blocks.drop("rest").join(at_range, ["s", "full", "range"]), "order", ["s", "full"])
    last = stored(at_block.join(blocks.select("s", "order", "block"), ["s", "order"])
                  .join(weighted.select("s", "n_blocks", "docs"), "s"), "mix-last-blocks")
    inside = (_by_source(narrow.where("n > 0"), last, max_broadcast_bytes)
              .where(_block(F.col("h"), F.col("n_blocks")) == F.col("block"))
              .groupBy("s", "full", "rest", _doc_order(seed, F.col("full"), F.col("h")).alias("doc")).agg(F.sum("n").alias("n")))
    cut = crossing(inside, "doc", ["s", "full"]).select("s", F.col("doc").alias("cut_doc"))
    return stored(weighted.drop("rest").join(last.select("s", F.col("order").alias("cut_block")), "s", "left")
                  .join(cut, "s", "left"), "mix-plan")


def _drawn(rows: DataFrame, planned: DataFrame, seed: int, *keep: str, max_bytes: int | None = None) -> DataFrame:
    """``keep`` columns of ``rows`` (with source s, tokens n and hash h) plus the struct ``mix``."""
    rows = (_by_source(rows, planned, max_bytes).withColumn("block", _block(F.col("h"), F.col("n_blocks")))
            .withColumn("last_block", _block_order(seed, F.col("full"), F.col("s"), F.col("block"))))
    more = (F.col("last_block") < F.col("cut_block")) | (
        (F.col("last_block") == F.col("cut_block")) & (_doc_order(seed, F.col("full"), F.col("h")) < F.col("cut_doc")))
    rows = rows.withColumn("epochs", F.col("full") + F.when(F.coalesce(more, F.lit(False)), 1).otherwise(0))
    draws = F.when(F.col("epochs") > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.col("epochs") - 1), lambda e: F.struct(
        e.alias("epoch"), _block_order(seed, e, F.col("s"), F.col("block")).alias("block_order"),
        _doc_order(seed, e, F.col("h")).alias("doc_order")))).otherwise(F.array().cast(
            "array<struct<epoch:bigint,block_order:bigint,doc_order:bigint>>"))
    return rows.select(*keep, F.struct(F.when(~F.col("s.none"), F.col("s.name")).alias("source"), F.col("n").alias("n_tokens"),
                                       "weight", "block", draws.alias("draws")).alias("mix"))


def draw(docs: DataFrame, planned: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source", seed: int = SEED, max_broadcast_bytes: int | None = None) -> DataFrame:
    """One row per document: the struct ``doc`` (its columns) and ``mix`` (source, n_tokens, weight, block,
    and ``draws``: an array of (epoch, block_order, doc_order), empty if it is not drawn)."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    body, doc_id, source = F.col(f"doc.`{text_col}`"), F.col(f"doc.`{id_col}`"), F.col(f"doc.`{source_col}`")
    return _drawn(packed.select("doc", _source(source).alias("s"), _tokens(body).alias("n"),
                                _doc_hash(doc_id, body, seed).alias("h")), planned, seed, "doc",
                  max_bytes=max_broadcast_bytes)


def manifest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED,
             **kw) -> DataFrame:
    """One row per draw: doc_id, source, n_tokens, weight, block, epoch, block_order, doc_order (texts do not move)."""
    planned = plan(docs, id_col, text_col, source_col, seed=seed, **kw)
    rows = docs.select(F.col(id_col).alias("doc_id"), _source(F.col(source_col)).alias("s"), _tokens(F.col(text_col)).alias("n"),
                       _doc_hash(F.col(id_col), F.col(text_col), seed).alias("h"))
    return (_drawn(rows, planned, seed, "doc_id", max_bytes=kw.get("max_broadcast_bytes")).select("doc_id", "mix.*").withColumn("d", F.explode("draws"))
            .select("doc_id", "source", "n_tokens", "weight", "block", "d.*"))
