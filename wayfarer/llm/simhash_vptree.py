"""SimHash near-duplicates through a vantage-point tree over Hamming distance.

Fingerprints: a bit is set if it is set in over half of the XXH64 hashes (seed
42) of a text's word shingles, repeats included.

Tree: every level has a vantage point, namely the level's group of bits of one
fixed 64-bit word, and splits by the Hamming distance of a fingerprint to it.
Distances over disjoint bit groups add up, so two fingerprints that differ in
at most t bits satisfy the triangle bounds of all levels together:
sum |d_g(x) - d_g(y)| <= t.  A fingerprint lives in the leaf named by its
distances; as a query it descends only into the leaves within that bound (all
others are pruned), and of two neighbouring leaves only the lower one sends
queries, so each pair meets exactly once.  Leaves are Spark shards.  A leaf
with more than ``leaf_rows`` homes and queries is split by the next tier
(4, 8, 16, then 32 vantage points), for homes and visiting queries alike, so a
dense cluster or a larger table only deepens the tree.  Inside a leaf all pairs
are verified by exact bit distance, and a spanning forest of the links leaves
the task: its size is linear even if every pair of the leaf is close.

Equal fingerprints are merged before the tree (pre-aggregated), so a group of
exact copies of any size is one point.

Defined cases: null, empty and blank texts have fingerprint zero and are
linked like any other; fewer words than the shingle length: the whole sequence
is the one shingle; null ids are kept as rows, but name a component only if it
has no other id (then null); repeated rows give repeated result rows; an empty
table gives an empty result.  Memory per row is proportional to its text.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfarer.llm.common import small_batches, stored
from wayfarer.llm.graph import connected_components

SEED = 42
#: The vantage points: each level takes its own group of these bits.
VANTAGE = 0x5DEECE66D1CE4E5B
TIERS = (4, 8, 16, 32)
_BLOCK = 1 << 15


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit fingerprint of one text, as a signed integer."""
    w = (text or "").encode().lower().split()  # bytes: ASCII letters and blanks only
    if not w:
        return 0
    k = min(shingle, len(w))
    grams = map(b" ".join, zip(*(w[i:] for i in range(k))))
    hashes = map(xxhash.xxh64_intdigest, grams, itertools.repeat(SEED))
    n, ones = len(w) - k + 1, np.zeros(64, dtype=np.int64)
    while len(block := np.fromiter(itertools.islice(hashes, _BLOCK), dtype=np.uint64)):
        bits = np.unpackbits(block.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">u8")[0].astype(np.uint64).view(np.int64))


def fingerprints(text: Column, shingle: int = 3) -> Column:
    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([fingerprint(t, shingle) for t in s], dtype="int64")

    return run(text)


# ---------------------------------------------------------------- the tree

def _signed(x: int) -> int:
    return (x + (1 << 63)) % (1 << 64) - (1 << 63)


def _steps(groups: int, max_bits: int) -> list[tuple[int, ...]]:
    """All distance changes over ``groups`` levels whose absolute values sum to at most ``max_bits``."""
    width, out = 64 // groups, [()]
    for _ in range(groups):
        out = [s + (d,) for s in out for d in range(-max_bits, max_bits + 1)
               if abs(d) <= width and sum(map(abs, s)) + abs(d) <= max_bits]
    return out


def _parent(step: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(a + b for a, b in zip(step[::2], step[1::2]))


def _forward(step: tuple[int, ...]) -> bool:
    """Of a step and its reverse exactly one is forward; children of a forward step are forward."""
    chain = [step]
    while len(chain[-1]) > TIERS[0]:
        chain.append(_parent(chain[-1]))
    first = next((d for s in reversed(chain) for d in s if d), 0)
    return first >= 0


def _tier_steps(max_bits: int) -> dict[int, list[tuple[int, ...]]]:
    return {g: [s for s in _steps(g, max_bits) if _forward(s)] for g in TIERS}


def _path(fp: Column, groups: int) -> Column:
    """The leaf of ``fp``: its distances to the tier's vantage points as digits of one long (at most 3^32)."""
    width = 64 // groups
    x, out = fp.bitwiseXOR(F.lit(_signed(VANTAGE))), F.lit(0).cast("long")
    for g in range(groups):
        d = F.bit_count(x.bitwiseAND(F.lit(_signed(((1 << width) - 1) << (g * width)))))
        out = out + d.cast("long") * F.lit((width + 1) ** g).cast("long")
    return out


def _packed(step: tuple[int, ...]) -> int:
    return sum(d * (64 // len(step) + 1) ** g for g, d in enumerate(step))


def _visits(rows: DataFrame, groups: int, steps: dict, max_bits: int) -> DataFrame:
    """(leaf, fp, home, step) of one tier; ``rows`` has fp, and from the second tier on the parent's step."""
    if groups == TIERS[0]:
        options = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(_packed(s)).cast("long").alias("by"))
                            for i, s in enumerate(steps[groups])])
    else:
        children: list[list] = [[] for _ in steps[groups // 2]]
        index = {s: i for i, s in enumerate(steps[groups // 2])}
        for i, s in enumerate(steps[groups]):
            children[index[_parent(s)]].append(f"{i}:{_packed(s)}")
        table = F.array(*[F.lit(",".join(c)) for c in children])
        options = F.transform(F.split(F.element_at(table, F.col("step") + 1), ","), lambda x: F.struct(
            F.element_at(F.split(x, ":"), 1).cast("int").alias("step"),
            F.element_at(F.split(x, ":"), 2).cast("long").alias("by")))
    home = next(i for i, s in enumerate(steps[groups]) if not any(s))
    return (rows.select("fp", F.explode(options).alias("o"))
            .select((_path(F.col("fp"), groups) + F.col("o.by")).alias("leaf"), "fp",
                    (F.col("o.step") == home).alias("home"), F.col("o.step").alias("step")))


def leaf_links(fps: np.ndarray, home: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links that a leaf owns: home to home, and home to visiting query."""
    rows = np.concatenate([fps[home], fps[~home]])
    nh, n = int(home.sum()), len(rows)
    if not nh or n < 2:
        return []
    touched = np.zeros(n, dtype=bool)
    step = max(1, (1 << 20) // n)
    for i in range(0, nh, step):
        near = np.bitwise_count(rows[i:min(i + step, nh), None] ^ rows[None, :]) <= max_bits
        near[np.arange(len(near)), i + np.arange(len(near))] = False
        touched |= near.any(axis=0)
        touched[i:i + len(near)] |= near.any(axis=1)
    free = np.flatnonzero(touched)  # homes first
    out: list[tuple[int, int]] = []
    while len(free) and free[0] < nh:
        queue, free = [free[0]], free[1:]
        while queue and len(free):
            at = queue.pop()
            reach = free if at < nh else free[:np.searchsorted(free, nh)]
            hit = np.bitwise_count(rows[reach] ^ rows[at]) <= max_bits
            if hit.any():
                found = reach[hit]
                out += [(int(rows[at].view(np.int64)), int(rows[j].view(np.int64))) for j in found]
                queue += found.tolist()
                free = np.concatenate([reach[~hit], free[len(reach):]])
    return out


def _link_leaves(max_bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def done(leaf, fp, home):
            cuts = np.flatnonzero(leaf[1:] != leaf[:-1]) + 1
            links = [x for a, b in zip([0, *cuts], [*cuts, len(leaf)]) if b - a > 1
                     for x in leaf_links(fp[a:b], home[a:b], max_bits)]
            return pd.DataFrame(links, columns=["u", "v"], dtype="int64")

        rest: list[np.ndarray] | None = None
        for pdf in batches:  # sorted by leaf, homes first; a leaf may span batches
            new = [pdf["leaf"].to_numpy(), pdf["fp"].to_numpy().view(np.uint64), pdf["home"].to_numpy(dtype=bool)]
            rest = new if rest is None else [np.concatenate(x) for x in zip(rest, new)]
            if not len(rest[0]):
                continue
            cut = int(np.searchsorted(rest[0], rest[0][-1]))
            if cut:
                yield done(*(x[:cut] for x in rest))
            stay = len(rest[0]) if rest[2][cut] else cut + 1  # a leaf without homes needs no more rows
            rest = [x[cut:stay] for x in rest]
        if rest is not None and len(rest[0]):
            yield done(*rest)

    return run


def near_links(fps: DataFrame, max_bits: int = 2, leaf_rows: int = 20_000) -> DataFrame:
    """Links (u, v) between distinct fingerprints ``fps(fp)``: a spanning forest per leaf of all pairs
    at most ``max_bits`` bits apart; their connected components are those of all such pairs."""
    steps = _tier_steps(max_bits)
    rows, links = fps.select("fp"), None
    for groups in TIERS:
        visits = _visits(rows, groups, steps, max_bits)
        crowded = None
        if groups != TIERS[-1]:
            crowded = stored(visits.groupBy("leaf").agg(F.count("*").alias("n"), F.max("home").alias("h"))
                             .where((F.col("n") > leaf_rows) & F.col("h")).select("leaf"), "crowded")
            if crowded.isEmpty():
                crowded = None
        calm = visits if crowded is None else visits.join(crowded, "leaf", "left_anti")
        found = (calm.select("leaf", "fp", "home").repartition("leaf").sortWithinPartitions("leaf", F.desc("home"))
                 .mapInPandas(_link_leaves(max_bits), "u long, v long"))
        links = found if links is None else links.unionByName(found)
        if crowded is None:
            break
        rows = stored(visits.join(crowded, "leaf", "left_semi").select("fp", "step"), "deeper")
    return links


def components_of(fp_rows: DataFrame, max_bits: int = 2) -> DataFrame:
    """(fp, component_id) for stored rows (doc_id, fp): the smallest doc_id reachable over near links."""
    firsts = stored(fp_rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fps")
    roots = connected_components(near_links(firsts, max_bits))
    named = firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    ids = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return named.join(ids, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``."""
    small_batches(docs.sparkSession)
    fp_rows = stored(docs.select(F.col(id_col).alias("doc_id"), fingerprints(F.col(text_col), shingle).alias("fp")),
                     "fingerprints")
    return (fp_rows.join(components_of(fp_rows, max_bits), "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
             max_bits: int = 2) -> DataFrame:
    """``docs`` without near-duplicates: of each group the row with the smallest id stays
    (rows without an id last; of rows with the same id an arbitrary but fixed one)."""
    small_batches(docs.sparkSession)
    rows = stored(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                              F.col(id_col).alias("doc_id"), fingerprints(F.col(text_col), shingle).alias("fp"),
                              F.monotonically_increasing_id().alias("row")), "simhash-docs")
    member = rows.select("doc_id", "fp", "row")
    # null components (groups without any id) are told apart by their root fingerprint
    best = (member.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("b")))
    firsts = stored(best, "fps")
    roots = connected_components(near_links(firsts, max_bits))
    stay = (firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
            .groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("b").alias("b")).select(F.col("b.row").alias("row")))
    return rows.join(stay, "row", "left_semi").select("doc.*")
