"""Near-duplicate passages by compact windows.

(After Peng et al., "Near-Duplicate Sequence Search at Scale", SIGMOD 2023.)
Tokens are hashes of five-word shingles.  In a text's Cartesian tree over values
of its tokens a node is a compact window (left, centre, right), and every
subsequence of it that holds the centre has the centre's value as its minimum.
Only windows of a least width are kept, so one row stands for a whole group of
subsequences.  Each text goes through once, copies are left out.

1. Shingles are counted over the texts, in sorted arrays dealt by their upper bits; those of two texts or more, and the frequent
   ones (more than ``rare`` texts) are broadcast as Bloom filters (bounded size; what
   they let through too much is treated alike in all texts).
2. Rare windows: the stretches of shared shingles are walked with values that put
   rare shingles before frequent ones, down to ``run`` shingles, so two texts with
   ``run`` shingles in a row in common have the same centre there.  All texts
   around a rare centre (``rare`` at most) meet, so no such pair is lost: near-duplicate
   passages that differ by words changed, put in, left out or moved hold
   21 shingles in a row in common at least, if the default thresholds are met.
   Centres outside every stretch of shared shingles that is long and dense enough
   to be a passage are left out, as no passage could be verified around them.
3. Frequent centres: only pairs whose common runs consist of frequent shingles
   alone are left, which is to say that more than ``rare`` texts hold each of
   them.  The windows of such runs have a centre in common too: all texts of
   that bucket meet its first text, and the first of their sub-bucket, and are candidates at once.
   They also meet under ``hashes`` min-hash functions, with windows of at least
   ``min_words`` words around a frequent centre.  Interval join: sorted by bucket (function and value) and by sub-bucket (a
   second min-hash of the centre's surroundings), windows stream past, and each
   meets the first text of its bucket and of its sub-bucket.
   Buckets of more than ``hot_rows`` windows are salted
   over several streams, whose first windows meet in a second round.  Pairs
   whose intervals have at least ``min_words`` words in common around the
   centres count; pairs of texts that meet under at least ``min_hashes``
   functions are candidates.  Exact repeats do not depend on that: every
   ``min_words``-word run of frequent shingles around a centre of the first function is a bucket of
   its own (hash of its shingles), whose texts all meet its first text and are
   candidates at once.  As a run lies around one centre, whose value is the same
   in all texts that hold the run, no exact repeat is lost.
4. Verification: in the region of a candidate's centres the exact shingles of
   both texts are compared; passages of at least ``min_words`` words with at
   least ``similarity`` of their shingles in common (Jaccard) are reported.

Whole texts that occur more than once are duplicates of each other as a whole
and go through the tree once.  Results are spans per document, merged, with the
smallest doc_id of their class (connected texts); copies are not expanded into
pairs.  Links inside a frequent bucket are searched against its first window and the
first of its sub-bucket, so two members may be linked through a third text;
near copies without an exact ``min_words``-word run in common are missed there if both
meet only texts that hold a shorter fragment of their passage.

Defined cases: words are lower-cased (A-Z) non-blank runs; null, empty, blank
and short texts (fewer than ``min_words`` words) have no passages; null ids are
kept as rows but never name a class unless it has no other id; repeated rows
are duplicates of each other and reported once per id; an empty table gives an
empty result.  Only the named columns are read.  Texts are identified by a
64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfarer.llm.common import ascii_lower, small_batches, stored, words
from wayfarer.llm.graph import connected_components

SHINGLE = 5
#: Buckets that shingles are counted in, each in one piece (8 bytes a shingle), and shingles of a frame dealt at once.
_BUCKETS = 4096
_FRAME = 1_000_000


@dataclass(frozen=True)
class Params:
    min_words: int = 50
    similarity: float = 0.8
    hashes: int = 4
    min_hashes: int = 2
    around: int = 16  # shingles on either side that name a sub-bucket
    margin: int = 64  # shingles beyond the outermost centres that are verified
    filter_bits: int = 1 << 27
    hot_rows: int = 200_000
    run: int = 15     # shingles in a row that two near-duplicate passages have in common at least
    rare: int = 16    # texts that hold a rare shingle at most; they all meet

    @property
    def least(self) -> int:
        return self.min_words - SHINGLE + 1


# ------------------------------------------------------------- windows

def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = x ^ np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(w: list[bytes]) -> np.ndarray:
    """One hash per five-word shingle."""
    h = np.fromiter(map(xxhash.xxh64_intdigest, w), dtype=np.uint64, count=len(w))
    n = len(h) - SHINGLE + 1
    if n <= 0:
        return h[:0]
    out = np.zeros(n, dtype=np.uint64)
    for k in range(SHINGLE):
        out = (out ^ h[k:k + n]) * np.uint64(0x100000001B3)
        out ^= out >> np.uint64(29)
    return out


def compact_windows(values: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(left, centre, right) of all windows of at least ``least`` values; of equal minima a middle one is
    the centre, so that repetitive texts split evenly."""
    out, stack = [], [(0, len(values))]
    while stack:
        left, right = stack.pop()
        if right - left < least:
            continue
        part = values[left:right]
        c = int(part.argmin())
        if right - left > 256:
            same = np.flatnonzero(part == part[c])
            c = int(same[len(same) // 2])
        c += left
        out.append((left, c, right - 1))
        stack.append((left, c))
        stack.append((c + 1, right))
    return out


def _text_windows(base: np.ndarray, params: Params) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per hash function: its number, the values of the windows' centres, and the windows as (n, 3) array."""
    for i in range(params.hashes):
        values = _mix(base, i)
        w = np.array(compact_windows(values, params.least), dtype=np.int64).reshape(-1, 3)
        yield i, values[w[:, 1]], w


def _frames(rows: Iterator[dict]) -> Iterator[pd.DataFrame]:
    """Frames of about 100,000 rows from many small sets of equally long columns."""
    held: list[dict] = []
    n = 0

    def frame() -> pd.DataFrame:
        return pd.DataFrame({k: np.concatenate([np.broadcast_to(h[k], h["n"]) for h in held]) for k in held[0] if k != "n"})

    for r in rows:
        held.append(r)
        n += r["n"]
        if n >= 100_000:
            yield frame()
            held, n = [], 0
    if n:
        yield frame()


def _run_hashes(base: np.ndarray, least: int) -> np.ndarray:
    """One hash per run of ``least`` shingles."""
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_mix(base, 500), dtype=np.uint64)])
    return sums[least:] - sums[:-least]


def _deal_shingles(params: Params):
    """Rows (bucket, vs): per frame of texts its sorted shingles, dealt to buckets by their upper bits; one that
    several texts of a frame hold is written as often, but no more than ``rare`` + 1 times, as larger counts are not told apart."""
    def frame(held: list[np.ndarray]) -> pd.DataFrame:
        v, n = np.unique(np.concatenate(held), return_counts=True)
        v = np.repeat(v, np.minimum(n, params.rare + 1))
        cuts = np.searchsorted(v, np.arange(1, _BUCKETS, dtype=np.uint64) * np.uint64(2 ** 64 // _BUCKETS))
        ends = np.concatenate([[0], cuts, [len(v)]])
        full = np.flatnonzero(ends[1:] > ends[:-1])
        data = v.tobytes()
        return pd.DataFrame({"bucket": full.astype(np.int32), "vs": [data[8 * ends[b]:8 * ends[b + 1]] for b in full]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for pdf in batches:
            for text in pdf["text"]:
                base = shingle_hashes(text.encode().lower().split())
                if len(base) >= params.least:
                    held.append(np.unique(base))
                    n += len(held[-1])
                if n >= _FRAME:
                    yield frame(held)
                    held, n = [], 0
        if n:
            yield frame(held)

    return run


def _shared_of_buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(v, n) of the shingles that are held more than once, from rows sorted by bucket, a bucket at a time."""
    def counted(held: list[bytes]) -> pd.DataFrame:
        v, n = np.unique(np.frombuffer(b"".join(held), dtype=np.uint64), return_counts=True)
        return pd.DataFrame({"v": v[n > 1].view(np.int64), "n": n[n > 1]})

    held, now = [], None
    for pdf in batches:
        for bucket, vs in zip(pdf["bucket"], pdf["vs"]):
            if bucket != now and held:
                yield counted(held)
                held = []
            now = bucket
            held.append(vs)
    if held:
        yield counted(held)


def shared_shingles(texts: DataFrame, params: Params) -> DataFrame:
    """(v, n): the shingles that two texts or more hold, and in how many; above ``rare`` n says only that it is more."""
    return (texts.mapInPandas(_deal_shingles(params), "bucket int, vs binary").repartition("bucket").sortWithinPartitions("bucket")
            .mapInPandas(_shared_of_buckets, "v long, n long"))


def _bit_places(v: np.ndarray, bits: int) -> list[np.ndarray]:
    u = _mix(v.view(np.uint64), 77)
    return [(u & np.uint64(bits - 1)).astype(np.int64), ((u >> np.uint64(32)) & np.uint64(bits - 1)).astype(np.int64)]


def _bitmap(keys: DataFrame, bits: int) -> np.ndarray:
    """Bloom filter of ``keys(v)``: built by 64 tasks as slices, ``bits`` bits whatever the keys' number
    (more keys let more others through, which costs time, not results)."""
    slice_bits = bits // 64

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            at = np.unique(np.concatenate(_bit_places(pdf["v"].to_numpy(), bits)))
            yield pd.DataFrame({"slice": at // slice_bits, "at": at % slice_bits})

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        part = np.zeros(slice_bits, dtype=bool)
        part[pdf["at"].to_numpy()] = True
        return pd.DataFrame({"slice": [int(pdf["slice"].iloc[0])], "bits": [np.packbits(part).tobytes()]})

    built = (keys.mapInPandas(places, "slice long, at long").distinct()
             .groupBy("slice").applyInPandas(build, "slice long, bits binary").toPandas())
    out = np.zeros(bits // 8, dtype=np.uint8)
    for s, b in zip(built["slice"], built["bits"]):
        out[s * slice_bits // 8:(s + 1) * slice_bits // 8] = np.frombuffer(b, dtype=np.uint8)
    return out


def _in_bitmap(v: np.ndarray, bits: np.ndarray) -> np.ndarray:
    keep = np.ones(len(v), dtype=bool)
    for at in _bit_places(v, len(bits) * 8):
        keep &= (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
    return keep


def _passes(bitmap):
    """Column function: may the key be in the broadcast bitmap?"""
    @F.pandas_udf("boolean")
    def passes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for v in batches:
            yield pd.Series(_in_bitmap(v.to_numpy(), bitmap.value))

    return passes


_WINDOW = "v long, u long, fn int, tid long, c int, before int, after int"


def _shared_frame(held: list[tuple], params: Params) -> pd.DataFrame:
    """The windows of the texts in ``held`` (text id, shingles, values, functions, windows, frequent shingles) with a frequent centre."""
    per_text = [len(h[2]) for h in held]
    text = np.repeat(np.arange(len(held)), per_text)
    v = np.concatenate([h[2] for h in held]).view(np.int64)
    keep = np.flatnonzero(np.concatenate([h[5][h[4][:, 1]] for h in held]))
    text, v = text[keep], v[keep]
    fn = np.concatenate([h[3] for h in held])[keep]
    w = np.concatenate([h[4] for h in held])[keep]
    # second min-hash of the surroundings, gathered from the joined shingle arrays
    base = np.concatenate([h[1] for h in held])
    ends = np.cumsum([len(h[1]) for h in held])
    start = (ends - [len(h[1]) for h in held])[text]
    at = (start + w[:, 1])[:, None] + np.arange(-params.around, params.around + 1)
    near = base[np.clip(at, start[:, None], (ends[text] - 1)[:, None])]
    u = np.zeros(len(v), dtype=np.uint64)
    for i in range(params.hashes):
        mine = fn == i
        u[mine] = _mix(near[mine], 1000 + i).min(axis=1, initial=np.iinfo(np.uint64).max)
    tids = np.array([h[0] for h in held], dtype=np.int64)
    windows = pd.DataFrame({"v": v, "u": u.view(np.int64), "fn": fn, "tid": tids[text],
                            "c": w[:, 1], "before": w[:, 1] - w[:, 0], "after": w[:, 2] - w[:, 1]})
    # the runs around the first function's centres, under the number after the last function's
    one = np.flatnonzero(fn == 0)
    if not len(one):
        return windows
    low = np.maximum(w[one, 0], w[one, 1] - params.least + 1)
    n = np.minimum(w[one, 1], w[one, 2] - params.least + 1) - low + 1
    at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
    whole = np.concatenate([[0], np.cumsum(np.concatenate([h[5] for h in held]))])
    first = np.repeat(start[one], n) + at
    of = np.repeat(tids[text[one]], n)
    all_frequent = whole[first + params.least] - whole[first] == params.least
    first, at, of = first[all_frequent], at[all_frequent], of[all_frequent]
    run = _run_hashes(base, params.least)[first]
    runs = pd.DataFrame({"v": run.view(np.int64), "u": 0, "fn": np.int32(params.hashes), "tid": of,
                         "c": at + params.least // 2, "before": params.least, "after": params.least})
    return pd.concat([windows, runs], ignore_index=True)


def _covered(match: np.ndarray, share: float, least: int) -> np.ndarray:
    """Which shingles lie in any stretch of at least ``least`` shingles that holds at least ``share`` matches."""
    sums = np.concatenate([[0.0], np.cumsum(match - share)])
    high = np.maximum.accumulate(sums[::-1])[::-1]
    starts = np.arange(len(match))
    ends = np.searchsorted(-high, 1e-9 - sums[:-1], side="right") - 1   # the farthest end of each start
    ok = ends - starts >= least
    edge = np.zeros(len(match) + 1, dtype=np.int64)
    edge[:-1] += ok
    np.subtract.at(edge, ends[ok], 1)
    return np.cumsum(edge[:-1]) > 0


def _run_windows(base: np.ndarray, shared: np.ndarray, often: np.ndarray, dense: np.ndarray, params: Params) -> tuple[np.ndarray, np.ndarray]:
    """Values and centres of the windows of ``run`` shared shingles, the rarest one of each being the centre, as far as it
    is ``dense``; of a value's repeats the first and the last."""
    order = (_mix(base, 2000) >> np.uint64(1)) | (often.astype(np.uint64) << np.uint64(63))
    at = [s + c for s, e in _runs(shared, params.run) for _, c, _ in compact_windows(order[s:e], params.run)]
    at = np.sort(np.array([c for c in at if dense[c]], dtype=np.int64))
    v = base[at].view(np.int64)
    first, last = np.unique(v, return_index=True)[1], len(v) - 1 - np.unique(v[::-1], return_index=True)[1]
    at = at[np.union1d(first, last).astype(np.int64)]
    return base[at].view(np.int64), at


def _surroundings(base: np.ndarray, at: np.ndarray, params: Params) -> np.ndarray:
    """A min-hash of the shingles around each centre, which names its sub-bucket."""
    near = base[np.clip(at[:, None] + np.arange(-params.around, params.around + 1), 0, len(base) - 1)]
    return _mix(near, 1000 + params.hashes + 1).min(axis=1, initial=np.iinfo(np.uint64).max).view(np.int64)


def _shared_windows(shared, often, params: Params):
    """Rare windows under the number -1; of texts with a run of frequent shingles also the windows of such a run under the
    number after that of exact runs, the windows of all functions around a frequent shingle, and the exact runs of such shingles."""
    share = 2 * params.similarity / (1 + params.similarity)     # as in ``passages``

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rare, n = [], [], 0

        def frame() -> pd.DataFrame:
            parts = [_shared_frame(held, params)] if held else []
            if rare:
                sizes = [len(r[1]) for r in rare]
                parts.append(pd.DataFrame({
                    "v": np.concatenate([r[1] for r in rare]), "u": np.concatenate([r[3] for r in rare]),
                    "fn": np.repeat(np.array([r[4] for r in rare], dtype=np.int32), sizes), "tid": np.repeat(np.array([r[0] for r in rare], dtype=np.int64), sizes),
                    "c": np.concatenate([r[2] for r in rare]), "before": params.least, "after": params.least}))
            return pd.concat(parts, ignore_index=True)

        for pdf in batches:
            for tid, text in zip(pdf["tid"], pdf["text"]):
                base = shingle_hashes(text.encode().lower().split())
                if len(base) < params.least:
                    continue
                key = base.view(np.int64)
                held_by_two = _in_bitmap(key, shared.value)
                if not _runs(held_by_two, params.run):
                    continue
                # a passage that another text holds too is a dense stretch of shared shingles: nothing else can be verified
                dense = _covered(held_by_two, share, params.least)
                if not dense.any():
                    continue
                frequent = held_by_two & _in_bitmap(key, often.value)
                v, at = _run_windows(base, held_by_two, frequent, dense, params)
                often_there = frequent[at]
                for number, mine in ((-1, ~often_there), (params.hashes + 1, often_there)):
                    if mine.any():
                        u = _surroundings(base, at[mine], params) if number > 0 else np.zeros(mine.sum(), dtype=np.int64)
                        rare.append((tid, v[mine], at[mine], u, number))
                        n += len(u)
                if _runs(frequent, params.run):
                    found = list(_text_windows(base, params))
                    fn = np.repeat(np.array([f[0] for f in found], dtype=np.int32), [len(f[1]) for f in found])
                    held.append((tid, base, np.concatenate([f[1] for f in found]), fn, np.concatenate([f[2] for f in found]), frequent))
                    n += len(fn)
                if n >= 50_000:
                    yield frame()
                    held, rare, n = [], [], 0
        if n:
            yield frame()

    return run


# ------------------------------------------------------------- candidates

def _text_id(text: Column) -> Column:
    return F.xxhash64(text)


_PAIR = "a long, b long, fns int, a_from int, b_from int"


def _firsts(tid: np.ndarray, starts: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Per row the position of its group's first row with the group's smallest text id."""
    least = np.minimum.reduceat(tid, starts)
    at = np.flatnonzero(tid == least[group])
    return at[np.searchsorted(group[at], np.arange(len(starts)))][group]


def _meet(pdf: pd.DataFrame, params: Params) -> tuple[pd.DataFrame, np.ndarray]:
    """Pairs of whole buckets (rows sorted by bucket and sub-bucket), and the positions of their first rows."""
    v, fn, u, tid = (pdf[c].to_numpy() for c in ("v", "fn", "u", "tid"))
    c, before, after = (pdf[x].to_numpy() for x in ("c", "before", "after"))
    new = np.concatenate([[True], (v[1:] != v[:-1]) | (fn[1:] != fn[:-1])])
    if "salt" in pdf:
        salt = pdf["salt"].to_numpy()
        new[1:] |= salt[1:] != salt[:-1]
    firsts = []
    for cut in (new, new | np.concatenate([[True], u[1:] != u[:-1]])):
        starts = np.flatnonzero(cut)
        firsts.append(_firsts(tid, starts, np.cumsum(cut) - 1))
    out = []
    for k, first in enumerate(firsts):
        ok = ((tid != tid[first]) & (np.minimum(before, before[first]) + np.minimum(after, after[first]) + 1 >= params.least))
        if k:
            ok &= first != firsts[0]
        out.append(pd.DataFrame({"a": tid[first][ok], "b": tid[ok], "fns": (1 << fn[ok]).astype(np.int32),
                                 "a_from": c[first][ok], "b_from": c[ok]}))
    return pd.concat(out, ignore_index=True), np.unique(np.concatenate(firsts))


def _stream(params: Params, emit):
    """Feed ``emit`` with whole buckets of the sorted input; a bucket of exact runs goes piece by piece, each with its first row."""
    keys = ["v", "fn"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in batches:
            rest = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            if not len(rest):
                continue
            by = keys + (["salt"] if "salt" in rest else [])
            last = np.ones(len(rest), dtype=bool)
            for k in by:
                last &= rest[k].to_numpy() == rest[k].iloc[-1]
            cut = int(np.flatnonzero(last)[0])
            if cut:
                yield emit(rest.iloc[:cut])
                rest = rest.iloc[cut:].reset_index(drop=True)
            if rest["fn"].iloc[0] == params.hashes and len(rest) > 1:
                yield emit(rest)
                rest = rest.iloc[:1]
        if rest is not None and len(rest):
            yield emit(rest)

    return run


def _meet_all(windows: DataFrame, params: Params) -> DataFrame:
    by = ["v", "fn"]
    return (windows.repartition(*by).sortWithinPartitions(*by, "u", "tid")
            .mapInPandas(_stream(params, lambda w: _meet(w, params)[0]), _PAIR))


def candidate_pairs(texts: DataFrame, params: Params) -> DataFrame:
    """(a, b, a_from, a_to, b_from, b_to): pairs of text ids with the range of their common centres.

    ``texts``: (tid, text) without nulls, each text once.
    """
    sc = texts.sparkSession.sparkContext
    counts = stored(shared_shingles(texts, params), "shared-shingles")
    shared, often = (sc.broadcast(_bitmap(counts.where(F.col("n") > least).select("v"), params.filter_bits)) for least in (1, params.rare))
    windows = stored(texts.mapInPandas(_shared_windows(shared, often, params), _WINDOW), "windows")
    rare = (windows.where("fn = -1").groupBy("v").agg(F.collect_list(F.struct("tid", "c")).alias("held"))
            .select(F.explode("held").alias("x"), "held").select("x", F.explode(F.filter("held", lambda y: y["tid"] > F.col("x.tid"))).alias("y"))
            .select(F.col("x.tid").alias("a"), F.col("y.tid").alias("b"), F.lit(1 << params.hashes).alias("fns"),
                    F.col("x.c").alias("a_from"), F.col("y.c").alias("b_from")))
    windows = windows.where("fn >= 0")
    hot = stored(windows.groupBy("v").agg(F.count("*").alias("n")).where(F.col("n") > params.hot_rows)
                 .select("v", F.ceil(F.col("n") / params.hot_rows).cast("int").alias("salts")), "hot-windows")
    if hot.isEmpty():
        pairs = _meet_all(windows, params)
    else:
        calm = windows.join(hot, "v", "left_anti")
        salted = stored(windows.join(hot, "v").withColumn("salt", F.pmod(F.xxhash64("tid"), F.col("salts"))).drop("salts"), "salted")
        by = ["v", "fn", "salt"]
        sorted_rows = salted.repartition(*by).sortWithinPartitions(*by, "u", "tid")
        near = sorted_rows.mapInPandas(_stream(params, lambda w: _meet(w, params)[0]), _PAIR)
        heads = sorted_rows.mapInPandas(_stream(params, lambda w: w.iloc[_meet(w, params)[1]].drop(columns="salt")), _WINDOW)
        pairs = _meet_all(calm, params).unionByName(near).unionByName(_meet_all(heads, params))
    return (pairs.select("a", "b", "fns", "a_from", "b_from").unionByName(rare).groupBy("a", "b").agg(
        F.bit_or("fns").alias("fns"), F.min("a_from").alias("a_from"), F.max("a_from").alias("a_to"),
        F.min("b_from").alias("b_from"), F.max("b_from").alias("b_to"))
        .where((F.bit_count("fns") >= params.min_hashes) | (F.col("fns") >= 1 << params.hashes)).drop("fns"))


# ------------------------------------------------------------- verification

def _runs(match: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Stretches [s, e) of at least ``least`` matches without a miss."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], match.astype(np.int8), [0]])))
    return [(int(s), int(e)) for s, e in zip(edge[::2], edge[1::2]) if e - s >= least]


def _dense_spans(match: np.ndarray, share: float, least: int) -> list[tuple[int, int]]:
    """Disjoint stretches [s, e) of at least ``least`` shingles that begin and end in a match and hold at least ``share`` matches.

    The longest one of all, then the longest ones to its left and right.  With the
    sums of (match - share) a stretch is dense if its end is no lower than its
    start: starts are the running minima, and the farthest end of each is found
    in the running maxima from the right.
    """
    out, todo = [], [(0, len(match))]
    while todo:
        lo, hi = todo.pop()
        here = match[lo:hi]
        if np.count_nonzero(here) < share * least:
            continue
        sums = np.concatenate([[0.0], np.cumsum(here - share)])
        at = np.where(here, sums[:-1], np.inf)
        starts = np.flatnonzero(at < np.concatenate([[np.inf], np.minimum.accumulate(at)[:-1]]))
        high = np.maximum.accumulate(np.where(here, sums[1:], -np.inf)[::-1])[::-1]
        ends = np.searchsorted(-high, 1e-9 - sums[starts], side="right")
        best = int(np.argmax(ends - starts))
        s, e = lo + int(starts[best]), lo + int(ends[best])
        if e - s >= least:
            out.append((s, e))
            todo += [(lo, s), (e, hi)]
    return sorted(out)


def _halves(match: np.ndarray, span: tuple[int, int], least: int) -> list[tuple[int, int]]:
    """A stretch cut at its longest gap, as far as the parts are long enough."""
    s, e = span
    edge = np.flatnonzero(np.diff(np.concatenate([[0], (~match[s:e]).astype(np.int8), [0]])))
    gaps = list(zip(edge[::2], edge[1::2]))
    if not gaps:
        return []
    x, y = max(gaps, key=lambda g: g[1] - g[0])
    return [(u, v) for u, v in ((s, s + int(x)), (s + int(y), e)) if v - u >= least]


def passages(wa: list[bytes], wb: list[bytes], params: Params) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Word spans [from, to) of the near-duplicate passages that two word lists share.

    Stretches with enough shingles in common are compared as sets; one that fails
    is cut at its longest gap and its parts are compared, so that two
    passages near each other in one text only are found too.  Exact
    repeats stand in any case.
    """
    a, b = shingle_hashes(wa), shingle_hashes(wb)
    hashes, match = (a, b), (np.isin(a, b), np.isin(b, a))
    # two stretches with share s of their shingles in common have Jaccard s / (2 - s)
    share = 2 * params.similarity / (1 + params.similarity)
    new = [_dense_spans(m, share, params.least) for m in match]
    if not new[0] or not new[1]:
        return [], []
    pool: tuple[list, list] = ([], [])      # (span, shingles) of all stretches so far
    good: tuple[set, set] = (set(), set())

    def verified(mine: set, others: list) -> bool:
        """Near-duplicate of a span of the other text, or held inside a longer common stretch there."""
        for _, o in others:
            common = len(mine & o)
            if common >= params.similarity * len(mine) or common >= params.similarity * (len(mine) + len(o) - common):
                return True
        return False

    failed = False
    while new[0] or new[1]:
        for k in (0, 1):
            pool[k].extend((x, set(hashes[k][x[0]:x[1]].tolist())) for x in new[k])
        for k in (0, 1):
            good[k].update(x for x, mine in pool[k] if x not in good[k] and verified(mine, pool[1 - k]))
        left = [[x for x in new[k] if x not in good[k]] for k in (0, 1)]
        failed |= bool(left[0] or left[1])
        new = [[part for x in left[k] for part in _halves(match[k], x, params.least)] for k in (0, 1)]
    ok = [sorted(g) for g in good]
    runs = [_run_hashes(h, params.least) for h in hashes] if failed else ([], [])  # a run lies inside a stretch
    for k in (0, 1) if failed else ():
        ok[k] += [(s, e) for s, e in ((s, e + params.least - 1) for s, e in _runs(np.isin(runs[k], runs[1 - k]), 1))
                  if not any(x <= s and e <= y for x, y in ok[k])]
    if not ok[0] or not ok[1]:
        return [], []
    return tuple([(s, e + SHINGLE - 1) for s, e in side] for side in ok)


def _verify(params: Params):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for a, b, at_a, at_b, wa, wb in zip(pdf["a"], pdf["b"], pdf["at_a"], pdf["at_b"], pdf["wa"], pdf["wb"]):
                sa, sb = passages(wa.encode().split(), wb.encode().split(), params)
                out += [(a, a, b, at_a + s, at_a + e) for s, e in sa] + [(b, a, b, at_b + s, at_b + e) for s, e in sb]
            yield pd.DataFrame(out, columns=["tid", "a", "b", "from", "to"])

    return run


def _cut(text: Column, low: Column, high: Column, params: Params) -> tuple[Column, Column]:
    """First word and words (space-joined) of the region around the centres."""
    first = F.greatest(low - params.margin, F.lit(0))
    return first, F.array_join(F.slice(words(ascii_lower(text)), first + 1, high + params.margin + SHINGLE - first), " ")


def verified_spans(texts: DataFrame, pairs: DataFrame, params: Params) -> DataFrame:
    """(tid, a, b, from, to): verified passages of candidate pairs, word offsets of text ``tid``."""
    pairs = stored(pairs, "pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("v")).distinct()
    bitmap = texts.sparkSession.sparkContext.broadcast(_bitmap(ids, params.filter_bits))

    # texts that no pair needs stay where they are; one row per distinct text
    needed = texts.where(_passes(bitmap)("tid")).groupBy("tid").agg(F.first("text").alias("text"))
    at, wa = _cut(F.col("text"), F.col("a_from"), F.col("a_to"), params)
    half = pairs.join(needed.withColumnRenamed("tid", "a"), "a").select(
        "a", "b", "b_from", "b_to", at.alias("at_a"), wa.alias("wa"))
    at, wb = _cut(F.col("text"), F.col("b_from"), F.col("b_to"), params)
    both = half.join(needed.withColumnRenamed("tid", "b"), "b").select("a", "b", "at_a", at.alias("at_b"), "wa", wb.alias("wb"))
    return both.mapInPandas(_verify(params), "tid long, a long, b long, from int, to int")


def duplicate_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       params: Params = Params()) -> DataFrame:
    """(doc_id, from_word, to_word, class_id): merged spans [from, to) of repeated passages."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where(F.length("text") >= 2 * params.min_words - 1)
    texts = rows.select(_text_id(F.col("text")).alias("tid"), "text")

    # whole texts that occur more than once; only their words are counted
    members = stored(rows.select("doc_id", _text_id(F.col("text")).alias("tid")), "members")
    named_texts = stored(members.groupBy("tid").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies")), "texts")
    copied = stored(named_texts.where("copies > 1").select("tid"), "copied")
    bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(copied.select(F.col("tid").alias("v")), params.filter_bits))
    once = texts.where(~_passes(bitmap)("tid")).unionByName(
        stored(texts.where(_passes(bitmap)("tid")).groupBy("tid").agg(F.first("text").alias("text")), "copied-texts"))
    spans = stored(verified_spans(once, candidate_pairs(once, params), params), "spans")
    n_words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    whole = (texts.where(_passes(bitmap)("tid")).select("tid", n_words.alias("to")).groupBy("tid").agg(F.max("to").alias("to"))
             .where(F.col("to") >= params.min_words).join(copied, "tid", "left_semi").select("tid", F.lit(0).alias("from"), "to"))
    roots = connected_components(spans.select(F.col("a").alias("u"), F.col("b").alias("v")).distinct())
    named = named_texts.join(roots.withColumnRenamed("node", "tid"), "tid", "left").withColumn("root", F.coalesce("root", "tid"))
    classes = named.join(named.groupBy("root").agg(F.min("first_id").alias("class_id")), "root").select("tid", "class_id")

    all_spans = (spans.select("tid", "from", "to")
                 .unionByName(whole)
                 .groupBy("tid", "from").agg(F.max("to").alias("to")))  # at most one row per word of a text
    before = Window.partitionBy("tid").orderBy("from").rowsBetween(Window.unboundedPreceding, -1)
    island = Window.partitionBy("tid").orderBy("from").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    merged = (all_spans.withColumn("new", (F.coalesce(F.max("to").over(before), F.lit(-1)) < F.col("from")).cast("int"))
              .withColumn("island", F.sum("new").over(island)).groupBy("tid", "island")
              .agg(F.min("from").alias("from_word"), F.max("to").alias("to_word")))
    return (members.select("doc_id", "tid").join(merged.drop("island"), "tid").join(classes, "tid")
            .select("doc_id", F.col("from_word").cast("long").alias("from_word"), F.col("to_word").cast("long").alias("to_word"), "class_id"))
