"""Spelling variants: words one edit apart, grouped under their most frequent form.

Method: search schemes on a bidirectional FM-index over the delimited vocabulary.
A near word keeps one half of the word: the first half is matched exactly and the
second crossed with one error, then the other way round.  A match is a pair
of suffix-rank intervals (of the text and of its reverse) kept in step, so it can
grow at both ends; grown to the delimiters it is one word.  A near word found
by the second scheme that keeps the first half too was found by the first and is left out.

The vocabulary is cut into shards by what such halves must share: the first (second
scheme: last) 2, 4, 6 ... characters, as many as fit into half the word.  Shards
hold about ``SHARD`` words; a key with more is split into parts, and its
words are looked up in each part.  No pairs leave a shard, only each word's count
of near words and the best of them.

Defined cases: a null text has no words; a null id counts as empty text; an empty
table gives no rows; other columns are not read.  Long runs are words like others.
A task holds one shard with its two indexes, or one Arrow batch of the aggregation.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfarer.llm.common import ascii_lower, stored

#: Words a shard holds at most on average.
SHARD = 40_000
#: Queries that are searched together.
TOGETHER = 20_000
_BLOCK = 64  # positions between two stored counts
_END = 0  # the delimiter, smaller than all letters


def corrupted_runs(docs: DataFrame) -> DataFrame:
    """(run): letter runs of all texts, A-Z lower-cased; where 97 divides the CRC-32 h of ``<doc_id>:<run>``, without code point h % length."""
    lower = ascii_lower(F.col("text"))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.split(lower, "[^a-zÀ-ÿ]+")).alias("run")).where("run <> ''")
    h = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    cut = (F.col("h") % F.length("run")).cast("int")
    return h.select(F.when(F.col("h") % 97 == 0, F.concat(F.substring("run", F.lit(1), cut), F.substring("run", cut + 2, F.length("run"))))
                    .otherwise(F.col("run")).alias("run"))


def vocabulary(runs: DataFrame, least_length: int = 5, least_count: int = 3) -> DataFrame:
    """(word, n) of the runs with at least ``least_length`` code points and ``least_count`` occurrences."""
    return (runs.where(F.length("run") >= least_length).groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n"))
            .where(F.col("n") >= least_count))


def _index(text: list[np.ndarray], sigma: int) -> dict:
    """FM-index of sorted distinct words, each with the delimiter in front and behind."""
    k, lengths = len(text), np.array([len(w) for w in text])
    n = int(lengths.sum()) + k + 1
    t = np.zeros(n, np.uint8)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    letters = np.ones(n, bool)
    letters[starts] = False
    t[letters] = np.concatenate(text)
    # suffix ranks by doubling; delimiters rank by word (the closing one first), so every tie ends at one
    rank = t.astype(np.int64) + k
    rank[starts] = np.append(np.arange(1, k + 1), 0)
    step = 1
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[:-step] = rank[step:]
        key = rank * (n + sigma + 2) + ahead
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        key = key[order]
        new[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        rank, step = new, step * 2
        if rank[order[-1]] == n - 1 or step >= n:
            break
    blocks = n // _BLOCK + 1
    bwt = np.full(blocks * _BLOCK, 255, np.uint8)
    bwt[:n] = t[order - 1]
    counts = np.zeros((blocks + 1, sigma + 1), np.int64)
    filled = np.arange(n) // _BLOCK
    np.add.at(counts, (filled + 1, bwt[:n]), 1)
    before = np.cumsum(counts, 0)
    smaller = np.cumsum(before, 1) - before
    return {"bwt": bwt.reshape(blocks, _BLOCK), "before": before, "smaller": smaller, "first": smaller[-1].copy()}


def _count(index: dict, at: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often ``c``, and anything smaller, stands in the transform before ``at``."""
    block = at // _BLOCK
    rows = index["bwt"][block]
    ahead = np.arange(_BLOCK) < (at % _BLOCK)[:, None]
    same = ((rows == c[:, None]) & ahead).sum(1)
    less = ((rows < c[:, None]) & ahead).sum(1)
    return index["before"][block, c] + same, index["smaller"][block, c] + less


def _extend(indexes: tuple, right: bool, state: tuple, c: np.ndarray) -> tuple:
    """Grow matches (query, start in the text's ranks, start in the reverse's, size) by ``c`` at one end; those that vanish go."""
    q, f, r, s = state
    index, own, other = (indexes[1], r, f) if right else (indexes[0], f, r)
    low, low_less = _count(index, own, c)
    high, high_less = _count(index, own + s, c)
    own, other, s = index["first"][c] + low, other + high_less - low_less, high - low
    live = s > 0
    f, r = (other, own) if right else (own, other)
    return q[live], f[live], r[live], s[live]


def _join(states: list[tuple]) -> tuple:
    return tuple(np.concatenate(x) for x in zip(*states))


def _next_letters(index: dict, own: np.ndarray, s: np.ndarray, sigma: int) -> tuple[np.ndarray, np.ndarray]:
    """(state, letter) for the letters that can follow: read off small intervals, all letters for large ones."""
    small = np.flatnonzero(s <= _BLOCK)
    sizes = s[small]
    rows = np.repeat(own[small], sizes) + np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    pairs = np.unique(np.repeat(small, sizes) * 256 + index["bwt"].reshape(-1)[rows])
    large = np.flatnonzero(s > _BLOCK)
    pairs = np.concatenate([pairs, (large[:, None] * 256 + np.arange(1, sigma + 1)).reshape(-1)])
    pairs = pairs[pairs % 256 != _END]
    return pairs // 256, pairs % 256


def _search(indexes: tuple, words: np.ndarray, sigma: int, right: bool, n_text: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, text row) of all words one edit away from ``words`` (a matrix of equal lengths).

    ``right``: the first half is matched, then the second crossed rightwards; else the mirror image.
    """
    count, length = words.shape
    half = length // 2

    def everywhere(v: int) -> np.ndarray:
        return np.full(count, v, np.int64)

    def follow(state: tuple, letters: np.ndarray, to_right: bool) -> tuple:
        """Exact match of whole columns, from the middle outwards."""
        for column in letters.T:
            state = _extend(indexes, to_right, state, column[state[0]])
        return _extend(indexes, to_right, state, np.zeros(len(state[0]), np.int64))

    start = (np.arange(count), everywhere(0), everywhere(0), everywhere(n_text))
    if right:
        exact, rest = follow(start, words[:, :half][:, ::-1], False), words[:, half:]
    else:
        exact, rest = follow(start, words[:, half:], True), words[:, :half][:, ::-1]
        front = follow(start, words[:, :half][:, ::-1], False)
        begin, end = everywhere(0), everywhere(0)
        begin[front[0]], end[front[0]] = front[1], front[1] + front[3]
    nothing = tuple(np.zeros(0, np.int64) for _ in range(4))
    wrong = nothing  # matches with their one error behind them
    for k in range(rest.shape[1] + 1):
        at, letter = _next_letters(indexes[1 if right else 0], exact[2] if right else exact[1], exact[3], sigma)
        from_exact = tuple(x[at] for x in exact)
        tagged = (np.arange(len(at)), *from_exact[1:])
        grown = _extend(indexes, right, tagged, letter)
        which = grown[0]
        grown = (from_exact[0][which], *grown[1:])
        wrong = _join([wrong, grown])  # a letter more
        if k == rest.shape[1]:
            break
        replaced = letter[which] != rest[grown[0], k]
        wrong = _join([_extend(indexes, right, wrong, rest[wrong[0], k]), tuple(x[replaced] for x in grown), exact])
        exact = _extend(indexes, right, exact, rest[exact[0], k])
    q, f, _, _ = _extend(indexes, right, wrong, np.zeros(len(wrong[0]), np.int64))
    if not right:
        new = (f < begin[q]) | (f >= end[q])
        q, f = q[new], f[new]
    found = np.unique(q * (n_text + 1) + f)
    return found // (n_text + 1), found % (n_text + 1)


def search_shard(shard: pd.DataFrame) -> pd.DataFrame:
    """For the asked words of a shard: how many near words the shard holds, and the best (largest n, then smallest word)."""
    right = bool(shard["side"].iloc[0] == 0)
    codes = [np.frombuffer(w.encode("latin-1"), np.uint8) for w in shard["word"]]
    alphabet = np.unique(np.concatenate(codes))
    table = np.zeros(256, np.uint8)
    table[alphabet] = np.arange(1, len(alphabet) + 1)
    codes = [table[w] for w in codes]
    sigma = len(alphabet)
    held = np.flatnonzero(shard["held"].to_numpy())
    asked = np.flatnonzero(shard["asked"].to_numpy())
    out = shard.iloc[asked][["word", "n"]].reset_index(drop=True)
    near, best = np.zeros(len(asked), np.int64), np.full(len(asked), -1)
    if len(held) and len(asked):
        held = np.array(sorted(held, key=lambda i: codes[i].tobytes()))
        backwards = sorted((codes[i][::-1] for i in held), key=lambda w: w.tobytes())
        indexes = (_index([codes[i] for i in held], sigma), _index(backwards, sigma))
        n_text = int(sum(len(codes[i]) for i in held)) + len(held) + 1
        held_n = shard["n"].to_numpy()[held]
        lengths = np.array([len(codes[i]) for i in asked])
        by_length = np.argsort(lengths, kind="stable")
        edges = np.flatnonzero(np.diff(lengths[by_length])) + 1
        for same in np.split(by_length, edges):
            for i in range(0, len(same), TOGETHER):
                part = same[i:i + TOGETHER]
                q, row = _search(indexes, np.stack([codes[j] for j in asked[part]]).astype(np.int64), sigma, right, n_text)
                if len(q):
                    word = row - 1
                    order = np.lexsort((word, -held_n[word], q))
                    lead = order[np.unique(q[order], return_index=True)[1]]
                    best[part[q[lead]]] = held[word[lead]]
                    near += np.bincount(part[q], minlength=len(near))
    out["near"] = near
    out["best_n"] = pd.array(np.where(best >= 0, shard["n"].to_numpy()[best], 0), "Int64")
    out.loc[best < 0, "best_n"] = pd.NA
    out["best"] = np.where(best >= 0, shard["word"].to_numpy()[best], None)
    return out


def _level(length: Column) -> Column:
    """Characters of a key: the largest even number within half of the word's length, 2 to 100."""
    return F.greatest(F.least(F.floor(length / 4) * 2, F.lit(100)), F.lit(2)).cast("int")


def near_words(words: DataFrame, shard: int = SHARD) -> DataFrame:
    """(word, n, n_near, best, best_n) for ``words(word, n)``: distinct Latin-1 words of at least 4 code points."""
    length = F.length("word")
    levels = F.array_distinct(F.array(*[_level(length + d) for d in (-1, 0, 1)]))
    own = _level(length)
    rows = words.withColumn("level", F.explode(levels)).withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
    rows = rows.withColumn("asked", F.col("level") == own).withColumn(
        "key", F.when(F.col("side") == 0, F.substring("word", F.lit(1), F.col("level"))).otherwise(
            F.substring("word", F.greatest(length - F.col("level") + 1, F.lit(1)), F.col("level"))))
    rows = stored(rows, "spelling-keys")
    shards = max(1, math.ceil(rows.count() / shard))
    crowded = (rows.groupBy("side", "level", "key").count().where(F.col("count") > shard)
               .select("side", "level", "key", F.ceil(F.col("count") / shard).cast("int").alias("parts")))
    rows = rows.join(crowded, ["side", "level", "key"], "left")
    home = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    parts = F.when(F.col("parts").isNull(), F.array(F.lit(-1))).when(F.col("asked"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(home))
    rows = rows.withColumn("part", F.explode(parts)).withColumn("held", (F.col("part") == -1) | (F.col("part") == home))
    place = F.when(F.col("part") == -1, F.pmod(F.xxhash64("level", "key"), F.lit(shards)).cast("string")).otherwise(F.concat_ws(":", "part", "key"))
    found = (rows.select("side", "level", place.alias("place"), "word", "n", "asked", "held").groupBy("side", "level", "place")
             .applyInPandas(search_shard, "word string, n long, near long, best_n long, best string"))
    lead = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("rank"), "best")))
    return (found.groupBy("word").agg(F.first("n").alias("n"), F.sum("near").alias("n_near"), lead.alias("lead"))
            .select("word", "n", "n_near", F.col("lead.best").alias("best"), (-F.col("lead.rank")).alias("best_n")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each word's chain of ``forms(word, form)``, by doubling; chains must not close."""
    at = stored(forms.where("form is not null").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        moved = stored(at.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"),
                                                            F.col("ahead").isNotNull().alias("moved")), "spelling-roots")
        at = moved.select("word", "root")
        if not moved.where("moved").head(1):
            return at


def variants(docs: DataFrame, least_length: int = 5, least_count: int = 3, ratio: int = 2, shard: int = SHARD) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the vocabulary of ``docs``.

    A word's form is its near word of largest n (ties: the smallest), if that is at
    least ``ratio`` times the word's own n; as n grows along forms, chains end.
    """
    words = stored(vocabulary(corrupted_runs(docs), least_length, least_count), "spelling-words")
    good = F.col("best_n") >= ratio * F.col("n")
    found = stored(near_words(words, shard).select("word", "n", "n_near", F.when(good, F.col("best")).alias("form"),
                                                   F.when(good, F.col("best_n")).alias("form_n")), "spelling-forms")
    return found.join(roots(found), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: DuckDB SQL for ``variants``: near words meet through the texts with one code point deleted.
ORACLE_SQL = """
with recursive crc as (
  select list_transform(range(256), lambda v: list_reduce(list_concat([v], range(8)),
    lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)) as tab),
runs as (
  select doc_id, run, count(*) as n from (
    select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) as run
    from documents) group by all),
coded as (
  select run, n, hex(encode(concat(doc_id::varchar, ':', run))) as bytes from runs),
hashed as (
  select run, n, xor(list_reduce(list_concat([4294967295::bigint], list_transform(range(1, length(bytes), 2),
      lambda i: (strpos('0123456789ABCDEF', bytes[i]) - 1) * 16 + strpos('0123456789ABCDEF', bytes[i + 1]) - 1)),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) as h
  from coded, crc),
words as (
  select word, sum(n)::bigint as n from (
    select case when h % 97 = 0 then substr(run, 1, (h % length(run))::bigint) || substr(run, (h % length(run))::bigint + 2) else run end as word, n
    from hashed) where length(word) >= 5 group by word having sum(n) >= 3),
cut as (select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as short from (select word, n, unnest(range(1, length(word) + 1)) as i from words)),
near as (
  select a.word, b.word as other, b.n from cut a join words b on a.short = b.word
  union select b.word, a.word, a.n from cut a join words b on a.short = b.word
  union select a.word, b.word, b.n from cut a join cut b on a.short = b.short and a.i = b.i and a.word <> b.word),
ranked as (select *, row_number() over (partition by word order by n desc, encode(other)) as place, count(*) over (partition by word) as n_near from near),
forms as (
  select words.word, words.n, coalesce(n_near, 0) as n_near, case when ranked.n >= 2 * words.n then other end as form,
    case when ranked.n >= 2 * words.n then ranked.n end as form_n
  from words left join ranked on ranked.word = words.word and place = 1),
chain as (
  select word, word as root, 0 as step from forms
  union all select chain.word, forms.form, step + 1 from chain join forms on forms.word = chain.root where forms.form is not null)
select forms.word, form, root, n, n_near, form_n from forms join (select word, max_by(root, step) as root from chain group by word) using (word)"""
