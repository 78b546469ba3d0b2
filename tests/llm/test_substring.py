import random
from collections import defaultdict

import numpy as np
import pytest

from helpers import awkward, base_texts, prose
from wayfarer.llm import substring_dedup as S


def exact_repeats(texts):
    """Word positions inside 50-word windows that occur in another text."""
    where = defaultdict(set)
    for i, t in enumerate(texts):
        w = (t or "").lower().split()
        for k in range(len(w) - 49):
            where[tuple(w[k:k + 50])].add((i, k))
    out = defaultdict(set)
    for hits in where.values():
        if len({i for i, _ in hits}) > 1:
            for i, k in hits:
                out[i].update(range(k, k + 50))
    return out


def spans(df):
    out = defaultdict(set)
    for r in df.collect():
        out[r.doc_id].update(range(r.from_word, r.to_word))
    return out


def test_compact_windows_cover_every_long_subsequence_once():
    rnd = np.random.default_rng(1)
    for values in (rnd.integers(0, 1 << 62, 90).astype(np.uint64), rnd.integers(0, 5, 90).astype(np.uint64)):
        windows = S.compact_windows(values, 10)
        for i in range(len(values)):
            for j in range(i + 9, len(values)):
                holds = [c for left, c, right in windows if left <= i <= c <= j <= right]
                assert len(holds) == 1 and values[holds[0]] == values[i:j + 1].min()


def test_repetitive_text_is_fast():
    assert len(S.compact_windows(np.zeros(200_000, dtype=np.uint64), 46)) > 1000


@pytest.mark.parametrize("hot_rows", [200_000, 3])
def test_finds_all_exact_repeats(spark, hot_rows):
    rnd = random.Random(3)
    shared = [prose(rnd.randint(60, 150), 500 + i).lower() for i in range(5)]
    texts = []
    for i in range(60):
        parts = [prose(rnd.randint(20, 120), i).lower()]
        if i % 2:
            parts += [rnd.choice(shared), prose(rnd.randint(0, 80), 900 + i).lower()]
        texts.append("\n".join(parts))
    texts += [texts[0], texts[0], "a b c"]
    want, got = exact_repeats(texts), spans(S.duplicate_passages(awkward(spark, texts), params=S.Params(hot_rows=hot_rows)))
    assert set(want) == set(got)
    for i in want:
        assert len(want[i] & got[i]) >= 0.98 * len(want[i])
        assert len(got[i] - want[i]) <= 12


def test_exact_repeats_around_a_stock_fragment(spark):
    """Twenty other texts hold 40 of the 52 words that each pair shares, so that they can be a bucket's first."""
    texts = []
    for g in range(16):
        stock = prose(40, 7000 + g).lower()
        texts += [f"{prose(30, 100 * g + k)}\n{stock}\n{prose(30, 100 * g + 50 + k)}".lower() for k in range(20)]
        for pair in range(3):
            shared = f"{prose(6, 8000 + 10 * g + pair)}\n{stock}\n{prose(6, 9000 + 10 * g + pair)}".lower()
            texts += [f"{prose(40, 20_000 + 100 * g + 10 * pair + k)}\n{shared}\n{prose(40, 30_000 + 100 * g + 10 * pair + k)}".lower()
                      for k in range(2)]
    want, got = exact_repeats(texts), spans(S.duplicate_passages(awkward(spark, texts)))
    assert len(want) == 96 and all(want[i] <= got[i] for i in want)


def test_exact_repeat_inside_a_stretch_that_matches_elsewhere():
    p, a = S.Params(), [f"w{i}".encode() for i in range(200)]
    scattered = a[:60] + [b"x"] * 90 + a[56:100] + [b"y"] * 90 + a[96:140] + [b"z"] * 90 + a[136:180] + [b"q"] * 90 + a[176:]
    sa, sb = S.passages(a, scattered, p)
    assert any(s <= 0 and 60 <= e for s, e in sa) and any(s <= 0 and 60 <= e for s, e in sb)


def test_near_copies_and_clean_texts(spark):
    rnd, base = random.Random(5), prose(300, 77).lower().split()
    texts = [" ".join(base)]
    for k in range(20):
        w = list(base)
        for _ in range(5):
            w[rnd.randrange(len(w))] = f"changed{k}"
        texts.append(" ".join(w))
    clean = [prose(200, 4000 + i).lower() for i in range(20)]
    out = S.duplicate_passages(awkward(spark, texts + clean))
    got = spans(out)
    assert set(got) == set(range(21))
    assert all(len(got[i]) >= 50 for i in got) and sum(map(len, got.values())) > 150 * 21
    assert {r.class_id for r in out.collect()} == {0}


def test_verification():
    p, a = S.Params(), [f"w{i}".encode() for i in range(120)]
    assert S.passages(a, a, p) == ([(0, 120)], [(0, 120)])
    assert S.passages(a[:40] + [b"x"] * 60, a[:40] + [b"y"] * 60, p) == ([], [])
    longer = [b"q"] * 30 + a[:60] + [b"insert"] + a[60:] + [b"z"] * 30
    (sa,), (sb,) = S.passages(a, longer, p)
    assert sa == (0, 120) and sb == (30, 151)


def test_awkward_rows_and_empty_table(spark):
    texts = base_texts()
    got = spans(S.duplicate_passages(awkward(spark, texts)))
    assert {5, 6, 7} <= set(got) and all(len(texts[i].split()) >= 50 for i in got)
    assert S.duplicate_passages(awkward(spark, texts).limit(0)).count() == 0


def similarity(a, b):
    x, y = ({tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (a, b))
    return len(x & y) / len(x | y)


def near_pair(rnd, seed, every=None):
    """A passage and a near copy: Jaccard of shingles 0.8 or more, no 50 words in common; with changes ``every`` so many words."""
    while True:
        n = rnd.randint(55, 99) if every is None else rnd.randint(100, 200)
        words = prose(n, seed).lower().split()
        other = list(words)
        for at in ([rnd.randint(n - 50, 49)] if every is None else range(rnd.randint(20, every), n, every)):
            other[at] = f"zz{at}"
        if similarity(words, other) >= 0.8:
            return words, other
        seed += 100_000


def test_dense_spans_are_the_longest():
    rnd = np.random.default_rng(5)
    for _ in range(200):
        match, least = rnd.random(rnd.integers(1, 60)) < rnd.choice([0.5, 0.8, 0.95]), int(rnd.integers(1, 20))
        got = S._dense_spans(match, 0.8, least)
        good = [(s, e) for s in range(len(match)) for e in range(s + least, len(match) + 1)
                if match[s] and match[e - 1] and match[s:e].sum() >= 0.8 * (e - s) - 1e-9]
        assert bool(got) == bool(good) and set(got) <= set(good)
        if good:
            assert max(e - s for s, e in got) == max(e - s for s, e in good)
        assert all(x[1] <= y[0] for x, y in zip(got, got[1:]))


@pytest.mark.parametrize("every", [None, 49])
def test_near_copies_without_a_common_run(spark, every):
    """Of near pairs that share no 50 words in a row, at least 95 % are found, whole but for their ends."""
    rnd, texts, held = random.Random(11), [], []
    for i in range(120):
        for k, words in enumerate(near_pair(rnd, 3000 + i, every)):
            front = prose(rnd.randint(0, 90), 50_000 + 2 * i + k).lower().split()
            held.append((len(front), len(front) + len(words)))
            texts.append(" ".join(front + words + prose(rnd.randint(0, 90), 90_000 + 2 * i + k).lower().split()))
    texts += [prose(rnd.randint(60, 300), 200_000 + i) for i in range(60)]
    got = spans(S.duplicate_passages(awkward(spark, texts)))
    found = sum(all(len(got[i] & set(range(*held[i]))) >= 0.8 * (held[i][1] - held[i][0]) for i in (2 * p, 2 * p + 1)) for p in range(120))
    assert found >= 0.95 * 120, found
    assert not any(got[i] for i in range(240, len(texts)))
    assert all(len(got[i] - set(range(*held[i]))) <= 12 for i in range(240))


def test_near_copies_around_a_stock_fragment(spark):
    """Twenty other texts hold 45 of the 53 words that each pair shares but for one, so that they can be a bucket's first."""
    texts, pairs = [], []
    for g in range(12):
        stock = prose(45, 7000 + g).lower()
        texts += [f"{prose(30, 100 * g + k)}\n{stock}\n{prose(30, 100 * g + 50 + k)}".lower() for k in range(20)]
        for pair in range(3):
            words = [*(f"front{g}x{pair}x{i}" for i in range(4)), *stock.split(), *(f"back{g}x{pair}x{i}" for i in range(4))]
            other = words[:5] + ["changed"] + words[6:]
            assert similarity(words, other) >= 0.8
            pairs.append((len(texts), len(texts) + 1, len(words)))
            texts += [f"{prose(40, 20_000 + 100 * g + 10 * pair + k)}\n{' '.join(w)}\n{prose(40, 30_000 + 100 * g + 10 * pair + k)}".lower()
                      for k, w in enumerate((words, other))]
    out = S.duplicate_passages(awkward(spark, texts))
    got, name = spans(out), {r.doc_id: r.class_id for r in out.collect()}
    assert [p for p in pairs if not (len(got[p[0]]) >= 0.9 * p[2] and len(got[p[1]]) >= 0.9 * p[2] and name[p[0]] == name[p[1]])] == []


def test_shared_shingles_are_counted_without_a_row_for_each(spark):
    stock = prose(60, 99)
    texts = [prose(80, i) + (" " + stock if i % 2 else "") for i in range(60)]
    texts += [texts[0] + " " + prose(70, 98), texts[0].upper(), "too short", "", "a " * 300, "A " * 200]
    params, want = S.Params(), defaultdict(int)
    for t in texts:
        base = S.shingle_hashes(t.encode().lower().split())
        if len(base) >= params.least:
            for v in set(base.view(np.int64).tolist()):
                want[v] += 1
    df = spark.createDataFrame(list(enumerate(texts)), "tid long, text string").repartition(5)
    made = S.shared_shingles(df, params)
    got = {r.v: min(r.n, params.rare + 1) for r in made.collect()}
    assert got == {v: min(n, params.rare + 1) for v, n in want.items() if n > 1}
    assert max(got.values()) == params.rare + 1 and min(got.values()) == 2
    assert "HashAggregate" not in made._jdf.queryExecution().executedPlan().toString()


def test_near_copies_of_frequent_shingles_meet_for_certain(spark):
    """Pairs whose common shingles all count as frequent meet by their common runs, whatever the min-hashes say."""
    rnd, texts, pairs = random.Random(12), [], []
    for i in range(200):
        words, other = near_pair(rnd, 400_000 + i)
        pairs.append((len(texts), len(texts) + 1, len(words)))
        texts += [" ".join(prose(40, 500_000 + 2 * i + k).lower().split() + w) for k, w in enumerate((words, other))]
    got = spans(S.duplicate_passages(awkward(spark, texts), params=S.Params(rare=1)))
    assert [p for p in pairs if min(len(got[p[0]]), len(got[p[1]])) < 0.8 * p[2]] == []


def test_covered_shingles_are_those_of_any_dense_stretch():
    rnd = np.random.default_rng(6)
    for _ in range(200):
        match, least = rnd.random(rnd.integers(1, 60)) < rnd.choice([0.5, 0.8, 0.95]), int(rnd.integers(1, 20))
        want = np.zeros(len(match), dtype=bool)
        for s in range(len(match)):
            for e in range(s + least, len(match) + 1):
                if match[s:e].sum() >= 0.8 * (e - s) - 1e-9:
                    want[s:e] = True
        assert (S._covered(match, 0.8, least) == want).all()
