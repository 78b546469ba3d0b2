import math
from collections import defaultdict

import pytest

from helpers import awkward, base_texts, prose, rows
from wayfarer.llm import mixing as M


def corpus(spark):
    texts, sources = [], []
    for s, n in (("big", 60), ("mid", 20), ("tiny", 4), (None, 8)):
        for i in range(n):
            texts.append(prose(20 + 7 * (i % 9), hash((s or "", i)) % 10**6))
            sources.append(s)
    return awkward(spark, texts, sources)


def totals(docs):
    t = defaultdict(int)
    for r in docs.collect():
        t[r.source] += len((r.text or "").split())
    return t


def slow_exponent(t, limit):
    """Plain bisection of the least exponent whose repetitions stay within ``limit``."""
    n = sum(t.values())
    p = [x / n for x in t.values()]
    low, high = 0.0, 1.0
    for _ in range(60):
        a = (low + high) / 2
        low, high = (low, a) if (max(p) / min(p)) ** (1 - a) <= limit else (a, high)
    return high


@pytest.mark.parametrize("block_tokens", [50, 400, 1_000_000])
def test_repetition_limit_budgets_and_partial_epochs(spark, block_tokens):
    docs = corpus(spark)
    t = totals(docs)
    a = slow_exponent(t, 3.0)
    n, longest = sum(t.values()), max(len(r.text.split()) for r in docs.collect())
    z = sum((x / n) ** a for x in t.values())
    drawn, seen = defaultdict(int), defaultdict(list)
    for r in M.manifest(docs, max_repeats=3.0, block_tokens=block_tokens).collect():
        drawn[r.source] += r.n_tokens
        seen[r.doc_id].append(r.epoch)
        assert abs(r.weight - (t[r.source] / n) ** a / z) < 1e-6
    budget = n * z * max(x / n for x in t.values()) ** (1 - a)
    for s, x in t.items():
        want = (x / n) ** a / z * budget
        assert want - longest - 1 <= drawn[s] <= want + 1
    assert len(seen) == docs.count()
    assert all(sorted(e) == list(range(len(e))) for e in seen.values())


def test_entropy_target(spark):
    docs = corpus(spark)
    t = totals(docs)
    shares = spark.createDataFrame([(x / sum(t.values()),) for x in t.values()], "p double")
    for target in (0.8, 0.95, 1.0):
        a = M.exponent(shares, None, target)
        w = [x ** a for x in t.values()]
        h = -sum(x / sum(w) * math.log(x / sum(w)) for x in w)
        assert h >= target * math.log(len(t)) - 1e-6
        assert a in (0.0, 1.0) or h <= target * math.log(len(t)) + 1e-4


def test_token_budget_smaller_than_the_corpus(spark):
    docs = corpus(spark)
    out = M.manifest(docs, budget_tokens=800, block_tokens=100)
    assert sum(r.n_tokens for r in out.collect()) <= 804
    orders = [(r.block_order, r.doc_order) for r in out.collect()]
    assert len(set(orders)) == len(orders)


def test_repeatable_and_equal_rows_alike(spark):
    docs = corpus(spark)
    assert rows(M.manifest(docs)) == rows(M.manifest(docs.repartition(7)))
    counts = defaultdict(set)
    for r in M.manifest(docs.unionByName(docs)).groupBy("doc_id", "epoch").count().collect():
        counts[r["count"]].add(r.doc_id)
    assert set(counts) == {2}


def test_awkward_rows_and_columns(spark):
    docs = awkward(spark, base_texts())
    drawn = M.draw(docs, M.plan(docs))
    assert drawn.count() == docs.count() and drawn.select("doc.*").columns == docs.columns
    assert drawn.where("size(mix.draws) = 0").count() == 0
    blank = awkward(spark, [None, "", " "])
    assert M.manifest(blank).count() == 3
    assert M.manifest(docs.limit(0)).count() == 0


def test_beyond_the_broadcast_bound_the_same(spark, monkeypatch):
    """Only the source "big" is broadcast; the other sources meet their rows in a shuffle."""
    docs = corpus(spark)
    want = rows(M.manifest(docs, max_repeats=3.0, block_tokens=50))
    monkeypatch.setattr(M, "HEAVY", 3)
    assert rows(M.manifest(docs, max_repeats=3.0, block_tokens=50, max_broadcast_bytes=0)) == want


def test_many_texts_without_tokens_beside_a_partial_epoch(spark):
    docs = awkward(spark, [prose(30, i) for i in range(30)] + [None, "", " "] * 20, ["a"] * 20 + ["b"] * 10 + ["a"] * 60)
    out = M.manifest(docs, max_repeats=1.5, block_tokens=100)
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()}
