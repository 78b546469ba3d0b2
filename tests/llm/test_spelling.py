"""Near words, forms and roots against brute force."""

import random
import re
import zlib
from collections import Counter

import pandas as pd
import pytest

from wayfarer.llm import spelling

from helpers import awkward, base_texts, rows

SIGNS = "abcdàÿ×Þ"


def neighbours(word, signs):
    out = set()
    for i in range(len(word) + 1):
        out |= {word[:i] + c + word[i:] for c in signs}
        if i < len(word):
            out |= {word[:i] + c + word[i + 1:] for c in signs} | {word[:i] + word[i + 1:]}
    return out - {word}


def brute(counts):
    signs = sorted({c for w in counts for c in w})
    out = {}
    for w, n in counts.items():
        near = sorted((v for v in neighbours(w, signs) if v in counts), key=lambda v: (-counts[v], v))
        form = near[0] if near and counts[near[0]] >= 2 * n else None
        out[w] = (form, n, len(near), counts[form] if form else None)
    done = []
    for w, (form, n, k, m) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        done.append((w, form, root, n, k, m))
    return sorted(map(repr, done))


def vocabulary(table):
    counts = Counter()
    for r in table:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r["text"] or ""):
            run = "".join(c.lower() if c < "\x7f" else c for c in run)
            h = zlib.crc32(f"{'' if r['doc_id'] is None else r['doc_id']}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def crowd(seed, size, long=10):
    rnd = random.Random(seed)
    words = set()
    while len(words) < size:
        w = "".join(rnd.choice(SIGNS[:4] if rnd.random() < 0.8 else SIGNS) for _ in range(rnd.randint(5, long)))
        words |= {w} | set(rnd.sample(sorted(neighbours(w, SIGNS)), 3))
    return {w: rnd.choice([3, 3, 4, 6, 7, 12, 30, 100]) for w in words if len(w) >= 5}


@pytest.mark.parametrize("shard,long", [(40_000, 10), (60, 24)])
def test_near_words(spark, shard, long):
    counts = crowd(shard, 700, long)
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r.word: (r.best, r.n_near, r.best_n) for r in spelling.near_words(words, shard).collect()}
    assert got.keys() == counts.keys()
    for w in counts:
        near = sorted((v for v in neighbours(w, SIGNS) if v in counts), key=lambda v: (-counts[v], v))
        assert got[w] == ((near[0], len(near), counts[near[0]]) if near else (None, 0, None)), w


@pytest.mark.parametrize("seed", range(4))
def test_one_shard_both_schemes(seed):
    """Both schemes together name every near word once."""
    counts = crowd(seed, 300)
    words = sorted(counts)
    found = Counter()
    for side in (0, 1):
        shard = pd.DataFrame({"side": side, "word": words, "n": [counts[w] for w in words], "held": True, "asked": True})
        for r in spelling.search_shard(shard).itertuples():
            found[r.word] += r.near
    assert {w: found[w] for w in words} == {w: sum(v in counts for v in neighbours(w, SIGNS)) for w in words}


def test_documents(spark):
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdeéÉÀ") for _ in range(rnd.randint(4, 9))) for _ in range(60)]
    texts = [" ".join(rnd.choice(words) + rnd.choice(["", ".", "1", "œ"]) for _ in range(120)) for _ in range(60)]
    texts += base_texts() + ["x" * 5000] * 3 + ["x" * 4999] * 3
    docs = awkward(spark, texts)
    assert rows(spelling.variants(docs)) == brute(vocabulary([r.asDict() for r in docs.collect()]))
    assert spelling.variants(docs.limit(0)).count() == 0


def test_long_chains_end(spark):
    chain = ["a" * (5 + i) for i in range(12)]
    words = spark.createDataFrame([(w, v) for w, v in zip(chain, chain[1:])] + [(chain[-1], None)], "word string, form string")
    assert {(r.word, r.root) for r in spelling.roots(words).collect()} == {(w, chain[-1]) for w in chain[:-1]}
