import random

import numpy as np
import xxhash

from helpers import awkward, base_texts, prose
from wayfarer.llm import simhash_vptree as S
from wayfarer.llm.graph import connected_components


def slow_fingerprint(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_components(fps, bits):
    keys = sorted(set(fps))
    root = {k: k for k in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            if bin(a ^ b).count("1") <= bits:
                root[find(a)] = find(b)
    return {k: find(k) for k in keys}


def unsigned(x):
    return x % (1 << 64)


def expected(pairs):
    comp = slow_components([f for _, f in pairs], 2)
    best = {}
    for i, f in pairs:
        if i is not None:
            best[comp[f]] = min(i, best.get(comp[f], i))
    return sorted(((i, format(f, "016x"), best.get(comp[f])) for i, f in pairs), key=repr)


def test_fingerprint_matches_definition():
    for t in [None, "", " \t", "A b", "Ab cd EF gh ij", "É É É É", prose(200, 5), "a\x1cb\u00a0c d e f"]:
        assert unsigned(S.fingerprint(t)) == slow_fingerprint(t)


def test_every_step_or_its_reverse_is_forward():
    for groups in S.TIERS[:3]:
        for s in S._steps(groups, 2):
            back = tuple(-d for d in s)
            assert (S._forward(s) != S._forward(back)) or not any(s)


def test_awkward_table_and_clashing_columns(spark):
    docs = awkward(spark, base_texts())
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in S.near_duplicates(docs).collect()), key=repr)
    assert got == expected([(r.doc_id, slow_fingerprint(r.text)) for r in docs.collect()])


def test_empty_table(spark):
    docs = awkward(spark, base_texts()).limit(0)
    assert S.near_duplicates(docs).count() == 0
    assert S.keep_one(docs).count() == 0


def _clustered(n, seed):
    rnd = random.Random(seed)
    centre = rnd.getrandbits(64)
    out = {rnd.getrandbits(64) for _ in range(n)}
    for _ in range(n):
        x = centre
        for b in rnd.sample(range(64), rnd.randint(0, 4)):
            x ^= 1 << b
        out.add(x)
    return sorted(out)


def test_tree_links_equal_brute_force_at_every_depth(spark):
    """Small leaves force the deeper tiers; the components must not change."""
    fps = _clustered(250, 7)
    df = spark.createDataFrame([(S._signed(x),) for x in fps], "fp long")
    want = slow_components(fps, 2)
    for leaf_rows in (1_000_000, 60, 8):
        roots = {unsigned(r.node): unsigned(r.root) for r in
                 connected_components(S.near_links(df, 2, leaf_rows)).collect()}
        groups = {}
        for x in fps:
            groups.setdefault(want[x], set()).add(roots.get(x, x))
        assert all(len(g) == 1 for g in groups.values())
        assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_leaf_links_are_a_forest_of_true_links():
    fps = np.array(_clustered(150, 9), dtype=np.uint64)
    home = np.arange(len(fps)) % 3 != 0
    links = S.leaf_links(fps, home, 2)
    assert all(bin((a ^ b) % (1 << 64)).count("1") <= 2 for a, b in links)
    assert len(links) < len(fps)


def test_keep_one_keeps_smallest_id_once(spark):
    docs = awkward(spark, base_texts())
    docs = docs.unionByName(docs)
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id, r.text) for r in kept.collect() if r.doc_id is not None)
    comps = {c for _, _, c in expected([(r.doc_id, slow_fingerprint(r.text)) for r in docs.collect()])}
    assert [i for i, _ in got] == sorted(c for c in comps if c is not None)


def test_components_of_chain_and_hub(spark):
    chain = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(1, 61)) and all(got[1000 + i] == 1000 for i in range(1, 200))
