"""Merkle manifest against a plain recursive tree."""

import hashlib
import zlib

import pytest

from wayfarer.llm import merkle

from helpers import awkward, base_texts, rows

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, change=0):
    out = []
    for c in FIELDS:
        v = row[c]
        v = v + change if c == "n_chars" and v is not None else v
        out.append("-" if v is None else f"{len(str(v).encode())}:{v}")
    return sha(*out)


def tree(nodes, run):
    """(root, siblings of each leaf as (before, after) by level)."""
    paths = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for p, i in zip(paths, at):
            s = i // run * run
            p.append((nodes[s:i], nodes[i + 1:s + run]))
        at = [i // run for i in at]
        nodes = [sha(*nodes[i:i + run]) for i in range(0, len(nodes), run)]
    return (nodes or [None])[0], paths


def brute(table, run):
    groups = {}
    for r in table:
        groups.setdefault(r["lang"], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    made = {}
    for g in order:
        rs = sorted(groups[g], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        made[g] = (rs, *tree([leaf(r) for r in rs], run))
    root, tops = tree([made[g][1] for g in order], run)
    out = []
    for g, top in zip(order, tops):
        rs, sub, paths = made[g]
        for r, p in zip(rs, paths):
            way = p + top
            touched = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            node = leaf(r, 1 if touched else 0)
            for before, after in way:
                node = sha(*before, node, *after)
            out.append((r["doc_id"], leaf(r), sub, root, sha(*[x for b, a in way for x in b + a]), node, node == root))
    return sorted(map(repr, out))


@pytest.mark.parametrize("run,levels", [(2, 10), (2, 2), (3, 1), (5, 2)])
def test_equals_a_plain_tree(spark, run, levels):
    docs = awkward(spark, base_texts() + [f"text {i}" for i in range(60)])
    docs = docs.unionByName(docs.limit(9))  # repeated rows
    want = brute([r.asDict() for r in docs.collect()], run)
    assert rows(merkle.verify_documents(docs, run, levels)) == want


def test_tampering_shows_and_only_there(spark):
    docs = awkward(spark, [f"t{i}" for i in range(70)])
    for r in merkle.verify_documents(docs).collect():
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 7 != 0)


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_tiny_tables(spark, n):
    docs = awkward(spark, ["a", None, "c"]).limit(n)
    assert rows(merkle.verify_documents(docs)) == brute([r.asDict() for r in docs.collect()], 2)


def test_manifest_of_other_columns(spark):
    docs = awkward(spark, [f"t{i}" for i in range(8)])
    made = merkle.manifest(docs, ["q.x", "key"], "source", "fp", run=2, levels=2).collect()
    assert len(made) == 8 and len({r.leaf for r in made}) == 1 and len({r.root for r in made}) == 1
    assert len({r.group for r in made}) == len({r.source for r in docs.collect()})
