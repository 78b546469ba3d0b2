from collections import defaultdict

from pyspark.sql import functions as F

from helpers import awkward, base_texts, prose, rows
from wayfarer.llm import line_dedup as L

STRIP = " \t\n\x0b\x0c\r"


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def slow(data, min_sites, max_share=0.5):
    sites = defaultdict(set)
    for _, t, s in data:
        for x in (t or "").split("\n"):
            if x.strip(STRIP):
                sites[lower(x).strip(STRIP)].add(s)
    common = {x for x, s in sites.items() if len(s) >= min_sites}
    out = []
    for i, t, _ in data:
        lines = (t or "").split("\n")
        cut = [x for x in lines if lower(x).strip(STRIP) in common]
        good = sum(len(x.strip(STRIP)) for x in cut) <= max_share * sum(map(len, lines))
        drop = set(cut) if good else set()
        out.append((i, sum(bool(x.strip(STRIP)) for x in lines), len(cut) if good else 0,
                    t if not drop else "\n".join(x for x in lines if x not in drop)))
    return sorted(map(repr, out))


def test_matches_brute_force(spark):
    shared, rare = "Licensed under the Foo License.", "Only on three sites."
    texts, sources = [], []
    for i in range(30):
        texts.append(prose(40, i) + "\n" + ("  " + shared.upper() if i % 2 else shared) + (("\n" + rare) if i < 3 else "")
                     + ("\n" + shared if i % 3 == 0 else ""))
        sources.append(None if i == 7 else f"site{i}")
    texts += [shared, None, "", "\n\n", shared + "\n" + shared]
    sources += ["a", "b", "c", "d", "e"]
    docs = awkward(spark, texts, sources)
    data = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    for min_sites in (3, 4, 10):
        got = L.dedup_lines(docs, min_sites=min_sites).select("doc.doc_id", "line_dedup.*")
        assert rows(got) == slow(data, min_sites)


def test_near_threshold_is_exact_with_coarse_sketches(spark):
    """With 16 registers the estimate is poor; the exact count of the band decides."""
    texts = [f"line {k}" + "\n" + prose(30, i) for k in range(6) for i in range(40 + 4 * k)]
    sources = [f"s{i}" for k in range(6) for i in range(40 + 4 * k)]
    docs = awkward(spark, texts, sources)
    found = L.boilerplate_lines(docs, min_sites=50, lg_k=4)
    assert found.count() == 3


def test_heavy_lines_in_salts_give_the_same(spark, monkeypatch):
    """A line on a third of all rows, one text on another third, and lines on every site."""
    texts = ["Home\n" + prose(20, i) + "\nContact" for i in range(40)] + [prose(30, 99) + "\nHome"] * 40 + ["x" * i for i in range(40)]
    docs = awkward(spark, texts, [f"s{i % 25}" for i in range(120)])
    plain = L.dedup_lines(docs).select("doc.doc_id", "line_dedup.*")
    want = rows(plain)
    monkeypatch.setattr(L, "FREQUENT", 4)
    monkeypatch.setattr(L, "HEAVY", 50)
    spread = L._spread(L._seen(docs, "text", "source"), 1, 12)
    salts = {r.salts for r in L._heavy(spread).collect()}
    assert max(salts) > 8 and len(salts) > 1
    assert rows(L.dedup_lines(docs).select("doc.doc_id", "line_dedup.*")) == want
    data = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    assert want == slow(data, 10)


def test_long_text_with_many_cut_lines(spark):
    cut = "\n".join(f"menu {i}" if i % 2 else "kept " * 5 + str(i) for i in range(40_000))
    docs = awkward(spark, [cut] + ["\n".join(f"menu {i}" for i in range(1, 40_000, 2))] * 10, [f"s{i}" for i in range(11)])
    got = {r.doc_id: r for r in L.dedup_lines(docs).select("doc.doc_id", "line_dedup.*").collect()}
    assert got[0].n_removed == 20_000 and got[0].text.split("\n") == [x for x in cut.split("\n") if x[0] == "k"]


def test_copies_of_one_text_have_their_own_keys(spark):
    docs = awkward(spark, [prose(20, 1)] * 30)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    assert packed.select(L._row_key(docs, "text").alias("k")).distinct().count() == 30


def test_whole_copies_stay(spark):
    t = prose(60, 1)
    docs = awkward(spark, [t] * 12, [f"s{i}" for i in range(12)])
    assert {r.text for r in L.dedup_lines(docs).select("line_dedup.text").collect()} == {t}


def test_empty_and_native(spark):
    docs = awkward(spark, base_texts())
    assert L.dedup_lines(docs.limit(0)).count() == 0
    plan = L.dedup_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
