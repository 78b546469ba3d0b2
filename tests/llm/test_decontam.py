import random

from helpers import awkward, base_texts, prose, rows
from wayfarer.llm import decontam as D

ITEM = ("A train leaves the station with Alice at 9:30 and covers 120 km before noon, then Alice waits 15 minutes "
        "and returns over the same 120 km to the place where she began her journey")


def bench(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "item_id long, text string, `key` string, share int")


def found(spark, texts, items, **kw):
    return {(r.doc_id, r.item_id): r.kind for r in D.leaks(awkward(spark, texts), bench(spark, items), **kw).collect()}


def test_templates_replace_numbers_units_and_names(spark):
    df = spark.createDataFrame([("He met Alice O'Neil at 5 km, or 3.5kg; -7 % of $1,200.50!",), (None,), ("",)], "t string")
    got = [r[0] for r in df.select(D.template_tokens(df.t)).collect()]
    assert got == ["he met §p §p at §n §u or §n§u §n of §n".split(), [], []]
    raw = [len(r[0]) for r in df.select(D.raw_tokens(df.t)).collect()]
    assert raw == [len(x) for x in got]


def test_verbatim_reparameterised_and_inconsistent(spark):
    items = [ITEM, prose(30, 3), "too short an item", None, ""]
    other = ITEM.replace("Alice", "Boris").replace("120", "345").replace("9:30", "7:15").replace("15", "40")
    crossed = ITEM.replace("with Alice", "with Boris").replace("covers 120", "covers 99").replace("then Alice", "then Clara")
    texts = [prose(50, 1) + " " + ITEM + ". " + prose(50, 2), prose(20, 4) + "\n" + other,
             prose(20, 5) + "\n" + crossed, prose(200, 6), None, "", "one two three four",
             prose(40, 7) + "\n" + prose(30, 3) + "\n" + prose(40, 8)]
    got = found(spark, texts, items)
    assert got.get((0, 0)) == "verbatim"
    assert got.get((1, 0)) == "reparameterised"
    assert (2, 0) not in got
    assert got.get((7, 1)) == "verbatim"
    assert not {i for i, _ in got} - {0, 1, 7}


def test_the_best_alignment_decides(spark):
    """Misaligned hits of repeating items, and other exercises of the same template, do not outvote a verbatim copy."""
    pens = "3 pens for 4 coins and 4 pens for 6 coins and 6 pens for 3 coins and 3 pens for 4 coins"
    then = "2 then 4 then 2 then 6 then 4 then 2 then 6 then 2"
    form = "a farmer sells {} eggs and keeps {} eggs so {} eggs less {} eggs make the rest of {} eggs"
    task, variants = form.format(12, 5, 12, 5, 7), [form.format(40 + k, 20 + k, 60 + k, 80 + k, 30 + k) for k in range(6)]
    texts = [f"{prose(20, 1)}\n{pens}\n{prose(20, 2)}", f"{prose(20, 3)}\n{then}\n{prose(20, 4)}",
             "\n".join([prose(20, 5), *variants[:3], task, *variants[3:], prose(20, 6)]),
             "\n".join([prose(20, 7), *variants])]
    got = found(spark, texts, [pens, then, task])
    assert got.get((0, 0)) == got.get((1, 1)) == got.get((2, 2)) == "verbatim"
    assert (3, 2) not in got


def test_crossed_slots_stay_rejected_with_words_inserted(spark):
    item = ("A farmer sells 3 crates of apples to the market and 5 crates of pears to the baker, then the market returns 3 crates "
            "while the baker keeps all 5 crates, and later 3 more crates go out beside the 5 already counted in the old barn.")
    crossed = item.replace("returns 3", "returns 5").replace("keeps all 5", "keeps all 3").replace("later 3", "later 5").replace("the 5 already", "the 3 already")
    moved = item.replace("3", "44").replace("5", "66")

    def inserted(text, after, words):
        return text.replace(after, after + " " + words, 1)
    texts = [item, crossed, moved]
    for words in ("gladly", "on this very fine and sunny morning in may"):
        texts += [inserted(t, "of pears", words) for t in (item, crossed, moved)]
    got = {r.doc_id: r.kind for r in D.leaks(awkward(spark, texts), spark.createDataFrame([(7, item)], "item_id long, text string")).collect()}
    assert got == {0: "verbatim", 2: "reparameterised", 3: "verbatim", 5: "reparameterised", 6: "verbatim", 8: "reparameterised"}


def test_shares_match_brute_force(spark):
    """Random mutations of items inside noise, without slots: plain window containment."""
    rnd, items = random.Random(5), [prose(40, 100 + i).lower() for i in range(6)]
    texts = []
    for _ in range(40):
        w = items[rnd.randrange(6)].split()
        for _ in range(rnd.randint(0, 4)):
            w[rnd.randrange(len(w))] = "qqq"
        texts.append(prose(20, rnd.randrange(10**6)).lower() + "\n" + " ".join(w) + "\n" + prose(20, rnd.randrange(10**6)).lower())

    def grams(t):
        w = "".join(c for c in t if c not in D.PUNCTUATION).split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}

    want = {(i, k) for i, t in enumerate(texts) for k, x in enumerate(items)
            if len(grams(t) & grams(x)) >= 0.8 * len(grams(x))}
    assert set(found(spark, texts, items)) == want
    assert set(found(spark, texts, items, max_broadcast_bytes=0)) == want


def test_awkward_rows_copies_and_removal(spark):
    texts = base_texts() + [prose(20, 9) + "\n" + ITEM] * 3
    docs, items = awkward(spark, texts), bench(spark, [ITEM, ITEM])
    n = len(base_texts())
    assert set(found(spark, texts, [ITEM, ITEM])) == {(n + i, k) for i in range(3) for k in range(2)}
    kept = D.decontaminate(docs, items)
    assert kept.columns == docs.columns and rows(kept) == rows(docs.where(f"doc_id is null or doc_id < {n}"))


def test_empty_tables_and_native(spark):
    docs, items = awkward(spark, base_texts()), bench(spark, [ITEM])
    assert D.leaks(docs.limit(0), items).count() == 0
    assert D.leaks(docs, items.limit(0)).count() == 0
    plan = D.leaks(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
