import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline as P  # noqa: E402
from helpers import awkward, base_texts, prose, rows  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_in_order_and_columns(spark):
    assert [n for n, _ in P.STAGES] == ["quality rules", "line dedup", "simhash near-dedup", "decontamination", "mixing"]
    docs = awkward(spark, base_texts() + [prose(100, 50 + i) for i in range(5)])
    for i, (_, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, SF)
        if i < 4:
            assert out.columns == docs.columns
        docs = out.cache()
        assert stage(spark, awkward(spark, base_texts()).limit(0), SF).count() == 0
    assert docs.count() and docs.where("epochs < 1").count() == 0


def test_decisions_take_effect(spark, tmp_dir):
    item = prose(40, 1)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    line = "Shared by every site in the land, this line is."
    good = [prose(90, 10 + i) for i in range(12)]
    texts = [g + "\n" + line for g in good] + [good[0] + "\n" + line, "too short", " ".join(f"a{i}### b{i}$$$" for i in range(60)),
                                             prose(60, 99) + "\n" + item, None, ""]
    sources = [f"s{i}" for i in range(12)] + ["t", "t", "t", "t", None, None]
    awkward(spark, texts, sources).write.parquet(f"{tmp_dir}/documents.parquet")
    out = {r.doc_id: r for r in P.run(spark, tmp_dir).collect()}
    assert set(out) == set(range(12))
    assert all(out[i].text == good[i] and out[i].n_chars == len(good[i]) and out[i].n_tokens == 90 for i in out)
    assert all(len(r.draws) == r.epochs >= 1 for r in out.values())


def test_repeatable(spark):
    assert rows(P.run(spark, SF)) == rows(P.run(spark, SF))
