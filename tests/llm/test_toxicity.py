import random
import zlib

from helpers import awkward, base_texts, prose
from wayfarer.llm import toxicity as T

BAD = ["zorgwit", "flumcake", "grebnaut", "snorvile"]


def table(spark, n, seed=1):
    rnd, docs, labels = random.Random(seed), [], []
    for i in range(n):
        w, toxic = prose(rnd.randint(40, 200), 1000 * seed + i).split(), rnd.random() < 0.2
        for _ in range(rnd.randint(3, 8) if toxic else 0):
            w.insert(rnd.randrange(len(w)), rnd.choice(BAD))
        docs.append((i, " ".join(w), "q", 0.1))
        labels.append((i, 1, int(toxic)))
    return (spark.createDataFrame(docs, "doc_id long, text string, toxic string, score double"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_held_out_accuracy(spark):
    docs, labels = table(spark, 700)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    got = T.score_documents(docs, labels).collect()
    assert len(got) == 700 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    out = [r for r in got if r.held_out]
    right = sum(r.predicted == truth[r.doc_id] for r in out)
    assert right >= 0.95 * len(out)


def test_labels_of_held_out_rows_are_not_used(spark):
    docs, labels = table(spark, 300, 2)
    changed = labels.withColumn("toxic", T.F.when(T.held_out(T.F.col("doc_id")), 1 - T.F.col("toxic")).otherwise(T.F.col("toxic")))
    a = {r.doc_id: r.score for r in T.score_documents(docs, labels).collect()}
    b = {r.doc_id: r.score for r in T.score_documents(docs, changed).collect()}
    assert all(abs(a[i] - b[i]) < 1e-12 for i in a)


def test_awkward_rows(spark):
    docs, labels = table(spark, 300, 3)
    more = awkward(spark, base_texts())
    all_docs = docs.select("doc_id", "text").unionByName(more.select((more.doc_id + 1000).alias("doc_id"), "text"))
    odd = labels.unionByName(spark.createDataFrame([(1001, None, None), (None, 1, 1), (1002, 1, 7)], labels.schema))
    got = T.score_documents(all_docs, odd).collect()
    assert len(got) == 300 + len(base_texts()) and all(0 <= r.score <= 1 for r in got)
    empty = {r.score for r in got if r.doc_id in (1000, 1001)}
    assert len(empty) == 1 and empty.pop() < 0.3


def test_without_labels_or_rows(spark):
    docs, labels = table(spark, 20, 4)
    assert {r.score for r in T.score_documents(docs, labels.limit(0)).collect()} == {0.0}
    assert {r.score for r in T.score_documents(docs, labels.where("toxic = 0")).collect()} == {0.0}
    assert T.score_documents(docs.limit(0), labels).count() == 0
