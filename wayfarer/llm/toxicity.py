"""Toxicity by compression distance: two zstandard dictionaries, compared window by window.

Fit, on a bounded sample of labelled rows (``max_toxic`` toxic and
``max_ordinary`` ordinary documents on average, of at most ``max_train_chars``
characters, picked by a hash of the id):

* half of the sample builds the dictionaries.  Both hold the most common
  ordinary words; one ends in the telling words of toxic text, the other in as
  many bytes of further ordinary words.  A word is telling if it occurs in
  significantly more distinct contexts (word before, word after) of toxic text
  than of ordinary text; contexts instead of occurrences, so that copies of one
  document do not make its words look telling.  The counting is a Spark job.
* the other half calibrates: a logistic regression on the document features,
  with class weights set so that scores refer to the labels' own toxic share.

Score: a text is cut at blanks into windows of about ``window`` bytes, each is
compressed with either dictionary, and the differences in length give the
features (mean, largest, mean of the largest three, shares above 3 and 5 bytes).

Raw-content dictionaries are used: with trained entropy tables the lengths of
so short windows vary more between two dictionaries than a toxic word does.

Defined cases: null, empty and blank texts have no window, hence all features
zero and the calibrated score of that (low) point; rows without a label or with
a null label are never learned from; no toxic or no ordinary training row:
every score is the labels' toxic share (0 without labels); repeated rows get
equal scores; an empty table gives an empty result.  Inputs of a score are the
text alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfarer.llm.common import ascii_lower, small_batches, stored, words

THRESHOLD = 0.3
_FEATURES = 5


@dataclass(frozen=True)
class Fit:
    """Bounds of the training sample and parameters of the model."""

    max_toxic: int = 4000
    max_ordinary: int = 8000
    max_train_chars: int = 50_000
    window: int = 64
    level: int = 12
    min_z: float = 5.0
    min_ratio: float = 10.0
    min_contexts: int = 5
    toxic_bytes: int = 8192
    common_bytes: int = 16_384
    ridge: float = 1.0


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    weights: tuple  # intercept first; empty: every score is ``prior``
    prior: float


def _sample(docs: DataFrame, truth: DataFrame, fit: Fit) -> DataFrame:
    """(text, toxic, part) of the bounded sample; part 0 builds, part 1 calibrates.

    Ids are picked by hash at the rate that yields the bound (on average), so neither a sort nor
    a text of an unpicked row moves; the picked ids are few enough to broadcast.
    """
    seen = {r["toxic"]: r["n"] for r in truth.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    ids = truth.withColumn("h", F.xxhash64(F.col("doc_id").cast("string"), F.lit("toxicity")))
    rate = F.when(F.col("toxic") == 1, min(1.0, fit.max_toxic / max(1, seen.get(1, 0)))).otherwise(
        min(1.0, fit.max_ordinary / max(1, seen.get(0, 0))))
    picked = ids.where(F.pmod("h", F.lit(1 << 20)) < rate * (1 << 20))
    part = (F.pmod(F.shiftrightunsigned("h", 20), F.lit(3)) == 0).cast("int")
    return (docs.select("doc_id", "text").where(F.length("text").between(1, fit.max_train_chars))
            .join(F.broadcast(picked), "doc_id").select("text", "toxic", part.alias("part")))


def _telling_words(sample: DataFrame, fit: Fit) -> tuple[list[bytes], list[bytes]]:
    """Telling words of toxic text (weakest first) and common ordinary words (rarest first), both bounded."""
    w = words(ascii_lower(F.col("text")))
    at = (sample.where("part = 0").select("toxic", w.alias("w"))
          .select("toxic", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size("w"), F.lit(1))), lambda i: F.struct(
              F.get("w", i - 2).alias("a"), F.get("w", i - 1).alias("b"), F.get("w", i).alias("c")))).alias("x"))
          .where("x.b is not null and octet_length(x.b) <= 64").distinct())
    by_word = stored(at.groupBy(F.col("x.b").alias("word")).agg(
        F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("o")), "contexts")
    n_t, n_o = by_word.agg(F.coalesce(F.sum("t"), F.lit(0)), F.coalesce(F.sum("o"), F.lit(0))).first()
    if not n_t or not n_o:
        return [], []
    pooled = (F.col("t") + F.col("o")) / F.lit(n_t + n_o)
    z = (F.col("t") / n_t - F.col("o") / n_o) / F.sqrt(pooled * (1 - pooled) * (1 / n_t + 1 / n_o))
    telling = (by_word.where((F.col("t") >= fit.min_contexts) & (F.col("t") / n_t > fit.min_ratio * F.col("o") / n_o))
               .withColumn("z", z).where(F.col("z") >= fit.min_z).orderBy(F.desc("z"), "word").limit(fit.toxic_bytes // 2))
    common = by_word.where("o > 0").orderBy(F.desc("o"), "word").limit(fit.common_bytes)
    strong = [r.word.encode() for r in telling.select("word").collect()]
    usual = [r.word.encode() for r in common.select("word").collect()]
    return strong[::-1], [x for x in usual if x not in set(strong)][::-1]


def _tail(parts: list[bytes], size: int) -> bytes:
    return b" ".join(parts)[-size:]


def _windows(text: str, size: int) -> list[bytes]:
    b = text.encode().lower()
    out, i = [], 0
    while i < len(b):
        j = i + size
        if j < len(b):
            k = b.rfind(b" ", i, j)
            j = k + 1 if k > i else j
        out.append(b[i:j])
        i = j
    return out


def _compressors(model: Model, fit: Fit) -> list:
    return [zstandard.ZstdCompressor(
        level=fit.level, write_content_size=False, write_dict_id=False, write_checksum=False,
        dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
        for d in (model.ordinary, model.toxic)]


def text_features(text: str | None, compressors: list, fit: Fit) -> list[float]:
    ordinary, toxic = compressors
    d = np.array([len(ordinary.compress(w)) - len(toxic.compress(w)) for w in _windows(text or "", fit.window)], float)
    if not len(d):
        return [0.0] * _FEATURES
    top = np.sort(d)[::-1][:3]
    return [float(d.mean()), float(top[0]), float(top.mean()), float((d > 3).mean()), float((d > 5).mean())]


def _features(text: Column, model: Model, fit: Fit) -> Column:
    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        compressors = _compressors(model, fit)
        for s in batches:
            yield pd.Series([text_features(t, compressors, fit) for t in s], dtype="object")

    return run(text)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """Ridge logistic regression by Newton's method; columns are scaled inside."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    a = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    b, penalty = np.zeros(a.shape[1]), ridge * np.eye(a.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        h = (a * (weight * p * (1 - p))[:, None]).T @ a + penalty
        step = np.linalg.solve(h, a.T @ (weight * (y - p)) - penalty @ b)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    w = b[1:] / scale
    return np.concatenate([[b[0] - w @ mean], w])


def fit_model(docs: DataFrame, truth: DataFrame, fit: Fit = Fit()) -> Model:
    """Learn from ``docs`` (doc_id, text) by ``truth`` (distinct doc_id, toxic 0 or 1)."""
    n, n_toxic = truth.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    prior = n_toxic / n if n else 0.0
    sample = stored(_sample(docs, truth, fit), "toxicity-sample")
    strong, usual = _telling_words(sample, fit)
    base = _tail(usual, fit.common_bytes)
    toxic = _tail(strong, fit.toxic_bytes)
    rest = b" ".join(usual)[:-len(base) or None]
    model = Model(toxic + b" " + base, rest[-len(toxic) or len(rest):] + b" " + base, (), prior)
    if not strong:
        return model
    calibration = sample.where("part = 1").select("toxic", _features(F.col("text"), model, fit).alias("x")).toPandas()
    y = calibration["toxic"].to_numpy(dtype=float)
    if not 0 < y.sum() < len(y):
        return model
    weight = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    weights = _logistic(np.array(calibration["x"].tolist()), y, weight, fit.ridge)
    return Model(model.toxic, model.ordinary, tuple(map(float, weights)), prior)


def score(text: Column, model: Model, fit: Fit = Fit()) -> Column:
    """Probability that ``text`` is toxic."""
    if not model.weights:
        return F.lit(model.prior)
    x = _features(text, model, fit)
    logit = F.aggregate(F.zip_with(x, F.array(*map(F.lit, model.weights[1:])), lambda a, b: a * b),
                        F.lit(model.weights[0]), lambda s, v: s + v)
    return 1 / (1 + F.exp(-logit))


def held_out(doc_id: Column) -> Column:
    """The contract's fold: crc32 of the id as text modulo 4 is 2 (false without an id)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``; learns outside the held-out fold."""
    truth = (labels.where(F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(~held_out(F.col("doc_id"))))
    small_batches(docs.sparkSession)
    model = fit_model(docs, stored(truth, "toxicity-labels"), fit)
    return (docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text"), model, fit).alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))
