"""Quality scores learned from positive and unlabelled texts.

Trusted positives are texts labelled good; all other web text is unlabelled. The classifier minimises
the non-negative unbiased risk: the risk on positives, plus the risk of calling unlabelled texts
good from which the share of positives is taken out, kept from falling below zero. The class prior
is estimated from the labels.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import column, whole_text

#: The classifier is fitted on at most so many rows each: trusted positives, unlabelled texts, and
#: labelled texts to calibrate with. The rows with the smallest hashes of their ids are taken.
FIT_ROWS = 6000
#: Of the folds of crc32(id), fold 0 is held out.
FOLDS = 5
#: Predicted good from this score on.
THRESHOLD = 0.3
HIDDEN, STEPS, RATE, DECAY = 24, 400, 0.02, 1e-3
BIGRAMS = 96


def features(text: str) -> np.ndarray:
    """Shape of a text: shares of character classes, statistics of words and lines, and hashed
    bigrams of its bytes. Of an empty text all are zero."""
    raw = text.encode()
    if not raw:
        return np.zeros(len(_NAMES) + BIGRAMS, np.float32)
    b = np.frombuffer(raw, np.uint8)
    hist = np.bincount(b, minlength=256)
    n = len(b)
    share = hist / n
    upper, lower, digit = share[65:91].sum(), share[97:123].sum(), share[48:58].sum()
    blank = share[32] + share[9] + share[10] + share[13]
    symbol = share[[33, 35, 36, 37, 38, 42, 43, 60, 61, 62, 64, 92, 94, 95, 124, 126]].sum()
    words = text.split()
    count = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    lines = [x for x in text.split("\n") if x.strip()]
    line_count = max(1, len(lines))
    seen: dict[str, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    nonzero = share[share > 0]
    values = [
        np.log1p(n), upper, lower, digit, blank, symbol, share[128:].sum(),
        share[33], share[46], share[44], share[124], share[10],
        upper / max(upper + lower, 1e-9), -(nonzero * np.log(nonzero)).sum(),
        np.log1p(len(words)), lengths.mean() / 10, lengths.std() / 10, (lengths > 15).mean(),
        (lengths < 3).mean(), len(seen) / count, max(seen.values(), default=0) / count,
        sum(w[0].isupper() for w in words) / count, sum(w.isupper() for w in words) / count,
        sum(w[-1] in ".!?" for w in words) / count, sum(not w[-1].isalnum() for w in words) / count,
        len(set(lines)) / line_count, np.log1p(len(lines)), len(text) / line_count / 1000,
        sum(x[-1] in ".!?" for x in lines) / line_count,
    ]
    pair = (b[:-1].astype(np.uint32) << 8 | b[1:]) * np.uint32(2654435761) >> np.uint32(20)
    hashed = np.sqrt(np.bincount(pair % BIGRAMS, minlength=BIGRAMS) / max(1, n - 1))
    return np.concatenate([np.array(values), hashed]).astype(np.float32)


_NAMES = range(29)


@dataclass(frozen=True)
class Classifier:
    mean: np.ndarray
    scale: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    #: Slope and intercept of the calibrated score.
    slope: float = 1.0
    intercept: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.tanh(z @ self.hidden + self.hidden_bias) @ self.out + self.out_bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * self.margin(x) + self.intercept)


def _sigmoid(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -40, 40)))


def nn_risk(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[float, float]:
    """Parts of the risk for margins under the logistic loss: of positives, and of negatives (before
    it is kept from falling below zero)."""
    soft = lambda v: np.logaddexp(0, v)
    return prior * soft(-positive).mean(), soft(unlabelled).mean() - prior * soft(positive).mean()


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = 7) -> Classifier:
    """Minimise the non-negative risk with Adam over all given rows; when the negative part is below
    zero, step to raise it instead."""
    both = np.vstack([positive, unlabelled]).astype(np.float64)
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-3
    xp, xu = (np.clip((x - mean) / scale, -6, 6) for x in (positive, unlabelled))
    rng = np.random.default_rng(seed)
    params = [rng.normal(0, both.shape[1] ** -0.5, (both.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, STEPS + 1):
        w, c, v, d = params
        hp, hu = np.tanh(xp @ w + c), np.tanh(xu @ w + c)
        gp, gu = hp @ v + d, hu @ v + d
        _, negative = nn_risk(gp, gu, prior)
        # Derivatives of the logistic losses by the margins.
        down_p, up_p, up_u = -_sigmoid(-gp) / len(gp), _sigmoid(gp) / len(gp), _sigmoid(gu) / len(gu)
        if negative >= 0:
            dp, du = prior * down_p - prior * up_p, up_u
        else:
            dp, du = prior * up_p, -up_u
        tp, tu = (dp[:, None] * v) * (1 - hp**2), (du[:, None] * v) * (1 - hu**2)
        grads = [xp.T @ tp + xu.T @ tu + DECAY * w, tp.sum(0) + tu.sum(0), hp.T @ dp + hu.T @ du + DECAY * v, np.array([dp.sum() + du.sum()])]
        for i, g in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            params[i] = params[i] - RATE * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Classifier(mean, scale, params[0], params[1], params[2], float(params[3][0]))


def calibrated(model: Classifier, x: np.ndarray, good: np.ndarray) -> Classifier:
    """``model`` with slope and intercept fitted on labelled rows of the training folds."""
    if not len(good) or good.min() == good.max():
        return model
    m = model.margin(x)
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps of a regularised logistic regression
        p = _sigmoid(a * m + b)
        w = p * (1 - p)
        g = np.array([((p - good) * m).sum() + 1e-2 * (a - 1), (p - good).sum() + 1e-2 * b])
        h = np.array([[(w * m * m).sum() + 1e-2, (w * m).sum()], [(w * m).sum(), w.sum() + 1e-2]])
        a, b = np.array([a, b]) - np.linalg.solve(h, g)
    return Classifier(model.mean, model.scale, model.hidden, model.hidden_bias, model.out, model.out_bias, float(max(a, 0.0)), float(b))


def fold(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % FOLDS


@F.pandas_udf(T.ArrayType(T.FloatType()))
def _features(texts: pd.Series) -> pd.Series:
    return texts.map(features)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Classifier | None:
    """Fit on rows of the training folds; None without trusted positives or unlabelled texts.

    At most ``3 * FIT_ROWS`` ids are chosen, so their table may be broadcast and their features
    collected.
    """
    key = column(id_col).cast("long")
    trained = F.coalesce(fold(key) != 0, F.lit(False))
    known = labels.filter(trained & column(label_col).isNotNull()).select(key.alias("_id"), (column(label_col) == 1).cast("int").alias("_good"))
    # One label per id, the lower one if there are two.
    known = known.groupBy("_id").agg(F.min("_good").alias("_good"))
    by_hash = F.xxhash64("_id")
    share = known.agg(F.count(F.lit(1)).alias("n"), F.sum("_good").alias("good")).first()
    if not share["good"]:
        return None
    prior = (share["good"] + 1) / (share["n"] + 2)
    positives = known.filter("_good = 1").orderBy(by_hash, "_id").limit(FIT_ROWS).select("_id", F.lit(0).alias("_set"), "_good")
    # Another order for the calibration rows, so that both labels come in their own proportions.
    shown = known.orderBy(F.xxhash64("_id", F.lit(1)), "_id").limit(FIT_ROWS).select("_id", F.lit(1).alias("_set"), "_good")
    web = docs.filter(trained).select(key.alias("_id")).distinct()
    unlabelled = web.orderBy(F.xxhash64("_id", F.lit(2)), "_id").limit(FIT_ROWS).select("_id", F.lit(2).alias("_set"), F.lit(0).alias("_good"))
    chosen = positives.unionByName(shown).unionByName(unlabelled)
    chosen = chosen.groupBy("_id").agg(F.collect_set("_set").alias("_sets"), F.max(F.when(F.col("_set") < 2, F.col("_good"))).alias("_good"))
    texts = docs.select(key.alias("_id"), whole_text(text_col).alias("_text")).join(F.broadcast(chosen), "_id")
    # Repeated ids give one row.
    got = texts.groupBy("_id").agg(F.min("_text").alias("_text"), F.first("_sets").alias("_sets"), F.first("_good").alias("_good"))
    rows = got.select("_id", _features("_text").alias("x"), "_sets", "_good").toPandas()
    if rows.empty:
        return None
    rows = rows.sort_values("_id")
    x = np.stack(rows["x"].to_numpy())
    has = lambda k: rows["_sets"].map(lambda s: k in s).to_numpy(dtype=bool)
    if not has(0).any() or not has(2).any():
        return None
    model = fit_nnpu(x[has(0)], x[has(2)], prior)
    return calibrated(model, x[has(1)], rows["_good"].to_numpy(dtype=float)[has(1)])


def score_documents(docs: DataFrame, model: Classifier | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per input row; only the text is scored.

    A null text counts as empty and is scored like any text; a null id is not held out; without a
    model every score is 0.5. Other columns are not read.
    """
    key = column(id_col).cast("long")

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        if model is None:
            return pd.Series(np.full(len(texts), 0.5))
        if not len(texts):
            return pd.Series([], dtype=float)
        return pd.Series(model.score(np.stack([features(t) for t in texts]).astype(np.float64)))

    rows = docs.select(key.alias("doc_id"), F.coalesce(fold(key) == 0, F.lit(False)).alias("held_out"), scored(whole_text(text_col)).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """Fit on the labels of the training folds and score every document."""
    return score_documents(docs, fit(docs, labels, id_col, text_col, label_col), id_col, text_col)
