"""Toxicity by a classifier chain.

Categories are predicted one after the other: each linear model sees the words
of a text and the probabilities of the categories before it.  While training,
those earlier probabilities are out-of-fold predictions, so that a later model
learns from inputs as imperfect as the ones it will get when scoring.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewise.llm.common import fresh_name, materialize

#: Bias of a category without a positive label: a probability of 1e-13.
NEVER = -30.0
#: Words as the fit finds them in the JVM.
_WORD = regex.compile(r"[\p{L}\p{N}_]+")


@dataclass(frozen=True)
class ChainModel:
    categories: list[str]
    vocabulary: dict[str, int]
    weights: list[np.ndarray]  # one per category: bias, words, earlier categories

    def probabilities(self, texts) -> np.ndarray:
        """One row of category probabilities per text (None counts as empty)."""
        v, n = self.vocabulary, len(self.vocabulary)
        out = np.empty((len(texts), len(self.categories)))
        for i, text in enumerate(texts):
            hit = [v[w] for w in set(_WORD.findall(text.lower())) if w in v] if text else []
            for k, w in enumerate(self.weights):
                z = w[0] + w[1:n + 1][hit].sum() + w[n + 1:] @ _logit(out[i, :k])
                out[i, k] = _sigmoid(z)
        return out


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def _logit(p):
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _fit_linear(x: np.ndarray, y: np.ndarray, l2: float, steps: int = 12) -> np.ndarray:
    """Ridge logistic regression by Newton steps; column 0 is the unpenalised bias."""
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], l2)
    ridge[0] = 1e-6
    for _ in range(steps):
        p = _sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge),
                               x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _fit_chain(words: np.ndarray, labels: np.ndarray, folds: np.ndarray, l2: float) -> list[np.ndarray]:
    weights, x = [], np.hstack([np.ones((len(words), 1)), words])
    for k in range(labels.shape[1]):
        y = labels[:, k]
        if not y.any():  # untrained: nothing is found to be in this category
            weights.append(np.concatenate(([NEVER], np.zeros(x.shape[1] - 1))))
            x = np.hstack([x, _logit(np.zeros(len(y)))[:, None]])
            continue
        weights.append(_fit_linear(x, y, l2))
        oof = np.full(len(y), y.mean())
        for f in np.unique(folds):
            rest = folds != f
            if rest.any():
                oof[~rest] = _sigmoid(x[~rest] @ _fit_linear(x[rest], y[rest], l2))
        x = np.hstack([x, _logit(oof)[:, None]])
    return weights


def fit(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], *,
        max_rows: int = 8000, words_per_category: int = 160, min_docs: int = 3,
        min_chi: float = 25.0, folds: int = 3, l2: float = 0.3) -> ChainModel:
    """Train the chain on ``docs`` (doc_id, text) and ``labels`` (doc_id and what ``categories`` read).

    ``categories`` maps names, in chain order, to boolean expressions over
    ``labels``.  The fit sees at most ``max_rows`` labelled ids (those of least
    hash): its vocabulary is the words of highest chi-square with each category,
    from document counts, ``min_chi`` at least (words that differ by chance only
    would add up in very long texts), and its models are ridge logistic regressions.  Null
    labels, ids and texts are left out; of several labels for one id a true one
    wins, of several texts the one of least hash counts.  A category without a positive label (so each one, if there are no labels)
    is untrained: its probability is 0 but for rounding, so it rejects nothing.
    """
    names = list(categories)
    y = [F.max(c.cast("int")).alias(f"_y{i}") for i, c in enumerate(categories.values())]
    marks = labels.groupBy("doc_id").agg(*y).dropna()
    yc = [f"_y{i}" for i in range(len(names))]
    # The labelled ids up to the max_rows-th least hash: a bounded side, so the texts are not shuffled.
    h = F.xxhash64("doc_id")
    cut = marks.select(h.alias("h")).orderBy("h").limit(max_rows).agg(F.max("h")).first()[0]
    tokens = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)))
    chosen = docs.select("doc_id", "text").dropna().join(F.broadcast(marks.where(h <= F.lit(cut))), "doc_id")
    # One text an id, folded before its shuffle: rows that repeat an id count once.
    chosen = chosen.groupBy("doc_id", *yc).agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    marked = materialize(chosen.select("doc_id", *yc, tokens.alias("_w")), "toxicity_train")
    total = marked.agg(F.count("*"), *[F.sum(c) for c in yc]).first()
    n, pos = total[0], [t or 0 for t in total[1:]]
    counted = marked.select(*yc, F.explode("_w").alias("w")).groupBy("w").agg(
        F.count("*").alias("df"), *[F.sum(c).alias(c) for c in yc]).where(F.col("df") >= min_docs)
    words: set[str] = set()
    for c, p in zip(yc, pos):
        if not 0 < p < n:
            continue
        a, df = F.col(c), F.col("df")
        lift = a / p - (df - a) / (n - p)
        chi = lift * lift / (df / n * (1 - df / n) + 1.0 / n) * p * (n - p) / n
        top = counted.where((lift > 0) & (chi >= min_chi)).orderBy(chi.desc(), "w").select("w").limit(words_per_category)
        words.update(r.w for r in top.collect())
    vocabulary = {w: i for i, w in enumerate(sorted(words))}
    rows = marked.select("doc_id", *yc, F.filter("_w", lambda w: w.isin(*words) if words else F.lit(False)).alias("_w"))
    rows = rows.orderBy(h, "doc_id").collect()
    x = np.zeros((len(rows), len(vocabulary)))
    for i, r in enumerate(rows):
        x[i, [vocabulary[w] for w in r["_w"] if w in vocabulary]] = 1.0
    marks_of = np.array([[r[c] for c in yc] for r in rows], float).reshape(len(rows), len(names))
    weights = _fit_chain(x, marks_of, np.arange(len(rows)) % folds, l2)
    return ChainModel(names, vocabulary, weights)


def score(docs: DataFrame, model: ChainModel, *, text: str = "text", to: str = "_toxicity") -> DataFrame:
    """``docs`` with the array column ``to``: the chain's probabilities in category order.

    No shuffle: the model is a few hundred words and weights inside the task.
    Null and empty texts have no words and get the probabilities of the bias.
    A column named ``to`` is replaced.
    """
    @F.pandas_udf("array<double>")
    def chain(texts: pd.Series) -> pd.Series:
        return pd.Series(list(model.probabilities(texts.tolist())))

    return docs.withColumn(to, chain.asNondeterministic()(F.col(text)))


def classify(docs: DataFrame, model: ChainModel, *, category: str = "toxic", threshold: float = 0.5) -> DataFrame:
    """One row per document: doc_id, a probability per category (``p_<name>``), ``toxic`` boolean.

    Repeated rows and null ids keep their rows.
    """
    p = F.col("_toxicity")
    k = model.categories.index(category)
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", *[p[i].alias(f"p_{c}") for i, c in enumerate(model.categories)],
        (p[k] >= threshold).alias("toxic"))


def reject(docs: DataFrame, model: ChainModel, *, category: str = "toxic", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the chain does not find toxic, all columns as they came."""
    k = model.categories.index(category)
    to = fresh_name(docs, "_toxicity")
    return score(docs, model, to=to).where(F.col(to)[k] < threshold).select(*[F.col(f"`{c}`") for c in docs.columns])
