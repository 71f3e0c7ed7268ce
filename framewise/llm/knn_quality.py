"""Quality by nearest-neighbour voting in a latent-semantic space.

Texts become term vectors (hashed byte trigrams, plus one term that counts
words equal to the word before), which a truncated SVD fitted on labelled
texts maps to a short latent vector.  Labelled latent vectors are broadcast;
every document's exact cosines with all of them are blocked matrix products
inside the scan task, and its nearest neighbours vote with weights that grow
with their similarity.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TERMS = 2048
#: Documents per matrix product: bounds a task's score matrix.
BLOCK = 256


def term_vector(text: str | None) -> np.ndarray:
    """Unit vector of square-rooted term counts; zero without terms.

    Trigrams are taken over a space on either side of the text, so that any
    non-empty text has terms.
    """
    out = np.zeros(TERMS + 1, np.float32)
    if not text:
        return out
    data = text.encode()
    b = np.frombuffer(b" " + data + b" ", np.uint8).astype(np.uint32)
    h = (b[:-2] * np.uint32(0x9E3779B1)) + (b[1:-1] * np.uint32(0x85EBCA77)) + (b[2:] * np.uint32(0xC2B2AE3D))
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    out[:TERMS] = np.bincount(h >> np.uint32(21), minlength=TERMS)
    words = data.split()
    out[TERMS] = 4 * sum(map(operator.eq, words, words[1:]))
    np.sqrt(out, out=out)
    return out / np.linalg.norm(out)


@dataclass(frozen=True)
class Voter:
    mean: np.ndarray      # of the training term vectors
    basis: np.ndarray     # terms x dims, columns scaled by singular value ** -0.5
    vectors: np.ndarray   # labelled latent unit vectors
    votes: np.ndarray     # their labels, 0 or 1
    prior: float          # mean label: the score of texts without terms
    k: int
    power: int

    def latent(self, terms: np.ndarray) -> np.ndarray:
        z = (terms - self.mean) @ self.basis
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)

    def scores(self, texts) -> np.ndarray:
        out = np.full(len(texts), self.prior)
        if not len(self.votes):
            return out
        for i in range(0, len(texts), BLOCK):
            terms = np.stack([term_vector(t) for t in texts[i:i + BLOCK]])
            sims = self.latent(terms) @ self.vectors.T
            k = min(self.k, sims.shape[1])
            near = np.argpartition(-sims, k - 1, axis=1)[:, :k]
            w = np.clip(np.take_along_axis(sims, near, 1), 0, 1) ** self.power
            total = w.sum(1)
            known = (total > 0) & terms.any(1)
            voted = (w * self.votes[near]).sum(1)
            out[i:i + BLOCK][known] = np.clip(voted[known] / total[known], 0, 1)
        return out


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "quality", learn: Column | None = None,
        max_exemplars: int = 3000, dims: int = 64, k: int = 7, power: int = 4) -> Voter:
    """Fit the space and keep the labelled vectors of at most ``max_exemplars`` documents.

    That bound (the exemplars with the least id hashes among the rows that
    ``learn`` admits) is the size of what is broadcast: ``max_exemplars`` times
    ``dims`` floats.  Labels other than 0 and 1, null ids and texts without
    terms are left out; of several labels for one id the greatest counts, of
    several texts the one of least hash.
    """
    marks = labels.where(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).alias("_y")).dropna()
    if learn is not None:
        marks = marks.where(learn)
    found = docs.select("doc_id", "text").where("text <> ''").join(marks, "doc_id")
    h = F.xxhash64("doc_id")
    cut = found.select("doc_id").distinct().select(h.alias("h")).orderBy("h").limit(max_exemplars).agg(F.max("h")).first()[0]

    @F.pandas_udf("binary")
    def terms_of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: term_vector(t).tobytes())

    # One text an id, folded before its shuffle: rows that repeat an id are one exemplar.
    chosen = found.where(h <= F.lit(cut)).groupBy("doc_id", "_y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = (chosen.select(F.col("_y").cast("int").alias("y"), h.alias("h"), "doc_id", terms_of("text").alias("x"))
            .orderBy("h", "doc_id").limit(max_exemplars).collect())
    if not rows:
        return Voter(np.zeros(TERMS + 1, np.float32), np.zeros((TERMS + 1, 1), np.float32),
                     np.zeros((0, 1), np.float32), np.zeros(0), 0.5, k, power)
    y = np.array([r.y for r in rows], float)
    a = np.stack([np.frombuffer(r.x, np.float32) for r in rows])
    del rows
    mean = a.mean(0)
    a -= mean
    # Truncated SVD by subspace iteration: only tall, thin products.
    rng = np.random.default_rng(11)
    q = rng.standard_normal((a.shape[1], dims + 16)).astype(np.float32)
    for _ in range(4):
        q, _ = np.linalg.qr(a.T @ (a @ q))
    _, s, vt = np.linalg.svd(a @ q, full_matrices=False)
    basis = (q @ vt.T)[:, :dims] / np.sqrt(np.maximum(s[:dims], 1e-6))
    z = a @ basis
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)
    return Voter(mean, basis.astype(np.float32), z.astype(np.float32), y, float(y.mean()), k, power)


def score(docs: DataFrame, voter: Voter, *, text: str = "text", to: str = "score") -> DataFrame:
    """``docs`` with the column ``to``: similarity-weighted vote of the nearest labelled texts, 0 to 1.

    No shuffle; the voter is broadcast once.  Null and empty texts get the
    mean label.  A column named ``to`` is replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(voter)

    @F.pandas_udf("double")
    def vote(texts: pd.Series) -> pd.Series:
        return pd.Series(held.value.scores(texts.tolist()))

    return docs.withColumn(to, vote.asNondeterministic()(F.col(text)))


def held_out(doc_id: str = "doc_id") -> Column:
    """The fold that no label is learnt from: crc32 of the id as text, remainder 1 of 3."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1


def quality(docs: DataFrame, labels: DataFrame, **kw) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 if score >= 0.5, else 0).

    A null doc_id is not held out and no label is learnt from it.
    """
    voter = fit(docs, labels, learn=~held_out(), **kw)
    scored = score(docs.select("doc_id", "text"), voter, to="score")
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
