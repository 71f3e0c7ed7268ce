"""Corpus pipeline: documents -> clean, deduplicated, decontaminated, tokenized.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``docs`` as they came (line dedup edits ``text``);
``sf_dir`` is read for the side tables only (labels, benchmark, and the
documents that the labels belong to).  Null, empty and repeated rows pass as
the operators' docstrings say; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framewise.llm import decontaminate, jaccard_join, line_dedup, pieces, toxicity
from framewise.llm.queries import PIECES, toxicity_model
from framewise.session import materialize, ship_package


#: Sites from which a line is boilerplate: earlier stages and a source that holds a third of the
#: documents leave a passage fewer sites than it had.
MIN_SITES = 5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Classifier chain: documents it finds toxic go."""
    return toxicity.reject(docs, toxicity_model(spark, sf_dir))


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines spread over many sites go, except where they stand first; documents left without any line go."""
    return line_dedup.remaining(docs, min_sites=MIN_SITES)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked shingle sets stays: the one of least id."""
    return jaccard_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids with merge-dropout: doc_id, n_tokens, token_ids, lossless."""
    return pieces.tokenized(docs, pieces.PieceTable.load(PIECES))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pieces", encode_pieces),
]

#: The classifier and the merge agenda are not SQL; tests hold run() against a plain re-computation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, with a table written after each."""
    docs = ship_package(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
