"""Registered queries of the training-data operators: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewise.session import ship_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship_package(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def harm_categories() -> dict:
    """Categories in chain order, from the judgements that ``labels`` carries."""
    return {"junk": F.expr("quality = 0"), "toxic": F.expr("toxic = 1")}


def toxicity_model(spark: SparkSession, sf_dir: str):
    from framewise.llm import toxicity
    return toxicity.fit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), harm_categories())


def op1_toxicity_chain(spark, sf_dir):
    from framewise.llm import toxicity
    return toxicity.classify(_table(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir))


def op2_line_spread(spark, sf_dir):
    from framewise.llm import line_dedup
    return line_dedup.dedup_report(_table(spark, sf_dir, "documents"))


def op3_knn_quality(spark, sf_dir):
    from framewise.llm import knn_quality
    return knn_quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_wu_manber(spark, sf_dir):
    from framewise.llm import decontaminate
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_count_rtree(spark, sf_dir):
    from framewise.llm import jaccard_join
    return jaccard_join.components(_table(spark, sf_dir, "documents"))


def op6_chat_windows(spark, sf_dir):
    from framewise.llm import chat
    conversations = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame([(-7, 0, "user", "</s>[INST] ok [/INST]"),
                                     (-7, 1, "assistant", "</s>[INST] ok [/INST]")], conversations.schema)
    return chat.read_back(chat.windows(conversations.unionByName(control)))


def op7_secret_ownership(spark, sf_dir):
    from framewise.llm import secret_scan
    return secret_scan.secrets(_table(spark, sf_dir, "documents"))


#: Vocabulary file of a public SentencePiece BPE tokenizer; read on the driver only.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def op8_merge_dropout(spark, sf_dir, model: str = PIECES):
    from framewise.llm import pieces
    return pieces.tokenized(_table(spark, sf_dir, "documents"), pieces.PieceTable.load(model), alpha=0.1, seed=1)


def op9_product_quantisation(spark, sf_dir):
    from framewise.llm import pq_neardup
    return pq_neardup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op10_license_minhash(spark, sf_dir):
    from framewise.llm import licenses
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op11_turn_trie(spark, sf_dir):
    from framewise.llm import turn_trie
    return turn_trie.conversation_trie(_table(spark, sf_dir, "conversations"))


def op12_fim_swar(spark, sf_dir):
    from framewise.llm import fill_middle
    return fill_middle.digests(fill_middle.transform(_table(spark, sf_dir, "documents")))


#: Tokenizers file (BPE with word ends) and the id that ends a document; read on the driver only.
WORDS, END_ID = "/opt/tokenizers/word_bpe_49k.json", 2


def op13_static_rans(spark, sf_dir, tokenizer: str = WORDS):
    from framewise.llm import token_files
    with open(tokenizer, encoding="utf-8") as f:
        files = token_files.write(_table(spark, sf_dir, "documents"), f.read(), end=END_ID)
    return token_files.documents(files)


def queries() -> dict:
    return {f.__name__: f for f in (
        op1_toxicity_chain, op2_line_spread, op3_knn_quality, op4_wu_manber, op5_count_rtree,
        op6_chat_windows, op7_secret_ownership, op8_merge_dropout, op9_product_quantisation,
        op10_license_minhash, op11_turn_trie, op12_fim_swar, op13_static_rans,
    )}
