"""Crash-severity classifier: indexed categorical features → random forest.

Spark ML trains on the executors (tree statistics are aggregated per
partition), so nothing is collected to the driver; accuracy is returned as a
one-row DataFrame.  A fitted forest is also a table of nodes (``forest_nodes``),
and rows are scored by joins down its trees (``score_with_nodes``): the model
can be stored, read and checked as data, in SQL too.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FEATURES = ["timing", "weather", "egoinvolve"]
LABEL = "crash_severity"
#: Leading bits of a hash that name its bucket in a split.
SPLIT_BITS = 12


def ml_split(df: DataFrame, key: str = "sequence_id", label: str = LABEL, part: tuple[int, int] = (1, 5)) -> tuple[DataFrame, DataFrame]:
    """(train, test): the test rows are the lowest ``part`` (1 of 5) of the MD5 hashes of ``key``, label by label.

    The same rows whatever the partitioning.  Each label's hashes are counted
    by their first bits; whole buckets fall to one side, and only the rows of
    the one bucket that holds a label's border are ranked.  The share is
    rounded down.  Null keys hash as the empty text; a null label is a label;
    rows that repeat a key are ranked among each other in no fixed order.
    """
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    nibbles = SPLIT_BITS // 4
    rows = df.withColumn("_hash", digest).withColumn("_bucket", F.substring("_hash", 1, nibbles))
    counts = rows.groupBy(F.col(label).alias("_label"), "_bucket").agg(F.count("*").alias("_n"))
    run = Window.partitionBy("_label").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # 2**SPLIT_BITS rows a label
    counts = counts.select("_label", F.col("_bucket").alias("_b"), "_n", F.coalesce(F.sum("_n").over(run), F.lit(0)).alias("_before"),
                           F.expr(f"sum(_n) OVER (PARTITION BY _label) * {int(part[0])} DIV {int(part[1])}").alias("_need"))
    placed = rows.join(counts, rows[label].eqNullSafe(F.col("_label")) & (F.col("_bucket") == F.col("_b")))
    whole = F.col("_before") + F.col("_n") <= F.col("_need")
    border = ~whole & (F.col("_before") < F.col("_need"))
    rank = F.row_number().over(Window.partitionBy("_label", "_bucket").orderBy("_hash", key))
    inside = placed.where(border).withColumn("_test", rank <= F.col("_need") - F.col("_before"))
    marked = placed.where(~border).withColumn("_test", whole).unionByName(inside)
    return marked.where("NOT _test").select(*df.columns), marked.where("_test").select(*df.columns)


def severity_pipeline(features: list[str] | None = None, label: str = LABEL, num_trees: int = 100,
                      seed: int = 42) -> Pipeline:
    """String features are indexed (unseen/null values get their own index)."""
    features = features or FEATURES
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in features]
    vec = VectorAssembler(inputCols=[f"{c}_idx" for c in features], outputCol="features")
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=num_trees, seed=seed)
    return Pipeline(stages=[*idx, vec, rf])


def train_severity_model(train: DataFrame, features: list[str] | None = None, label: str = LABEL,
                         num_trees: int = 100) -> PipelineModel:
    data = train.withColumn(label, F.col(label).cast("double"))
    return severity_pipeline(features, label, num_trees).fit(data)


def predict(model: PipelineModel, df: DataFrame, label: str = LABEL) -> DataFrame:
    return model.transform(df.withColumn(label, F.col(label).cast("double")))


def model_accuracy(predictions: DataFrame, label: str = LABEL) -> DataFrame:
    """Share of test rows whose prediction equals the label (one row)."""
    return predictions.agg(F.avg((F.col("prediction") == F.col(label)).cast("double")).alias("accuracy"),
                           F.count(F.lit(1)).alias("n_test"))


def forest_nodes(model: PipelineModel, path: str) -> DataFrame:
    """The forest as a table, written in Spark ML's own format under ``path``: one row a node.

    tree, node (0 is a tree's root), feature (position; -1 for a leaf),
    left_categories (indexes that go left; null where a number is compared),
    threshold (values up to it go left), left, right (nodes), votes (share of
    each class among the node's training rows).  Its size is that of the model:
    at most 2^(depth + 1) rows a tree.
    """
    forest = _forest(model)
    forest.write().overwrite().save(path)
    data = SparkSession.active().read.parquet(f"{path}/data")
    node = data.select(F.col("treeID").alias("tree"), "nodeData.*")
    split = F.col("split")
    nominal = split["numCategories"] >= 0
    total = F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x)
    return node.select(
        "tree", F.col("id").alias("node"), F.when(F.col("leftChild") >= 0, split["featureIndex"]).otherwise(-1).alias("feature"),
        F.when((F.col("leftChild") >= 0) & nominal, split["leftCategoriesOrThreshold"]).alias("left_categories"),
        F.when((F.col("leftChild") >= 0) & ~nominal, split["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.col("leftChild").alias("left"), F.col("rightChild").alias("right"),
        F.transform("impurityStats", lambda x: x / total).alias("votes"))


def _forest(model: PipelineModel) -> RandomForestClassificationModel:
    return next(s for s in model.stages if isinstance(s, RandomForestClassificationModel))


def forest_size(model: PipelineModel) -> tuple[int, int]:
    """(trees, levels below a root at most)."""
    forest = _forest(model)
    return forest.getNumTrees, forest.getMaxDepth()


def feature_codes(model: PipelineModel) -> dict[str, list[str]]:
    """Per feature its categories in the order of their indexes; any other value and null have the next one."""
    return {s.getInputCol(): list(s.labels) for s in model.stages if isinstance(s, StringIndexerModel)}


def score_with_nodes(rows: DataFrame, nodes: DataFrame, codes: dict[str, list[str]], size: tuple[int, int],
                     key: str = "sequence_id") -> DataFrame:
    """``key, prediction`` from joins down the trees: one join a level, then the votes of all trees added.

    ``key`` is unique, ``size`` is ``forest_size``.  Rows of equal codes go down
    each tree as one: there are at most as many as the model's categories (and
    one more a feature) combine to, however many rows.  The node table, which
    has the model's size, is the small side of every join.
    Equal votes give the lower class.
    """
    def code(c: str):
        known = F.array(*(F.lit(x) for x in codes[c])).cast("array<string>")
        at = F.array_position(known, F.col(c))
        return F.when(F.col(c).isNull() | (at == 0), F.lit(len(codes[c]))).otherwise(at - 1).cast("double")

    n_trees, levels = size
    here = nodes.select([F.col(c).alias(f"_{c}") for c in nodes.columns])
    value = F.get("_x", F.col("_feature"))
    goes_left = F.coalesce(F.array_contains("_left_categories", value), value <= F.col("_threshold"))
    coded = rows.select(F.col(key).alias("_key"), F.array(*(code(c) for c in codes)).alias("_x"))
    step = coded.select("_x").distinct().select(
        "_x", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))).alias("tree"), F.lit(0).alias("node"))
    done = []
    for _ in range(levels + 1):
        met = step.join(here, (F.col("tree") == F.col("_tree")) & (F.col("node") == F.col("_node")))
        done.append(met.where("_left < 0").select("_x", "_votes"))
        step = met.where("_left >= 0").select("_x", "tree", F.when(goes_left, F.col("_left")).otherwise(F.col("_right")).alias("node"))
    votes = reduce(DataFrame.unionByName, done).select("_x", F.posexplode("_votes").alias("class", "vote"))
    votes = votes.groupBy("_x", "class").agg(F.sum("vote").alias("vote"))
    best = votes.groupBy("_x").agg(F.max_by("class", F.struct("vote", -F.col("class"))).alias("prediction"))
    best = best.select(F.col("_x").alias("_best"), F.col("prediction").cast("double").alias("prediction"))
    return coded.join(best, F.col("_x") == F.col("_best")).select(F.col("_key").alias(key), "prediction")
