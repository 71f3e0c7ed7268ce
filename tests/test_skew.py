"""A hot key holding a third of all rows: results stay exact, and the plans
fold the hot key map-side (partial aggregate before the shuffle)."""

import numpy as np
from pyspark.sql import functions as F

from framewise.operators import clean as C
from framewise.operators import frames as FR
from framewise.operators import metrics as M
from framewise.operators import reports as R
from framewise.streaming import incremental as INC


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _partial_before_exchange(plan: str) -> bool:
    lines = plan.split("\n")
    ex = [i for i, l in enumerate(lines) if "Exchange hashpartitioning" in l]
    # Hash, object-hash or sort-based: any aggregate below the first exchange
    # is the map-side (partial) half.
    return bool(ex) and any("Aggregate" in l and "partial_" in l or "HashAggregate" in l
                            for l in lines[ex[0] + 1:])


def test_hot_duplicate_group_in_clean_job(spark):
    hot = spark.range(3000).select(F.lit("hot").alias("vidname"), F.lit(1).alias("startframe"),
                                   F.lit("y").alias("youtubeid"), F.lit("Day").alias("timing"),
                                   F.lit("Normal").alias("weather"), F.lit("Yes").alias("egoinvolve"))
    rest = spark.range(6000).select(F.concat(F.lit("v"), F.col("id").cast("string")).alias("vidname"),
                                    F.lit(1).alias("startframe"), F.lit("y").alias("youtubeid"),
                                    F.lit("Night").alias("timing"), F.lit("Rainy").alias("weather"),
                                    F.lit("No").alias("egoinvolve"))
    df = hot.unionByName(rest).repartition(8)
    out = C.clean_records(df)
    assert out.count() == 6001
    assert _partial_before_exchange(_plan(out))


def test_hot_key_upsert(spark):
    versions = spark.range(5000).select(F.lit(7).cast("long").alias("image_id"), F.col("id").alias("_version"),
                                        (F.col("id") * 1.0).alias("d"))
    others = spark.range(10000).select((F.col("id") + 100).alias("image_id"), F.lit(0).cast("long").alias("_version"),
                                       F.lit(0.5).alias("d"))
    base = versions.unionByName(others).repartition(8)
    merged = INC.upsert_latest(base, base.limit(0), "image_id")
    got = {r.image_id: r.d for r in merged.where("image_id = 7 OR image_id = 100").collect()}
    assert got == {7: 4999.0, 100: 0.5}
    assert merged.count() == 10001
    assert _partial_before_exchange(_plan(merged))


def test_hot_sequence_in_grouped_stats(spark):
    # 300 records share one sequence id (a third of all records).
    rows = [("hot" if i < 300 else f"v{i}", "Day", "Normal", "Yes", 1, i % 2, None) for i in range(900)]
    from helpers import records_df
    rec = records_df(spark, [(str(i),) + r[1:] for i, r in enumerate(rows)]).withColumn(
        "sequence_id", F.when(F.col("vidname").cast("int") < 300, F.lit(-1).cast("long")).otherwise(F.col("sequence_id")))
    seq = M.sequence_stats(FR.to_frame_rows(rec, 3))
    hot = seq.where("sequence_id = -1").collect()[0]
    assert (hot.crash_count, hot.total_frames) == (300 + 150, 900)
    assert abs(hot.crash_density - 450 / 600) < 1e-12
    assert seq.count() == 601
    assert _partial_before_exchange(_plan(seq))


def test_hot_weather_boxplot_matches_numpy(spark):
    rng = np.random.default_rng(3)
    hot = rng.integers(0, 51, size=3000)
    cold = rng.integers(0, 51, size=600)
    data = [(int(i), "Normal", int(c)) for i, c in enumerate(hot)] + \
           [(10_000 + int(i), "Rainy", int(c)) for i, c in enumerate(cold)]
    flagged = (spark.createDataFrame(data, "sequence_id long, weather string, crash_count long")
               .withColumn("is_anomaly", F.lit(False)))
    box = {r.weather: r for r in R.weather_boxplot(flagged).collect()}
    for name, values in (("Normal", hot), ("Rainy", cold)):
        q1, med, q3 = np.percentile(values, [25, 50, 75])
        b = box[name]
        assert (b.q1, b.median, b.q3) == (q1, med, q3)
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = values[(values >= lo) & (values <= hi)]
        assert (b.whisker_low, b.whisker_high) == (inside.min(), inside.max())
        assert b.n_outliers == int(((values < lo) | (values > hi)).sum())
        assert b.n_sequences == len(values)
