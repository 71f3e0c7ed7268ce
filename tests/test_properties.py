"""Property tests (hypothesis) on random small record tables."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import records_df
from framewise.operators import anomaly as A
from framewise.operators import clean as C
from framewise.operators import frames as FR
from framewise.operators import metrics as M
from framewise.operators import reports as R
from framewise.streaming import incremental as INC

flag = st.one_of(st.none(), st.integers(0, 1))
record = st.tuples(st.sampled_from(["Day", "Night", None, "Monday"]),
                   st.sampled_from(["Normal", "Rainy", None]),
                   st.sampled_from(["Yes", "No"]), flag, flag, flag)
tables = st.lists(record, min_size=1, max_size=12)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _records(spark, rows):
    return records_df(spark, [(str(i + 1), *r) for i, r in enumerate(rows)])


@SETTINGS
@given(rows=tables)
def test_folded_equals_grouped(spark, rows):
    rec = _records(spark, rows)
    g = M.sequence_stats(FR.to_frame_rows(rec, 3))
    f = M.sequence_stats_from_records(rec, 3)
    assert g.exceptAll(f).count() == 0 and f.exceptAll(g).count() == 0


@SETTINGS
@given(rows=tables)
def test_heatmap_cells_sum_to_total(spark, rows):
    frames = FR.to_frame_rows(_records(spark, rows), 3)
    heat = R.crash_heatmap(frames, 3)
    cells = heat.select(sum((F.col(f"f_{i}") for i in range(3)), F.lit(0)).alias("s")).agg(F.sum("s")).collect()[0][0]
    total = M.crash_metrics(frames).collect()[0].total_crashes or 0
    assert (cells or 0) == total


@SETTINGS
@given(rows=tables)
def test_histogram_and_threshold_invariants(spark, rows):
    seq = M.sequence_stats_from_records(_records(spark, rows), 3)
    n_counted = seq.where("crash_count IS NOT NULL").count()
    hist = R.crash_histogram(seq).collect()
    assert sum(r["count"] for r in hist) == n_counted
    th = M.anomaly_thresholds(seq).collect()[0]
    if th.final_threshold is not None:
        assert th.final_threshold <= th.percentile_threshold
        if th.statistical_threshold is not None:
            assert th.final_threshold <= th.statistical_threshold
    flagged = A.flag_anomalies(seq)
    assert flagged.count() == len(rows)


@SETTINGS
@given(rows=tables)
def test_clean_is_idempotent_when_all_columns_kept(spark, rows):
    df = _records(spark, rows).select("vidname", "timing", "weather", "egoinvolve")
    once = C.clean_records(df, df.columns)
    twice = C.clean_records(once, df.columns)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


@SETTINGS
@given(values=st.lists(st.integers(0, 5), min_size=1, max_size=30), block=st.sampled_from([1, 2, 4, 4096]))
def test_running_total_matches_cumsum(spark, values, block):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "batch_id long, processed long")
    got = [r.running_total for r in INC.running_total(df, "batch_id", "processed", block=block)
           .orderBy("batch_id").collect()]
    acc, want = 0, []
    for v in values:
        acc += v
        want.append(acc)
    assert got == want


def test_upsert_latest_wins(spark):
    base = spark.createDataFrame([(1, "a", 0.0), (2, "b", 0.0)], "image_id long, filename string, d double")
    upd = spark.createDataFrame([(2, "b", 0.5), (3, "c", 0.7)], "image_id long, filename string, d double")
    got = {r.image_id: r.d for r in INC.upsert_latest(base, upd).collect()}
    assert got == {1: 0.0, 2: 0.5, 3: 0.7}


def test_write_upsert_is_idempotent_and_partition_local(spark, tmp_path):
    table = str(tmp_path / "features")
    first = spark.createDataFrame([(1, 10, 0.1), (1, 11, 0.2), (2, 20, 0.3)], "video long, image_id long, d double")
    INC.write_upsert(spark, table, first, key="image_id", partition_col="video")
    upd = spark.createDataFrame([(1, 11, 0.9), (1, 12, 0.5)], "video long, image_id long, d double")
    for _ in range(2):  # a replayed micro-batch must leave the same table
        INC.write_upsert(spark, table, upd, key="image_id", partition_col="video", partitions=[1])
    got = {(r.video, r.image_id): r.d for r in spark.read.parquet(table).collect()}
    assert got == {(1, 10): 0.1, (1, 11): 0.9, (1, 12): 0.5, (2, 20): 0.3}
