"""Named queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Double columns are rounded to 6 places so results compare exactly with the
SQL oracles in ``framewise.plans.oracles`` (engines differ in the last bit).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewise.operators import anomaly as A
from framewise.operators import clean as C
from framewise.operators import frames as FR
from framewise.operators import metrics as M
from framewise.operators import reports as R
from framewise.plans import tables as TB
from framewise.schemas import RECORD_ATTRS
from framewise.session import shared_dir
from framewise.sources import catalog as SC
from framewise.sources import records as SR
from framewise.sources import sinks as SK

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name).cast("double"), places).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def query(name: str):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return deco


# ---------------------------------------------------------------- frames (P)

@query("frame_rows")
def _frame_rows(spark, d):
    return TB.frames(spark, d)


@query("time_of_day")
def _time_of_day(spark, d):
    from framewise.functions.columns import time_of_day
    return TB.records(spark, d).select("sequence_id", "timing", time_of_day("timing").alias("time_of_day"))


@query("crash_frames")
def _crash_frames(spark, d):
    return FR.crash_frames(TB.frames(spark, d)).select("sequence_id", "frame_number", "time_of_day",
                                                        "weather", "egoinvolve")


@query("frame_level_data")
def _frame_level_data(spark, d):
    return FR.frame_level_data(TB.frames(spark, d))


@query("default_startframe")
def _default_startframe(spark, d):
    f = FR.default_startframe(TB.frames(spark, d).drop("startframe"))
    return f.select("sequence_id", "frame_number", "startframe")


@query("sequence_ids")
def _sequence_ids(spark, d):
    rec = TB.records(spark, d).drop("sequence_id")
    ids = FR.add_sequence_id(FR.add_sequence_id(rec, "hash", ["vidname"], name="hash_id"),
                             "monotonic", name="mono_id")
    return ids.agg(F.count(F.lit(1)).alias("n_records"),
                   F.countDistinct("mono_id").alias("n_distinct_monotonic"),
                   F.countDistinct("hash_id").alias("n_distinct_hash"))


# ------------------------------------------------------- metrics / anomalies

@query("crash_metrics")
def _crash_metrics(spark, d):
    return M.crash_metrics(TB.frames(spark, d))


@query("row_counts")
def _row_counts(spark, d):
    return M.row_counts(records=TB.records(spark, d), frames=TB.frames(spark, d),
                        lineitem=TB.table(spark, d, "lineitem"))


@query("sequence_stats")
def _sequence_stats(spark, d):
    return M.sequence_stats(TB.frames(spark, d))


@query("sequence_stats_records")
def _sequence_stats_records(spark, d):
    return TB.sequences(spark, d)


@query("threshold_stats")
def _threshold_stats(spark, d):
    return M.threshold_stats(TB.sequences(spark, d))


@query("p90_threshold")
def _p90(spark, d):
    return M.p90_threshold(TB.sequences(spark, d))


@query("final_threshold")
def _final_threshold(spark, d):
    return M.final_threshold(TB.sequences(spark, d))


@query("sequence_level_data")
def _sequence_level_data(spark, d):
    return TB.flagged(spark, d)


@query("anomaly_metrics")
def _anomaly_metrics(spark, d):
    return A.anomaly_metrics(TB.flagged(spark, d))


# ------------------------------------------------------------------ reports

@query("crash_summary")
def _crash_summary(spark, d):
    return R.crash_summary(TB.frames(spark, d))


@query("crashes_by_time")
def _crashes_by_time(spark, d):
    return R.crashes_by_time(TB.frames(spark, d))


@query("anomaly_summary")
def _anomaly_summary(spark, d):
    return R.anomaly_summary(TB.flagged(spark, d))


@query("weather_counts")
def _weather_counts(spark, d):
    return R.weather_counts(C.clean_records(TB.cleaning_input(spark, d)))


@query("crash_distribution")
def _crash_distribution(spark, d):
    return R.crash_distribution(TB.frames(spark, d))


@query("crashes_by_ego")
def _crashes_by_ego(spark, d):
    return R.crashes_by_ego(TB.frames(spark, d))


@query("crashes_by_weather")
def _crashes_by_weather(spark, d):
    return R.crashes_by_weather(TB.frames(spark, d))


@query("anomalies_by_time")
def _anomalies_by_time(spark, d):
    return R.anomalies_by_time(TB.flagged(spark, d))


@query("anomalies_by_weather")
def _anomalies_by_weather(spark, d):
    return R.anomalies_by_weather(TB.flagged(spark, d))


@query("anomaly_crosstab")
def _anomaly_crosstab(spark, d):
    return R.anomaly_crosstab(TB.flagged(spark, d))


@query("crash_heatmap")
def _crash_heatmap(spark, d):
    from framewise.operators.cube import heatmap_from_records
    return heatmap_from_records(TB.records(spark, d))


@query("frame_timeline")
def _frame_timeline(spark, d):
    return R.frame_timeline(TB.frames(spark, d))


@query("startframe_counts")
def _startframe_counts(spark, d):
    return R.startframe_counts(TB.frames(spark, d))


@query("crash_histogram")
def _crash_histogram(spark, d):
    return R.crash_histogram(TB.sequences(spark, d))


@query("weather_boxplot")
def _weather_boxplot(spark, d):
    return R.weather_boxplot(TB.flagged(spark, d))


@query("ego_scatter")
def _ego_scatter(spark, d):
    return R.ego_scatter(TB.flagged(spark, d))


@query("crash_share")
def _crash_share(spark, d):
    return M.crash_share(TB.frames(spark, d))


@query("kpi_cards")
def _kpi_cards(spark, d):
    return R.kpi_cards(M.crash_metrics(TB.frames(spark, d)), A.anomaly_metrics(TB.flagged(spark, d)))


@query("rate_by_condition")
def _rate_by_condition(spark, d):
    return M.rate_by_condition(TB.frames(spark, d))


@query("density_timeline")
def _density_timeline(spark, d):
    return R.density_timeline(TB.flagged(spark, d))


@query("density_by_sequence")
def _density_by_sequence(spark, d):
    seq = TB.sequences(spark, d)
    return R.density_by_sequence(A.flag_anomalies(seq), M.anomaly_thresholds(seq))


@query("frame_cube")
def _frame_cube(spark, d):
    from framewise.operators.cube import frame_cube
    return frame_cube(TB.frames(spark, d))


# -------------------------------------------------------------------- clean

@query("project_columns")
def _project_columns(spark, d):
    return C.project_columns(TB.cleaning_input(spark, d))


@query("drop_nulls")
def _drop_nulls(spark, d):
    return C.drop_nulls(TB.cleaning_input(spark, d))


@query("drop_duplicates")
def _drop_duplicates(spark, d):
    return C.drop_duplicates(TB.cleaning_input(spark, d))


@query("clean_records")
def _clean_records(spark, d):
    return C.clean_records(TB.cleaning_input(spark, d))


# ---------------------------------------------------------- sources / sinks

def _written_records(spark, d) -> str:
    """Write the bound crash records once (Parquet) and return the path."""
    path = shared_dir(spark, "records")
    SK.sink_parquet(TB.records(spark, d).drop("sequence_id"), path)
    return path


@query("scan_records")
def _scan_records(spark, d):
    return SR.scan_records(spark, _written_records(spark, d))


def _catalog_table(spark, df, name: str, key: str, partition_by=None) -> str:
    """A bucketed catalog table of its own for each run, its data under the shared folder."""
    path = shared_dir(spark, "catalog", name)
    return SC.save_bucketed(df, f"{name}_{path[-12:]}", key, buckets=8, partition_by=partition_by, path=path)


def _record_table(spark, d) -> str:
    return _catalog_table(spark, TB.records(spark, d), "crash_records_csv", "sequence_id", ["weather"])


@query("scan_catalog")
def _scan_catalog(spark, d):
    return SC.scan_catalog(spark, _record_table(spark, d)).select(*RECORD_ATTRS)


@query("scan_catalog_partition")
def _scan_catalog_partition(spark, d):
    """One partition value: only its folder is read."""
    return SC.scan_catalog(spark, _record_table(spark, d), weather="Snowy").select(*RECORD_ATTRS)


@query("catalog_sequence_stats")
def _catalog_sequence_stats(spark, d):
    """A3 in its grouped form over buckets of the id: no shuffle after the scan."""
    return M.sequence_stats(FR.to_frame_rows(SC.scan_catalog(spark, _record_table(spark, d))))


@query("scan_clean_parquet")
def _scan_clean_parquet(spark, d):
    path = shared_dir(spark, "clean")
    SK.sink_parquet(C.clean_records(TB.cleaning_input(spark, d)), path)
    return SR.scan_clean_parquet(spark, path)


@query("sink_parquet")
def _sink_parquet(spark, d):
    path = SK.sink_parquet(R.crash_summary(TB.frames(spark, d)), shared_dir(spark, "sink_parquet"))
    return spark.read.parquet(path)


@query("sink_json")
def _sink_json(spark, d):
    path = SK.sink_json(FR.frame_level_data(TB.frames(spark, d)), shared_dir(spark, "sink_json"))
    schema = FR.frame_level_data(TB.frames(spark, d)).schema
    return spark.read.schema(schema).json(path)


@query("sink_csv")
def _sink_csv(spark, d):
    df = R.crashes_by_time(TB.frames(spark, d))
    path = SK.sink_csv(df, shared_dir(spark, "sink_csv"), single_file=True)
    return spark.read.option("header", True).schema(df.schema).csv(path)


@query("metrics_export")
def _metrics_export(spark, d):
    metrics = A.analysis_metrics(M.crash_metrics(TB.frames(spark, d)), A.anomaly_metrics(TB.flagged(spark, d)))
    path = SK.metrics_export(metrics, shared_dir(spark, "metrics"))
    return spark.read.json(path).drop("validation_timestamp")


def queries() -> dict[str, Query]:
    # Import for side effects: the image, feature, streaming and model queries.
    from framewise.plans import registry_jobs, registry_media  # noqa: F401
    return dict(QUERIES)
