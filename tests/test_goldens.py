"""Goldens from FIXTURES.md (Spark and DuckDB agreed on them independently)."""

import pytest

from conftest import SF001, SF01
from framewise.operators import anomaly as A
from framewise.operators import clean as C
from framewise.operators import features as FT
from framewise.operators import metrics as M
from framewise.plans import tables as TB


@pytest.mark.parametrize("sf,seqs,crashes,p90,final,anomalies,cleaned", [
    (SF001, 200, 1800, 12.0, 11.684405, 39, 132),
    (SF01, 2000, 18213, 13.0, 11.898463, 371, 1241),
])
def test_pipeline_goldens(spark, sf, seqs, crashes, p90, final, anomalies, cleaned):
    frames = TB.frames(spark, sf)
    m = M.crash_metrics(frames).collect()[0]
    assert m.total_frames == seqs * 50
    assert m.total_crashes == crashes
    seq = TB.sequences(spark, sf)
    th = M.anomaly_thresholds(seq).collect()[0]
    assert th.percentile_threshold == p90
    assert round(th.final_threshold, 6) == final
    fl = A.flag_anomalies(seq, M.anomaly_thresholds(seq))
    assert fl.count() == seqs
    assert fl.where("is_anomaly").count() == anomalies
    assert C.clean_records(TB.cleaning_input(spark, sf)).count() == cleaned


def test_pixel_foreground_golden(spark):
    fg = FT.pixel_foreground(TB.pixels(spark, SF001))
    row = fg.agg({"foreground": "sum", "*": "count"}).collect()[0]
    assert row["count(1)"] == 32000
    assert row["sum(foreground)"] == 1760


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() == 200
    assert set(E.oracle_sql()) <= set(E.queries())
