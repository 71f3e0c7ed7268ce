"""Reports derived from the frame cube equal the reports over raw frame rows."""

import pytest

from conftest import SF001
from framewise.operators import cube as CB
from framewise.operators import metrics as M
from framewise.operators import reports as R
from framewise.plans import tables as TB
from framewise.plans.registry import round_doubles

PAIRS = [
    ("crash_metrics", M.crash_metrics, CB.crash_metrics),
    ("crash_summary", R.crash_summary, CB.crash_summary),
    ("crashes_by_time", R.crashes_by_time, CB.crashes_by_time),
    ("crashes_by_ego", R.crashes_by_ego, CB.crashes_by_ego),
    ("crashes_by_weather", R.crashes_by_weather, CB.crashes_by_weather),
    ("crash_distribution", R.crash_distribution, CB.crash_distribution),
    ("frame_timeline", R.frame_timeline, CB.frame_timeline),
    ("startframe_counts", R.startframe_counts, CB.startframe_counts),
    ("crash_share", M.crash_share, CB.crash_share),
    ("rate_by_condition", M.rate_by_condition, CB.rate_by_condition),
]


@pytest.mark.parametrize("name,direct,from_cube", PAIRS, ids=[p[0] for p in PAIRS])
def test_cube_equals_direct(spark, name, direct, from_cube):
    frames = TB.frames(spark, SF001)
    a = round_doubles(direct(frames))
    b = round_doubles(from_cube(CB.frame_cube(frames)))
    assert a.schema.simpleString() == b.schema.simpleString()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_heatmap_from_records_equals_grouped(spark):
    rec = TB.records(spark, SF001)
    a = R.crash_heatmap(TB.frames(spark, SF001))
    b = CB.heatmap_from_records(rec)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
