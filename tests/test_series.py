"""Counters over time and data points of metrics."""

import json
from collections import defaultdict
from datetime import datetime, timedelta

from tracewell.operators import flatten, points
from tracewell.sources import telemetry
from tracewell.streaming import counters

START = datetime(2024, 1, 1, 22)


def test_series_have_no_gaps_and_take_late_rows(spark, tmp_path):
    rows = [("a", START), ("b", START + timedelta(hours=1)), ("a", START + timedelta(hours=50)), ("b", None)]
    late = [(None, START + timedelta(hours=3)), ("a", START + timedelta(minutes=59)), ("a", START - timedelta(hours=1))]
    log = counters.levels.Log(spark, str(tmp_path), counters.spec("c", ["k"]), fanout=2)
    for i, part in enumerate((rows, late, [], late[:0])):
        table = spark.createDataFrame(part, "k string, at timestamp_ntz")
        for _ in range(2):
            log.add(counters.increments(table, ["k"], "at", "1 hour"), i)
    got = defaultdict(dict)
    for r in counters.series(spark, str(tmp_path), "c", ["k"], "1 hour").collect():
        got[r.k][r.time] = r.total
    end = START + timedelta(hours=50)
    for label in ("a", "b", None):
        times = sorted(t for k, t in rows + late if k == label and t)
        begin = times[0].replace(minute=0)
        want, at = {}, begin
        while at <= end:
            want[at] = sum(t < at + timedelta(hours=1) for t in times)
            at += timedelta(hours=1)
        assert got[label] == want, label
    assert counters.series(spark, str(tmp_path), "none", ["k"]).collect() == []


def test_increments_of_a_value(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([("a", START, 3), ("a", START, 4)], "k string, at timestamp_ntz, n int")
    found = counters.increments(rows, ["k"], "at", "1 minute", F.col("n")).collect()
    assert [(r.k, r.time, r.added) for r in found] == [("a", START, 7)]


def test_data_points_of_all_kinds(spark, tmp_path):
    metrics = [
        {"name": "s", "unit": "1", "sum": {"dataPoints": [{"asInt": "5", "timeUnixNano": "9"}, {"asDouble": 1.5}, {}]}},
        {"name": "g", "gauge": {"dataPoints": []}},
        {"name": "h", "histogram": {"dataPoints": [
            {"count": "3", "sum": 7.5, "min": 1, "max": 4, "bucketCounts": ["1", "2"], "explicitBounds": [2.5]},
            {"count": "0"},
        ]}},
        {"name": "q", "summary": {"dataPoints": [{"count": "2", "sum": 3, "attributes": [{"key": "k"}]}]}},
        {"name": "none"},
    ]
    (tmp_path / "m.json").write_text(json.dumps({"resourceMetrics": [{"scopeMetrics": [{"metrics": metrics}]}]}))
    found = points.data_points(flatten.metrics(telemetry.metrics(spark, str(tmp_path)))).collect()
    got = sorted((r.name, r.kind, r.point_no, r.value, r["count"], r["sum"], r["min"], r["max"], r.bounds, r.buckets) for r in found)
    nothing = (None,) * 5
    assert got == [
        ("h", "histogram", 0, None, 3, 7.5, 1.0, 4.0, [2.5], [1, 2]),
        ("h", "histogram", 1, None, 0, *nothing),
        ("q", "summary", 0, None, 2, 3.0, *nothing[:4]),
        ("s", "sum", 0, 5.0, None, *nothing),
        ("s", "sum", 1, 1.5, None, *nothing),
        ("s", "sum", 2, None, None, *nothing),
    ]
    assert [r.time_nanos for r in found if r.value == 5.0] == [9]
    assert [str(r.attributes) for r in found if r.attributes is not None] == ['[{"key":"k"}]']
