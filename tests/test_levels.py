"""Levelled logs: folding, retention, replays, lookups by bucket, and the self-time stream on top of them."""

import math
import os
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType

from tracewell.operators import selftime
from tracewell.sinks import levels
from tracewell.streaming import telemetry as stream

SPEC = levels.Spec(
    "log",
    levels.columns(*((c, LongType()) for c in ("k", "n", "high", "value", "version")), ("day", DateType())),
    keys=("k", "day"),
    route=("k",),
    sums=("n",),
    maxima=("high",),
    newest=("value",),
    version="version",
    day="day",
)
START = date(2024, 1, 1)


def batch_rows(spark, batch, keys, per_day=10):
    day = START + timedelta(days=batch // per_day)
    return spark.createDataFrame([(k, 1, batch, 100 * batch + k, batch, day) for k in keys], SPEC.schema)


def plain(df):
    return sorted(map(tuple, df.select("k", "n", "high", "value", "version").collect()))


def test_rows_are_rewritten_logarithmically_often(spark, tmp_path):
    log = levels.Log(spark, str(tmp_path), SPEC, fanout=3, bucket_bytes=2000, grace=1)
    draw, added, rewritten, seen, model = random.Random(1), 0, 0, set(), {}
    for batch in range(19):
        keys = draw.sample(range(40), 10)
        for k in keys:
            day = START + timedelta(days=batch // 10)
            n = model.get((k, day), (0,))[0]
            model[k, day] = (n + 1, batch, 100 * batch + k, batch)
        manifest = log.add(batch_rows(spark, batch, keys), batch)
        added += len(keys)
        new = [r for r in manifest.runs if r.level and r.name not in seen]
        seen |= {r.name for r in new}
        rewritten += sum(log._rows([f"run={r.name}/{f}" for f in r.folders]).count() for r in new)
    assert 0 < rewritten <= added * math.log(19, 3) and manifest.rewritten > 0 < manifest.added
    assert len(manifest.runs) <= 2 * (1 + math.log(19, 3))
    assert max(r.bits for r in manifest.runs) >= 2
    assert plain(log.folded()) == sorted((k, *v) for (k, _), v in model.items())
    assert log.batches() == [17, 18]


def test_replays_and_unfinished_batches_change_nothing(spark, tmp_path):
    log = levels.Log(spark, str(tmp_path), SPEC, fanout=2)
    for batch in range(3):
        first = log.add(batch_rows(spark, batch, [1, 2]), batch)
        assert log.add(batch_rows(spark, batch, [7]), batch) == first  # a replay holds the same rows; these are never read
    whole = plain(log.folded())
    log._write(batch_rows(spark, 3, [1]).withColumn("bucket", F.lit(0)), "0-3-3", 0, 0)  # stopped before its manifest
    assert plain(log.folded()) == whole == [(1, 3, 2, 201, 2), (2, 3, 2, 202, 2)]
    log.add(batch_rows(spark, 3, [1, 2]), 3)
    assert plain(log.folded()) == [(1, 4, 3, 301, 3), (2, 4, 3, 302, 3)]
    assert plain(log.folded(upto=1)) == [(1, 2, 1, 101, 1), (2, 2, 1, 102, 1)]


def test_readers_of_an_earlier_state_go_on(spark, tmp_path):
    log = levels.Log(spark, str(tmp_path), SPEC, fanout=2, grace=3)
    log.add(batch_rows(spark, 0, [1]), 0)
    held = log.folded()
    for batch in (1, 2, 3):
        log.add(batch_rows(spark, batch, [1]), batch)
    assert plain(held) == [(1, 1, 0, 1, 0)]


def test_old_days_are_dropped_as_folders(spark, tmp_path):
    log = levels.Log(spark, str(tmp_path), SPEC, keep=timedelta(days=2), fanout=3, grace=1)
    unknown = spark.createDataFrame([(99, 1, 0, 0, 0, None)], SPEC.schema)
    for batch in range(12):
        manifest = log.add(batch_rows(spark, batch, [1, 2], per_day=2).unionByName(unknown), batch)
    assert (manifest.newest_day, manifest.oldest_day) == ("2024-01-06", "2024-01-04")
    assert {r.day for r in log.read().collect()} == {None, date(2024, 1, 4), date(2024, 1, 5), date(2024, 1, 6)}
    there = {p.name for p in (tmp_path / "log" / "runs").glob("*/*") if p.is_dir()}
    assert there == {"day=2024-01-04", "day=2024-01-05", "day=2024-01-06", f"day={levels.NO_DAY}"}
    runs, known = {p.name for p in (tmp_path / "log" / "runs").iterdir()}, [manifest, log.manifest(upto=10)]
    assert runs == {f"run={r.name}" for m in known for r in [*m.runs, m.own]}
    assert plain(log.folded(days=(date(2024, 1, 4), date(2024, 1, 4)))) == [(1, 2, 7, 701, 7), (2, 2, 7, 702, 7)]
    with pytest.raises(ValueError, match="no day"):
        levels.Log(spark, str(tmp_path), stream.DELTA_LOG, keep=timedelta(days=1))


def test_empty_batches(spark, tmp_path):
    log = levels.Log(spark, str(tmp_path), SPEC)
    assert log.folded().collect() == [] and log.manifest().batch == -1
    assert log.add(batch_rows(spark, 0, [1]).where("false"), 0).runs == [] and log.manifest().batch == 0
    assert log.folded(touching=batch_rows(spark, 0, [1])).collect() == []
    log.add(batch_rows(spark, 1, [1]), 1)
    assert len(log.folded().collect()) == 1


def opened(df):
    return sum(os.path.getsize(f.removeprefix("file://")) for f in df.inputFiles())


def test_bytes_opened_for_a_batch_stay_flat(spark, tmp_path):
    """Fifty equal batches of new keys; now and then three keys of any earlier batch are looked up."""
    log = levels.Log(spark, str(tmp_path), SPEC, fanout=4, bucket_bytes=2500)
    draw, opened_for, size = random.Random(5), {}, 200
    for batch in range(50):
        if batch % 4 == 3:  # there are most runs then
            asked = {draw.randrange(size * batch) for _ in range(3)}
            wanted = spark.createDataFrame([(k,) for k in asked], "k long")
            found = log.read(touching=wanted)
            assert {r.k for r in found.join(wanted, "k", "left_semi").collect()} == asked
            opened_for[batch] = opened(found)
        new = spark.range(size * batch, size * (batch + 1), numPartitions=1)
        log.add(new.selectExpr("id AS k", "1L AS n", "0L AS high", "0L AS value", "0L AS version", "DATE'2024-01-01' AS day"), batch)
    late, early = max(opened_for[b] for b in (35, 39, 43, 47)), max(opened_for[b] for b in (15, 19, 23, 27, 31))
    assert late <= 1.5 * early and opened(log.read()) > 2 * late


def spans_of(spark, rows):
    return spark.createDataFrame(
        rows, "traceId string, spanId string, parentSpanId string, name string, elapsedTimeMillis long, eventTime timestamp_ntz"
    )


def test_pairs_any_distance_apart_equal_the_batch_result(spark, tmp_path):
    draw, everything, batches = random.Random(9), [], [[] for _ in range(8)]
    for trace in range(60):
        for span in range(5):
            parent = str(draw.randrange(span)) if span else draw.choice(["", None])
            at = datetime(2024, 1, 1) + timedelta(hours=draw.randrange(200))
            row = (f"t{trace}", str(span), parent, f"op{draw.randrange(3)}", draw.choice([None, span, 10 * trace]), draw.choice([at, at, None]))
            for _ in range(draw.choice([1, 1, 1, 2])):
                batches[draw.randrange(8)].append(row)
    batches[4] += [(None, "1", "0", "lost", 5, None), ("t1", None, "0", "lost", 7, None), (None, None, None, None, None, None)]
    for i, part in enumerate(batches):
        everything += part
        for _ in range(2 if i % 5 == 0 else 1):  # some batches are replayed
            stream._add_self_time(spans_of(spark, part), str(tmp_path), i, fanout=3, bucket_bytes=3000, grace=1)
    got = stream.operation_execution_time(spark, str(tmp_path))
    want = selftime.operation_execution_time(spans_of(spark, everything))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want.select(*got.columns).collect())))


def test_lateness_drops_old_pairs(spark, tmp_path):
    at = [datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 20)]
    for i, row in enumerate(
        [("t", "p", "", "parent", 100, at[0]), ("t", "c", "p", "child", 30, at[1]), ("x", "q", "", "other", 1, at[2]), ("t", "d", "p", "child", 9, at[2])]
    ):
        stream._add_self_time(spans_of(spark, [row]), str(tmp_path), i, lateness=timedelta(days=5))
    got = {r.name: r.elapsed for r in stream.operation_execution_time(spark, str(tmp_path)).collect()}
    assert got == {"parent": 70, "child": 39, "other": 1}
