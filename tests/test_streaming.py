"""Streams replayed in several micro-batches must agree with the batch result."""

import json
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tracewell import fixtures, schemas
from tracewell.catalogue import streams
from tracewell.catalogue import telemetry as telemetry_queries
from tracewell.operators import flatten, latency, selftime
from tracewell.plans import cart, dashboard
from tracewell.sinks import deltas, levels, tables
from tracewell.sources import catalog as catalog_source
from tracewell.sources import orders as order_source
from tracewell.sources import telemetry
from tracewell.streaming import cart as cart_stream
from tracewell.streaming import orders as order_stream
from tracewell.streaming import telemetry as stream

SF = "/root/testdata/sf0.001"


def put(folder, position, text):
    """A file whose modification time fixes its place in the replay."""
    file = folder / f"{position}.json"
    file.write_text(text)
    os.utime(file, (1_700_000_000 + 10 * position,) * 2)


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.select(*sorted(df.columns)).collect())))


@pytest.fixture(scope="module")
def request_files(spark, tmp_path_factory):
    """Requests of all events in shuffled files, with a late and a duplicated one."""
    folder = tmp_path_factory.mktemp("requests")
    lines = [
        r.value
        for r in fixtures.trace_requests(spark, SF)
        .select(F.to_json(F.struct("resourceSpans")).alias("value"))
        .collect()
    ]
    random.Random(7).shuffle(lines)
    lines.append(lines[3])
    lines.insert(5, '{"resourceSpans": [')
    for i in range(5):
        (folder / f"part-{i}.json").write_text("\n".join(lines[i::5]))
    return str(folder)


def test_maintained_tables_equal_batch(spark, request_files, tmp_path):
    store, checkpoint = str(tmp_path / "store"), str(tmp_path / "cp")

    def run():
        source = telemetry.traces(
            spark, request_files, fields=selftime.SPAN_FIELDS, envelope=False, stream=True, maxFilesPerTrigger="1"
        )
        query = stream.maintain(source, store, checkpoint, width="1 day", available_now=True)
        query.awaitTermination()

    run()
    run()  # nothing new: a restarted group resumes behind what it has read
    spans = flatten.spans(telemetry.traces(spark, request_files))
    assert levels.Log(spark, store, stream.COUNT_LOG).batches() == [0, 1, 2, 3, 4]
    expected = {
        "p95": latency.p95_latency(spans, "1 day"),
        "throughput": latency.throughput(spans, "1 day"),
        "self": selftime.operation_execution_time(spans),
    }
    readers = {
        "p95": stream.p95_latency,
        "throughput": stream.throughput,
        "self": stream.operation_execution_time,
    }
    for name, read in readers.items():
        assert rows(read(spark, store)) == rows(expected[name]), name


def test_replayed_batch_changes_nothing(spark, request_files, tmp_path):
    store = str(tmp_path / "store")
    spans = flatten.spans(telemetry.traces(spark, request_files)).drop("resource", "scope", "attributes", "events")
    halves = [spans.where("CAST(spanId AS INT) % 2 = 0"), spans.where("CAST(spanId AS INT) % 2 = 1")]
    for batch_id in (0, 1, 0, 1):
        half = halves[batch_id]
        stream._add_self_time(half, store, batch_id, lateness=timedelta(days=365))
    assert rows(stream.operation_execution_time(spark, store)) == rows(selftime.operation_execution_time(spans))


def test_empty_first_batch_and_unfinished_batches(spark, request_files, tmp_path):
    store = str(tmp_path / "store")
    spans = flatten.spans(telemetry.traces(spark, request_files)).drop("resource", "scope", "attributes", "events")
    for batch_id, part in enumerate((spans.where("false"), spans)):
        stream._add_self_time(part, store, batch_id, lateness=None)
    left = tmp_path / "store" / stream.SELF_DELTAS / "runs" / "run=0-2-2" / "bucket=0"  # without a manifest: not finished
    levels.Log(spark, store, stream.DELTA_LOG)._rows(["run=0-1-1/bucket=0"]).write.parquet(str(left))
    assert rows(stream.operation_execution_time(spark, store)) == rows(selftime.operation_execution_time(spans))


def test_streams_read_folders_of_files_in_several_batches(spark, tmp_path):
    fixtures.table(spark, SF, "events").repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    assert fixtures.stream(spark, str(tmp_path), "events").isStreaming
    store = streams._maintained(spark, str(tmp_path), "1 day", stream.SELF_DELTAS)
    assert levels.Log(spark, store, stream.DELTA_LOG).batches() == [0, 1, 2]
    got = stream.operation_execution_time(spark, store)
    assert rows(got) == rows(telemetry_queries.operation_execution_time(spark, SF))


def test_folded_levels_keep_results(spark, request_files, tmp_path):
    store = str(tmp_path / "store")
    source = telemetry.traces(
        spark, request_files, fields=selftime.SPAN_FIELDS, envelope=False, stream=True, maxFilesPerTrigger="1"
    )
    layout = {"fanout": 2, "bucket_bytes": 20_000, "grace": 1}
    stream.maintain(source, store, str(tmp_path / "cp"), width="1 day", available_now=True, **layout).awaitTermination()
    spans = flatten.spans(telemetry.traces(spark, request_files))
    assert rows(stream.operation_execution_time(spark, store)) == rows(selftime.operation_execution_time(spans))
    assert rows(stream.throughput(spark, store)) == rows(latency.throughput(spans, "1 day"))
    assert rows(stream.p95_latency(spark, store)) == rows(latency.p95_latency(spans, "1 day"))
    for spec in (stream.COUNT_LOG, stream.PARENT_LOG, stream.CHILD_LOG, stream.DELTA_LOG, stream.SERVED_LOG):
        log = levels.Log(spark, store, spec)
        assert {r.level for r in log.manifest().runs} == {0, 2} and log.batches() == [3, 4]
        here = {p.name for p in (tmp_path / "store" / spec.name / "runs").iterdir()}
        known = [log.manifest(), log.manifest(upto=3)]
        assert here == {f"run={r.name}" for m in known for r in [*m.runs, m.own]}


def test_served_series_reads_its_days_only(spark, request_files, tmp_path):
    store = str(tmp_path / "store")
    source = telemetry.traces(
        spark, request_files, fields=selftime.SPAN_FIELDS, envelope=False, stream=True, maxFilesPerTrigger="1"
    )
    kept = (stream.COUNTS,)
    stream.maintain(source, store, str(tmp_path / "cp"), available_now=True, tables_kept=kept, fanout=3).awaitTermination()
    spans = flatten.spans(telemetry.traces(spark, request_files))
    bounds = ("2024-01-03 00:00:00", "2024-01-05 12:00:00")
    for got, want in (
        (stream.p95_series, dashboard.p95_series(latency.p95_latency(spans), *bounds)),
        (stream.throughput_series, dashboard.throughput_series(latency.throughput(spans), *bounds)),
    ):
        series = got(spark, store, *bounds)
        assert rows(series) == rows(want) and rows(series)
        days = {f.split("/date=")[1].split("/")[0] for f in series.inputFiles()}
        assert days == {"2024-01-03", "2024-01-04", "2024-01-05"}


def test_flat_tables_append(spark, request_files, tmp_path):
    store = str(tmp_path / "store")
    source = telemetry.traces(spark, request_files, stream=True, maxFilesPerTrigger="2")
    stream.append_spans(source, store, str(tmp_path / "cp"), available_now=True).awaitTermination()
    written = tables.read(spark, store, "spans")
    batch = flatten.spans(telemetry.traces(spark, request_files))
    keep = ("traceId", "spanId", "elapsedTimeMillis", "eventTime")
    assert rows(written.select(*keep)) == rows(batch.select(*keep))
    bounds = ("2024-01-03 00:00:00", "2024-01-05 12:00:00")
    assert dashboard.requests_in_range(written, *bounds).first() == dashboard.requests_in_range(batch, *bounds).first()


def test_windowed_throughput_accepts_any_lateness(spark, request_files):
    source = telemetry.traces(
        spark, request_files, fields=latency.SPAN_FIELDS, envelope=False, stream=True, maxFilesPerTrigger="1"
    )
    result = stream.windowed_throughput(flatten.spans(source), "1 day")
    query = (
        result.writeStream.format("memory").queryName("late").outputMode("complete").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    spans = flatten.spans(telemetry.traces(spark, request_files))
    assert rows(spark.table("late")) == rows(latency.throughput(spans, "1 day"))


def test_watermark_drops_late_rows(spark, tmp_path):
    def line(seconds):
        span = {
            "parentSpanId": "",
            "startTimeUnixNano": str(seconds * 10**9),
            "endTimeUnixNano": str(seconds * 10**9 + 5),
        }
        return json.dumps({"resourceSpans": [{"scopeSpans": [{"spans": [span]}]}]})

    for i, seconds in enumerate((1000, 2000, 2001, 1001, 3000)):
        put(tmp_path, i, line(seconds))
    source = telemetry.traces(
        spark, str(tmp_path), fields=latency.SPAN_FIELDS, envelope=False, stream=True, maxFilesPerTrigger="1"
    )
    result = stream.windowed_throughput(flatten.spans(source), "10 seconds", lateness="60 seconds")
    query = (
        result.writeStream.format("memory").queryName("wm").outputMode("update").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    counted = {str(r.time): r.throughput for r in spark.table("wm").collect()}
    assert counted["1970-01-01 00:16:40"] == 1


ORDERS = [json.dumps({"order_id": f"o{i}", "items": [{"item": {"product_id": "p", "quantity": i}}]}) for i in range(6)]


def test_accounting_sets_bad_payloads_aside_and_resumes(spark, tmp_path):
    source, store, checkpoint = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "cp")
    source.mkdir()

    def run():
        messages = order_source.from_files(spark, str(source), max_files=1)
        order_stream.account(messages, store, checkpoint, available_now=True).awaitTermination()

    (source / "a.txt").write_text("\n".join(ORDERS[:3]))
    (source / "b.txt").write_text("not an order\n" + ORDERS[3] + '\n{"order_id":')
    run()
    (source / "c.txt").write_text("\n".join(ORDERS[4:]))
    run()
    got = deltas.read(spark, store, order_stream.ACCOUNTED)
    assert sorted(r.order_id for r in got.collect()) == [f"o{i}" for i in range(6)]
    assert got.where("order_id = 'o4'").first()["items"][0]["item"]["quantity"] == 4
    bad = deltas.read(spark, store, order_stream.QUARANTINE)
    assert sorted(r.value for r in bad.collect()) == ["not an order", '{"order_id":']


def test_monitor_counts_and_fails_on_bad_payload(spark, tmp_path):
    good, bad = tmp_path / "good", tmp_path / "bad"
    for folder in (good, bad):
        folder.mkdir()
        (folder / "a.txt").write_text("\n".join(ORDERS[:4]))
    (good / "b.txt").write_text("\n".join(ORDERS[4:]))
    (bad / "b.txt").write_text("broken")

    def run(folder, name):
        totals = order_stream.running_total(order_source.from_files(spark, str(folder), max_files=1))
        query = totals.writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True)
        query.start().awaitTermination()

    run(good, "monitor")
    assert spark.table("monitor").first().total == 6
    with pytest.raises(Exception, match="order parsing failed"):
        run(bad, "monitor_bad")


def test_order_numbers_survive_replays(spark, tmp_path):
    """A stream that is cut before its ledger entry gives the same numbers when its batch is tried again."""
    source, store, checkpoint = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "cp")
    source.mkdir()

    def run():
        messages = order_source.from_files(spark, str(source), max_files=1)
        placed = messages.withColumn("offset", F.get_json_object("value", "$.order_id").substr(2, 9).cast("long"))
        order_stream.number(placed, store, checkpoint, available_now=True).awaitTermination()

    for i, part in enumerate((ORDERS[:2], ORDERS[2:5], ORDERS[5:])):
        put(source, i, "\n".join(reversed(part)))
    run()
    last = sorted((tmp_path / "cp" / "commits").glob("[0-9]*"))[-1]
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    run()  # the last batch again
    (source / "bad").write_text("broken")
    with pytest.raises(Exception, match="order parsing failed"):
        run()
    got = deltas.read(spark, store, order_stream.NUMBERED).collect()
    assert sorted((r.order_id, r.running_count) for r in got) == [(f"o{i}", i + 1) for i in range(6)]


def test_a_replayed_batch_sees_its_first_catalog(spark, tmp_path):
    state = {"price": 1, "loads": 0}

    def load():
        state["loads"] += 1
        if state["price"] is None:
            raise OSError("no catalog")
        return spark.createDataFrame([("p", state["price"])], "id string, price long")

    def versions():
        ticks = iter(range(0, 10_000, 100))
        return catalog_source.Versions(load, str(tmp_path), clock=lambda: next(ticks))

    first = versions()
    assert first.at(spark, 0).first().price == 1
    assert first.at(spark, 1).first().price == 1  # no new snapshot
    state["price"] = 2
    assert first.at(spark, 2).first().price == 2
    assert first.at(spark, 2).first().price == 2 and versions().at(spark, 2).first().price == 2
    state["price"] = None
    assert first.at(spark, 3).first().price == 2 and versions().at(spark, 4).first().price == 2
    state["price"] = 3
    again = versions()
    assert again.at(spark, 4).first().price == 2 and again.at(spark, 5).first().price == 3
    assert again.at(spark, 6).first().price == 3
    kept = sorted(p.name for p in (tmp_path / catalog_source.Versions.SNAPSHOTS).iterdir())
    assert kept == ["batch_id=5"]
    state["price"] = None
    with pytest.raises(OSError, match="no catalog"):
        catalog_source.Versions(load, str(tmp_path / "other")).at(spark, 0)


def _cart_lines():
    start = datetime(2024, 1, 1)
    random_ = random.Random(3)
    writes, now = [], start
    for seq in range(120):
        now += timedelta(minutes=random_.choice((1, 5, 20, 70)))
        writes.append(
            {
                "user_id": f"u{random_.randrange(3)}",
                "product_id": f"p{random_.randrange(4)}",
                "quantity": 1 + seq % 3,
                "kind": "empty" if random_.random() < 0.1 else "add",
                "event_time": now.isoformat(),
                "seq": seq,
            }
        )
    return writes


def carts(df):
    return {(r.user_id, r.product_id): r.quantity for r in df.collect()}


@pytest.mark.parametrize("shuffled", [False, True])
def test_cart_stream_equals_batch_in_any_order(spark, tmp_path, shuffled):
    """Late writes count: emptyings between older additions, and writes that bridge the gap between two carts."""
    writes = _cart_lines()
    source = spark.createDataFrame([(w | {"event_time": datetime.fromisoformat(w["event_time"])}) for w in writes], schemas.CART_EVENT)
    if shuffled:
        random.Random(11).shuffle(writes)
    store, end = str(tmp_path), max(datetime.fromisoformat(w["event_time"]) for w in writes)
    for i in range(6):
        part = source.where(F.col("seq").isin([w["seq"] for w in writes[i * 20 : (i + 1) * 20]]))
        for _ in range(1 + (i == 3)):  # one batch is replayed
            cart_stream._apply(part, store, i, cart.TIME_TO_LIVE, fanout=3, bucket_bytes=3000, grace=1)
        seen = source.where(F.col("seq").isin([w["seq"] for w in writes[: (i + 1) * 20]]))
        if i in (1, 5):
            assert carts(cart_stream.items(spark, store)) == carts(cart.state(seen)), i
    for now in (end, end + timedelta(minutes=61)):
        assert carts(cart_stream.items(spark, store, as_of=now)) == carts(cart.state(source, as_of=now))


def test_cart_stream_resumes(spark, tmp_path):
    source, store = tmp_path / "in", str(tmp_path / "store")
    source.mkdir()
    writes = _cart_lines()
    for i in range(2):
        put(source, i, "\n".join(map(json.dumps, writes[i * 60 : (i + 1) * 60])))
        stream_in = spark.readStream.schema(schemas.CART_EVENT).json(str(source))
        cart_stream.maintain(stream_in, store, str(tmp_path / "cp"), available_now=True).awaitTermination()
    batch = spark.read.schema(schemas.CART_EVENT).json(str(source) + "/*.json")
    assert carts(cart_stream.items(spark, store)) == carts(cart.state(batch))


def test_a_replayed_batch_is_written_and_read_by_many_tasks(spark, tmp_path):
    """Also where a part of the range holds few rows or none, and the first task reads none of a batch's rows."""
    keys = [*range(3000, 4000), *range(700), *range(3)]
    table = spark.sparkContext.parallelize(keys, 4).map(lambda k: (k, str(k))).toDF("id long, text string")
    table.write.parquet(str(tmp_path / "t.parquet"))
    for descending, batches, ids in ((False, 4, range(4)), (True, 8, range(8))):
        found = fixtures.replay(spark, str(tmp_path), "t", "id", batches=batches, descending=descending, file_rows=100)
        seen = {}

        def keep(batch, batch_id, seen=seen):
            read = batch.select("id", F.input_file_name().alias("file")).collect()
            seen[batch_id] = (sorted(r.id for r in read), len({r.file for r in read}))

        found.writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / f"cp{batches}")).trigger(
            availableNow=True
        ).start().awaitTermination()
        parts = [sorted(k for k in keys if k * batches // 4000 == i) for i in range(batches)]
        assert [seen[i][0] for i in ids] == (parts[::-1] if descending else parts)
        assert len(seen) == batches and max(n for _, n in seen.values()) >= 5
