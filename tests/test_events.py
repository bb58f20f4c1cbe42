"""Image events, percentiles, retention and the streaming jobs."""

import json
import random
from datetime import date, datetime, timedelta, timezone

import pytest
from conftest import bag
from pyspark.sql import functions as F

from ledgerloom.operators import events as ev, quantiles, retention
from ledgerloom.operators.applications import rule_matrix
from ledgerloom.sources import tables
from ledgerloom.streaming import applications as app_stream, images as streams, status as index
from test_sources import BATCH_A, BATCH_C

EVENT = "image_id string, source string, uploaded_at timestamp, status string"
T0 = datetime(2024, 1, 10, 8, 0, 0)


def _at(hours):
    return T0 + timedelta(hours=hours)


@pytest.fixture
def events(spark):
    def build(*rows):
        return spark.createDataFrame([(i, s, _at(h), st) for i, s, h, st in rows], EVENT)

    return build


def test_messages_parse_and_bad_ones_give_nulls(spark):
    good = json.dumps({"image_id": "a", "s3_key": "raw/a", "size": 5, "content_type": "image/png",
                       "uploaded_at": "2024-01-10T08:00:00Z", "more": 1})
    rows = ev.parse_events(spark.createDataFrame([(good,), ("{oops",), ('{"image_id": "b"}',)], "value string")).collect()
    assert tuple(rows[0]) == ("a", "raw/a", 5, "image/png", datetime(2024, 1, 10, 8), date(2024, 1, 10))
    assert tuple(rows[1]) == (None,) * 6
    assert (rows[2].image_id, rows[2].dt) == ("b", None)


def test_metadata_records_have_the_table_layout(spark):
    event = spark.createDataFrame([("a", "api", _at(0), 1500, "png", 9, "DONE")],
                                  "image_id string, source string, uploaded_at timestamp, duration_ms long, "
                                  "format string, bytes_in long, status string")
    row = ev.metadata_records(event).first()
    assert list(row.asDict()) == list(ev.METADATA_COLUMNS)
    assert (row.processed_at, row.dt, row.width) == (_at(0) + timedelta(seconds=1.5), date(2024, 1, 10), None)


def test_a_given_end_of_processing_stays(spark):
    event = spark.createDataFrame([(_at(0), _at(9), 1000), (_at(0), None, 1000)],
                                  "uploaded_at timestamp, processed_at timestamp, duration_ms long")
    event = event.withColumns({c: F.lit(None).cast("string") for c in ("image_id", "source", "status")})
    assert [r.processed_at for r in ev.metadata_records(event).collect()] == [_at(9), _at(0) + timedelta(seconds=1)]


def test_events_of_one_time_go_by_status_rank(spark, events):
    rows = events(("a", "api", 1, "PENDING"), ("a", "api", 1, "DONE"), ("a", "api", 1, "ERROR"),
                  ("b", "api", 1, "PENDING"), ("b", "api", 1, "ERROR"))
    assert {r.image_id: r.status for r in ev.latest_status(rows).collect()} == {"a": "DONE", "b": "ERROR"}
    folded = index.merge_status(ev.status_rows(rows.where("status = 'PENDING'")).union(ev.status_rows(rows.where("status <> 'PENDING'"))))
    assert {r.image_id: r.status for r in folded.collect()} == {"a": "DONE", "b": "ERROR"}


def test_event_rules(spark):
    rows = spark.createDataFrame([("image/png", 5), ("image/png", 11), ("text/html", 0), (None, None)],
                                 "content_type string, size long")
    assert [tuple(r) for r in rule_matrix(rows, ev.event_rules(["image/png"], 10)).collect()] == [
        (False, False), (False, True), (True, True), (True, True)
    ]


def test_sources_are_tagged_and_matched_by_name(spark):
    api = spark.createDataFrame([("a", 1)], "image_id string, size int")
    kafka = spark.createDataFrame([(2, "b", "k")], "size int, image_id string, s3_key string")
    assert bag(ev.union_sources({"api": api, "kafka": kafka})) == [
        ("a", 1, "api", None), ("b", 2, "kafka", "k")
    ]
    with pytest.raises(ValueError):
        ev.union_sources({})


def test_first_delivery_wins_over_both_paths(events):
    frame = events(("a", "kafka", 1, "DONE"), ("a", "api", 1, "DONE"), ("a", "api", 0, "PENDING"), ("b", "kafka", 5, "DONE"))
    assert [(r.image_id, r.source, r.uploaded_at) for r in ev.dedupe_images(frame).orderBy("image_id").collect()] == [
        ("a", "api", _at(0)), ("b", "kafka", _at(5))
    ]


def test_latest_status_expiry_and_routes(events):
    frame = events(
        ("done", "api", 0, "PENDING"), ("done", "api", 1, "ERROR"), ("done", "api", 2, "DONE"),
        ("dead", "api", 0, "ERROR"), ("dead", "api", 1, "ERROR"), ("dead", "api", 2, "ERROR"),
        ("again", "api", 0, "ERROR"), ("again", "api", 1, "ERROR"), ("wait", "api", 0, "PENDING"),
    )
    rows = {r.image_id: r for r in ev.routed(ev.latest_status(frame)).collect()}
    assert {k: (r.status, r.attempts, r.failures, r.route) for k, r in rows.items()} == {
        "done": ("DONE", 3, 1, "done"), "dead": ("ERROR", 3, 3, "dead_letter"),
        "again": ("ERROR", 2, 2, "retry"), "wait": ("PENDING", 1, 0, "wait"),
    }
    assert rows["done"].expires_at == _at(0) + timedelta(days=7)
    assert [r.image_id for r in ev.dead_letters(frame).collect()] == ["dead"]


def test_done_images_are_skipped(events):
    status = ev.latest_status(events(("a", "api", 0, "DONE"), ("b", "api", 0, "ERROR")))
    incoming = events(("a", "kafka", 3, "PENDING"), ("b", "kafka", 3, "PENDING"), ("b", "api", 4, "PENDING"), ("c", "api", 5, "PENDING"))
    left = ev.skip_done(incoming, status).collect()
    assert sorted((r.image_id, r.uploaded_at) for r in left) == [("b", _at(3)), ("c", _at(5))]


# ---- Percentiles ------------------------------------------------------------


def _expected(values, share):
    values = sorted(values)
    place = (len(values) - 1) * share
    low = int(place)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (place - low)


@pytest.mark.parametrize("widths", [None, (0.5,), (1000.0,), (10.0**9,), (500.0, 20.0, 1.0)])
def test_exact_percentiles_equal_brute_force(spark, widths):
    rng = random.Random(5)
    groups = {"hot": [rng.randrange(-50, 5000) for _ in range(3000)], "one": [7], "two": [3, 4],
              "same": [9] * 500, None: [rng.randrange(100) for _ in range(40)]}
    rows = [(g, v) for g, values in groups.items() for v in values] + [("hot", None), ("empty", None)]
    frame = spark.createDataFrame(rows, "g string, v long").repartition(5)
    shares = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}
    got = {r.g: r for r in quantiles.exact_percentiles(frame, ["g"], "v", shares, widths).collect()}
    assert set(got) == set(groups)
    for g, values in groups.items():
        for name, share in shares.items():
            assert got[g][name] == pytest.approx(_expected(values, share), abs=1e-9), (g, name)


def test_percentiles_of_decimals_and_without_groups(spark):
    frame = spark.range(101).selectExpr("cast(id * 0.25 as decimal(10,2)) as v")
    assert tuple(quantiles.exact_percentiles(frame, [], "v", {"p50": 0.5, "p99": 0.99}, (4.0, 0.5)).first()) == (12.5, 24.75)


def test_percentiles_need_a_width(spark):
    with pytest.raises(ValueError):
        quantiles.exact_percentiles(spark.range(3), [], "id", {"p50": 0.5}, ())


def test_estimated_percentiles_stay_close(spark):
    frame = spark.range(10001).selectExpr("'g' as g", "id as v")
    row = quantiles.estimated_percentiles(frame, ["g"], "v", ev.LATENCY_PERCENTILES).first()
    for name, share in ev.LATENCY_PERCENTILES.items():
        assert abs(row[name] - 10000 * share) <= 2


def test_daily_metrics_carry_no_image_key(spark):
    rows = [("a", "api", 100, "DONE", 10), ("b", "api", 300, "ERROR", 20), ("c", "kafka", None, "PENDING", 5)]
    frame = spark.createDataFrame(rows, "image_id string, source string, duration_ms long, status string, bytes_in long")
    frame = frame.withColumn("dt", F.lit(date(2024, 1, 10)))
    out = ev.daily_metrics(frame)
    assert "image_id" not in out.columns
    assert bag(out.select("source", "images", "failed", "failure_rate", "bytes_in", "p50", "p99")) == [
        ("api", 2, 1, 0.5, 30, 200.0, 298.0), ("kafka", 1, 0, 0.0, 5, None, None)
    ]


# ---- Retention --------------------------------------------------------------

CUTOFF = datetime(2024, 1, 20, 12)


@pytest.fixture
def uploads(spark):
    stamps = ["2024-01-12 23:00:00", "2024-01-13 11:59:59", "2024-01-13 12:00:00", "2024-01-20 00:00:00", None]
    rows = spark.createDataFrame([(str(i), s) for i, s in enumerate(stamps)], "image_id string, s string")
    return rows.selectExpr("image_id", "cast(s as timestamp_ntz) as uploaded_at").withColumn("dt", F.to_date("uploaded_at"))


def test_expired_and_kept_split_every_row(uploads):
    assert sorted(r.image_id for r in retention.expired(uploads, CUTOFF).collect()) == ["0", "1"]
    assert sorted(r.image_id for r in retention.kept(uploads, CUTOFF).collect()) == ["2", "3", "4"]


def test_manifest(uploads):
    assert bag(retention.manifest(uploads.where("dt is not null"), CUTOFF)) == [
        (date(2024, 1, 12), 1, 1, "drop"), (date(2024, 1, 13), 2, 1, "rewrite"), (date(2024, 1, 20), 1, 0, "keep")
    ]


def test_sweep_leaves_nothing_older_than_the_limit(spark, uploads):
    spark.sql("DROP TABLE IF EXISTS image_metadata")
    uploads.where("dt is not null").write.partitionBy("dt").saveAsTable("image_metadata")
    swept = retention.sweep_table(spark, "image_metadata", CUTOFF)
    assert {(r.dt, r.objects_older_than_7d, r.action) for r in swept.collect()} == {
        (date(2024, 1, 12), 1, "drop"), (date(2024, 1, 13), 1, "rewrite")
    }
    left = spark.table("image_metadata")
    assert sorted(r.image_id for r in left.collect()) == ["2", "3"]
    assert retention.manifest(left, CUTOFF).where("action <> 'keep'").count() == 0
    assert retention.sweep_table(spark, "image_metadata", CUTOFF).count() == 0
    plan = retention.manifest(retention.due_days(left, CUTOFF), CUTOFF)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "2024-01-14" in plan
    spark.sql("DROP TABLE image_metadata")


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_cut_off_keeps_zone_and_microseconds(spark, kind):
    stamps = ["2024-01-13 02:00:00", "2024-01-13 01:59:59.999999", "2024-01-13 02:00:00.000001"]
    rows = spark.createDataFrame([(s,) for s in stamps], "s string").select(F.col("s").cast(kind).alias("uploaded_at"), "s")
    zone = timezone(timedelta(hours=8))
    old = retention.expired(rows, datetime(2024, 1, 20, 10, tzinfo=zone))
    assert [r.s for r in old.collect()] == stamps[1:2]
    late = retention.expired(rows, datetime(2024, 1, 20, 10, 0, 0, 1, tzinfo=zone))
    assert sorted(r.s for r in late.collect()) == sorted(stamps[:2])


def test_retention_bound_reaches_the_scan(spark, uploads, tmp_path):
    root = str(tmp_path / "u")
    uploads.write.parquet(root)
    plan = retention.expired(spark.read.parquet(root), CUTOFF)._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(uploaded_at,2024-01-13T12:00" in plan


# ---- Streams ----------------------------------------------------------------


def _event_stream(spark, root):
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).json(root)


def _drop(root, name, rows):
    """One file of events; files are read in the order they were written."""
    import os
    import time

    os.makedirs(root, exist_ok=True)
    with open(f"{root}/{name}.json", "w") as out:
        for image, source, hours, status in rows:
            out.write(json.dumps({"image_id": image, "source": source, "status": status,
                                  "uploaded_at": _at(hours).strftime("%Y-%m-%dT%H:%M:%SZ")}) + "\n")
    stamp = time.time() - 1000 + len(os.listdir(root))
    os.utime(f"{root}/{name}.json", (stamp, stamp))


def test_applications_stream_processes_each_file_once(spark, tmp_path):
    root, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    root.mkdir()

    def start():
        app_stream.stream_applications(spark, str(root), out, state).awaitTermination()
        return tuple(spark.read.parquet(f"{out}/{side}").count() for side in ("successful", "unsuccessful"))

    (root / "a.csv").write_text(BATCH_A)
    (root / "b.csv").write_text("mobile_no,name,extra,email,date_of_birth\n66744895,Sherry Gonzalez DDS,x,s@c.net,14-03-1973\n")
    assert start() == (2, 2)
    assert start() == (2, 2)
    (root / "c.csv").write_text(BATCH_C)
    assert start() == (2, 5)
    names = {r.first_name for r in spark.read.parquet(f"{out}/successful").collect()}
    assert names == {"William", "Sherry"}


def test_idle_applications_stream_writes_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    out = tmp_path / "out"
    app_stream.stream_applications(spark, str(tmp_path / "in"), str(out), str(tmp_path / "s")).awaitTermination()
    assert not (out / "successful").exists()


def test_finished_files_can_be_archived(spark, tmp_path):
    root, archive = tmp_path / "in", tmp_path / "done"
    root.mkdir()

    def start():
        app_stream.stream_applications(
            spark, str(root), str(tmp_path / "out"), str(tmp_path / "s"), archive=str(archive)
        ).awaitTermination()
        return sum(spark.read.parquet(str(tmp_path / "out" / side)).count() for side in ("successful", "unsuccessful"))

    for name, text, total in [("a", BATCH_A, 3), ("b", BATCH_C, 6), ("c", BATCH_A, 9)]:
        (root / f"{name}.csv").write_text(text)
        assert start() == total
    assert "a.csv" in {p.name for p in archive.rglob("*.csv")} and not (root / "a.csv").exists()


def test_landing_by_day_appends_once(spark, tmp_path):
    root = tmp_path / "messages"
    root.mkdir()

    def land():
        stream = ev.parse_events(spark.readStream.text(str(root)))
        streams.land_by_day(stream, str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
        return {(r.image_id, str(r.dt)) for r in spark.read.parquet(str(tmp_path / "t")).collect()}

    (root / "1").write_text('{"image_id":"a","uploaded_at":"2024-01-10T08:00:00Z"}\n')
    assert land() == {("a", "2024-01-10")}
    (root / "2").write_text('{"image_id":"b","uploaded_at":"2024-01-11T08:00:00Z"}\n')
    assert land() == land() == {("a", "2024-01-10"), ("b", "2024-01-11")}


def test_stream_keeps_first_deliveries_and_refuses_expired_ones(spark, tmp_path):
    root = str(tmp_path / "in")
    _drop(root, "1", [("a", "api", 0, "DONE"), ("a", "kafka", 0, "DONE"), ("b", "api", 1, "DONE")])
    _drop(root, "2", [("a", "api", 50, "DONE"), ("c", "api", 200, "DONE")])
    # File 2 moves the watermark to 200 h - 7 days = 32 h; Spark refuses late rows by
    # the watermark of the micro-batch before, so from file 4 on.
    _drop(root, "3", [("d", "api", 60, "DONE")])
    _drop(root, "4", [("late", "api", 20, "DONE"), ("e", "api", 70, "DONE")])
    once = streams.first_deliveries(_event_stream(spark, root))
    streams.write_appended(once, str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    got = [r.image_id for r in spark.read.parquet(str(tmp_path / "o")).collect()]
    assert sorted(got) == ["a", "b", "c", "d", "e"]


def test_two_streams_converge_before_deduplication(spark, tmp_path):
    api, kafka = str(tmp_path / "api"), str(tmp_path / "kafka")
    _drop(api, "1", [("a", "", 0, "DONE"), ("b", "", 1, "DONE")])
    _drop(kafka, "1", [("b", "", 2, "DONE"), ("c", "", 3, "DONE")])
    both = ev.union_sources({"api": _event_stream(spark, api).drop("source"), "kafka": _event_stream(spark, kafka).drop("source")})
    streams.write_appended(streams.first_deliveries(both), str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "o")).collect()
    assert sorted(r.image_id for r in rows) == ["a", "b", "c"]
    assert {r.image_id: r.source for r in rows if r.image_id != "b"} == {"a": "api", "c": "kafka"}


def test_stream_hours_equal_batch_hours_once_closed(spark, tmp_path):
    root = str(tmp_path / "in")
    rows = [(f"i{n}", "api" if n % 3 else "kafka", n / 10, "DONE") for n in range(100)]
    for part in range(4):
        _drop(root, str(part), rows[part * 25:(part + 1) * 25])
    counts = streams.hourly_counts(_event_stream(spark, root))
    streams.write_appended(counts, str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    batch = ev.uploads_per_hour(spark.read.schema(EVENT).json(root))
    closed = batch.where(F.col("hour_start") + F.expr("interval 2 hours") <= F.lit(_at(9.9)))
    assert bag(spark.read.parquet(str(tmp_path / "o"))) == bag(closed) != []


def test_late_events_are_refused_and_counted_and_state_expires(spark, tmp_path):
    root, out, checkpoint = (str(tmp_path / n) for n in ("in", "o", "c"))
    runs = [
        [("a", "api", 0, "DONE"), ("b", "api", 1, "DONE")],
        [("a", "kafka", 24 * 5, "DONE"), ("c", "api", 24 * 9, "DONE")],        # a repeats within seven days
        [("late", "api", 24, "DONE"), ("d", "api", 24 * 20, "DONE")],          # older than day 9 less seven days
        [("a", "api", 24 * 21, "DONE"), ("late", "api", 24 * 22, "DONE"), ("c", "api", 24 * 14, "DONE")],
        [("d", "kafka", 24 * 26, "DONE"), ("c", "api", 24 * 13, "DONE")],      # on day 22, day 13 is too old, day 26 repeats
    ]
    done = []
    for n, rows in enumerate(runs):
        _drop(root, str(n), rows)
        with streams.rocksdb_state(spark):
            query = streams.write_appended(streams.first_deliveries(_event_stream(spark, root)), out, checkpoint)
        done.append(streams.finished(spark, query))
        assert any(m.startswith("rocksdb") for p in query.recentProgress for o in p["stateOperators"] for m in o["customMetrics"])
    found = sorted((r.image_id, int((r.uploaded_at - _at(0)).total_seconds() // 3600)) for r in spark.read.parquet(out).collect())
    assert found == sorted([("a", 0), ("b", 1), ("c", 24 * 9), ("d", 24 * 20), ("a", 24 * 21), ("late", 24 * 22)])
    assert [d.rows for d in done] == [2, 2, 2, 3, 2] and [d.refused for d in done] == [0, 0, 1, 0, 1]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != next(iter(streams.ROCKSDB.values()))


def test_a_run_longer_than_the_progress_kept_is_not_counted(spark, tmp_path):
    root = str(tmp_path / "in")
    for n in range(4):
        _drop(root, str(n), [("a", "api", n, "DONE")])
    old = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        one_by_one = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).json(root)
        query = streams.write_appended(streams.first_deliveries(one_by_one), str(tmp_path / "o"), str(tmp_path / "c"))
        with pytest.raises(RuntimeError, match="numRecentProgressUpdates"):
            streams.finished(spark, query)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", old)


def test_status_state_and_skipping_done_images(spark, tmp_path):
    root, state = str(tmp_path / "in"), str(tmp_path / "state")
    assert index.read_status(spark, state) is None
    _drop(root, "1", [("a", "api", 0, "PENDING"), ("b", "api", 0, "ERROR")])
    _drop(root, "2", [("a", "api", 1, "DONE"), ("b", "api", 1, "ERROR")])

    def track():
        index.track_status(_event_stream(spark, root), state, str(tmp_path / "c")).awaitTermination()
        return {r.image_id: (r.status, r.attempts, r.failures) for r in index.read_status(spark, state).collect()}

    assert track() == track() == {"a": ("DONE", 2, 0), "b": ("ERROR", 2, 2)}
    assert index.read_status(spark, state, since=_at(24 * 30)).count() == 0

    work = str(tmp_path / "work")
    _drop(work, "1", [("a", "kafka", 2, "PENDING"), ("b", "kafka", 2, "PENDING"), ("b", "kafka", 3, "PENDING"), ("n", "api", 2, "PENDING")])
    todo = _event_stream(spark, work).withColumn("dt", F.to_date("uploaded_at"))
    index.process_new_images(todo, state, str(tmp_path / "todo"), str(tmp_path / "c2")).awaitTermination()
    assert sorted((r.image_id, r.uploaded_at) for r in spark.read.parquet(str(tmp_path / "todo")).collect()) == [
        ("b", _at(2)), ("n", _at(2))
    ]


def test_images_expire_by_all_that_is_known_about_them(spark, tmp_path):
    root, state = str(tmp_path / "in"), str(tmp_path / "state")
    _drop(root, "1", [("a", "api", 0, "ERROR"), ("b", "api", 0, "DONE")])
    _drop(root, "2", [("a", "api", 24 * 5, "ERROR")])
    index.track_status(_event_stream(spark, root), state, str(tmp_path / "c")).awaitTermination()
    assert index.read_status(spark, state, since=_at(24 * 8)).count() == 0
    row = {r.image_id: r for r in index.read_status(spark, state, since=_at(24 * 6)).collect()}["a"]
    assert (row.attempts, row.failures, row.expires_at) == (2, 2, _at(24 * 7))


def _numbers(path):
    return sorted(int(p.name.rpartition("=")[2]) for p in path.iterdir() if not p.name.startswith(("_", ".")))


def test_buckets_are_folded_in_turn_and_old_folders_go(spark, tmp_path):
    root, state = str(tmp_path / "in"), str(tmp_path / "state")
    rows = [(f"i{n % 17}", "api", n, "DONE" if n % 3 else "ERROR") for n in range(44)]
    for part in range(11):
        _drop(root, f"{part:02d}", rows[part * 4:part * 4 + 4])
    index.track_status(_event_stream(spark, root), state, str(tmp_path / "c"), compact_every=3, buckets=7).awaitTermination()
    assert _numbers(tmp_path / "state" / "batches") == _numbers(tmp_path / "state" / "commits") == [5, 6, 7, 8, 9, 10]
    folded = {n: _numbers(tmp_path / "state" / "snapshots" / f"batch_id={n}") for n in _numbers(tmp_path / "state" / "snapshots")}
    assert list(folded) == [5, 6, 7, 8, 9, 10] and all((n + b) % 3 == 0 for n, found in folded.items() for b in found)
    whole = ev.status_rows(spark.read.schema(EVENT).json(root))
    columns = ["image_id", "status", "attempts", "failures", "expires_at", "last_at"]
    assert bag(index.read_status(spark, state).select(columns)) == bag(whole.select(columns))
    with pytest.raises(ValueError, match="buckets"):
        index.track_status(_event_stream(spark, root), state, str(tmp_path / "c3"), buckets=8)


def test_every_state_in_between_is_whole(spark, tmp_path):
    """After each micro-batch, and with one that broke off before its commit, a read gives the state up to the last commit."""
    root, state = str(tmp_path / "in"), str(tmp_path / "state")
    rng, columns = random.Random(2), ["image_id", "status", "attempts", "failures", "expires_at", "last_at"]
    told = []
    for part in range(9):
        told += (rows := [(f"i{rng.randrange(30)}", "api", part * 10 + n, rng.choice(["DONE", "ERROR", "PENDING"])) for n in range(6)])
        _drop(root, f"{part:02d}", rows)
        index.track_status(_event_stream(spark, root), state, str(tmp_path / "c"), compact_every=4, buckets=5).awaitTermination()
        expected = bag(ev.status_rows(spark.createDataFrame([(i, s, _at(h), x) for i, s, h, x in told], EVENT)).select(columns))
        assert bag(index.read_status(spark, state).select(columns)) == expected
    # What an attempt left behind without a commit isn't read.
    ev.status_rows(spark.createDataFrame([("i1", "api", _at(999), "DONE")], EVENT)).withColumn("bucket", F.lit(0)).write.partitionBy(
        "bucket").parquet(f"{state}/batches/batch_id=9")
    assert bag(index.read_status(spark, state).select(columns)) == expected


def test_a_read_opens_the_wanted_buckets_only(spark, tmp_path):
    root, state = str(tmp_path / "in"), str(tmp_path / "state")
    for part in range(5):
        _drop(root, str(part), [(f"i{n}", "api", part, "DONE") for n in range(200)])
    index.track_status(_event_stream(spark, root), state, str(tmp_path / "c"), compact_every=2, buckets=16).awaitTermination()
    layout = index.read_layout(spark, state)
    wanted = spark.createDataFrame([("i5",), ("i77",)], "image_id string").select(layout.bucket().alias("b")).distinct()
    numbers = [r.b for r in wanted.collect()]
    frame = index.read_status(spark, state, buckets=numbers)
    assert {layout.every, layout.buckets} == {2, 16} and {"i5", "i77"} <= {r.image_id for r in frame.collect()}
    assert frame.count() < 100
    plan = frame._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert filters and all("bucket" in line.split("PartitionFilters:")[1].split("PushedFilters")[0] for line in filters)
    # The rows that the scans give out are those of the buckets, not of the state.
    assert 0 < sum(_scans(frame)) <= 3 * frame.count()


def _scans(frame):
    """Rows out of each file scan of an executed plan."""
    frame.collect()
    found, todo = [], [frame._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            todo.append(node.executedPlan())
            continue
        if node.nodeName().startswith("Scan"):
            found.append(node.metrics().get("numOutputRows").get().value())
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
            continue
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_a_repeated_micro_batch_keeps_no_old_days(spark, tmp_path):
    out = str(tmp_path / "o")
    both = spark.createDataFrame([("p", _at(0)), ("q", _at(48))], "image_id string, uploaded_at timestamp").withColumn("dt", F.to_date("uploaded_at"))
    tables.write_by_day(both, out, replace_all=True)
    tables.write_by_day(both.where("image_id = 'p'"), out, replace_all=True)
    assert [r.image_id for r in spark.read.parquet(out).collect()] == ["p"]


def test_kafka_source_needs_its_package(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        streams.kafka_messages(spark, "localhost:9092")
