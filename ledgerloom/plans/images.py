"""Queries of the image-event layer, over ``events``."""

from __future__ import annotations

import uuid
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import events as ev, quantiles, retention, summaries
from ..operators.joins import lookup_join
from ..operators.applications import rule_matrix
from ..operators.sampling import keep_first
from ..session import scratch_path, settled
from ..sources import tables
from ..streaming import images as streams, status as state
from .registry import Collected
from .views import duck, image_events, table

_q = Collected()
QUERIES = _q.queries

_CUTOFF = datetime(2024, 1, 20, 12, 0, 0)
_CONTENT_TYPES = ("image/jpeg", "image/png", "image/webp")
_MAX_BYTES = 64 * 1024

_ORDER = ("uploaded_at",)


def _event_stream(spark: SparkSession, folder: str, **options: object) -> DataFrame:
    """The events table as a stream of image events with zoned upload times."""
    given = table(spark, folder, "events").schema
    # As a glob the path may be one file or a folder of part files.
    raw = spark.readStream.options(**options).schema(given).parquet(f"{folder}/{{events}}.parquet")
    return raw.select(
        "event_id",
        F.concat_ws("-", F.lit("img"), F.col("user_id").cast("string"), F.get_json_object("props", "$.k")).alias("image_id"),
        F.when(F.col("event_type").isin("view", "click"), "api").otherwise("kafka").alias("source"),
        F.col("ts").cast("timestamp").alias("uploaded_at"),
        F.when(F.col("event_type") == "error", ev.ERROR).when(F.col("event_type") == "signup", ev.PENDING)
        .otherwise(ev.DONE).alias("status"),
    )


# ---- Landing and tables -------------------------------------------------------------


@_q.add("""
    select event_id, cast(json_extract_string(props, '$.k') as integer) as k from events""")
def event_json_fields(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", F.from_json("props", "k int").getField("k").alias("k"))


@_q.add(duck("""
    select dt, count(*) as events, cast(sum(bytes_in) as bigint) as bytes from image_events group by dt""", "image_events"))
def event_landing_by_day(spark: SparkSession, folder: str) -> DataFrame:
    root = scratch_path(spark, "landing")
    message = F.to_json(F.struct(
        "image_id", "s3_key", F.col("bytes_in").alias("size"),
        F.concat(F.lit("image/"), "format").alias("content_type"),
        F.col("uploaded_at").cast("timestamp").alias("uploaded_at"),
    ))
    image_events(spark, folder).select(message.alias("value")).write.text(f"{root}/messages")
    parsed = ev.parse_events(spark.readStream.text(f"{root}/messages"))
    streams.land_by_day(parsed, f"{root}/events", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/events").groupBy("dt").agg(
        F.count(F.lit(1)).alias("events"), F.sum("size").alias("bytes")
    )


def _metadata_table(spark: SparkSession, folder: str) -> str:
    root = scratch_path(spark, "metadata")
    tables.write_by_day(ev.metadata_records(image_events(spark, folder)), root)
    return root


@_q.add(duck("""
    select dt, count(*) as images, cast(sum(bytes_in) as bigint) as bytes,
      max(uploaded_at + to_milliseconds(duration_ms)) as last_processed_at
    from image_events group by dt""", "image_events"))
def image_metadata_by_day(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(_metadata_table(spark, folder)).groupBy("dt").agg(
        F.count(F.lit(1)).alias("images"), F.sum("bytes_in").alias("bytes"),
        F.max("processed_at").alias("last_processed_at"),
    )


@_q.add(duck("""
    select image_id, source, duration_ms, format, bytes_in, status, dt from image_events
    where dt between date '2024-01-14' and date '2024-01-20'""", "image_events"))
def recent_partition_scan(spark: SparkSession, folder: str) -> DataFrame:
    root = _metadata_table(spark, folder)
    return tables.read_days(spark, root, "2024-01-14", "2024-01-20").select(
        "image_id", "source", "duration_ms", "format", "bytes_in", "status", "dt"
    )


@_q.add(duck(f"""
    select event_id, format not in ('jpeg', 'png', 'webp') as unsupported_content_type,
      not (bytes_in > 0 and bytes_in <= {_MAX_BYTES}) as size_over_limit from image_events""", "image_events"))
def event_rule_matrix(spark: SparkSession, folder: str) -> DataFrame:
    rows = image_events(spark, folder).select(
        "event_id", F.concat(F.lit("image/"), "format").alias("content_type"), F.col("bytes_in").alias("size")
    )
    return rule_matrix(rows, ev.event_rules(_CONTENT_TYPES, _MAX_BYTES), ["event_id"])


# ---- Images and their status ----------------------------------------------------------


@_q.add(duck("select event_id, image_id, uploaded_at, source from image_events", "image_events"))
def image_events_union(spark: SparkSession, folder: str) -> DataFrame:
    rows = image_events(spark, folder)
    api = rows.where("source = 'api'").select("event_id", "image_id", "uploaded_at")
    kafka = rows.where("source = 'kafka'").select("uploaded_at", "image_id", "event_id")
    return ev.union_sources({"api": api, "kafka": kafka})


@_q.add(duck("""
    select event_id, image_id, uploaded_at, source from image_events
    qualify row_number() over (partition by image_id order by uploaded_at, source, event_id) = 1""", "image_events"))
def dedupe_images(spark: SparkSession, folder: str) -> DataFrame:
    return ev.dedupe_images(image_events(spark, folder), ["source", "event_id"]).select(
        "event_id", "image_id", "uploaded_at", "source"
    )


# Of events at the same time a finished image stays finished, and an error comes before waiting.
_RANK = "case status when 'DONE' then 3 when 'ERROR' then 2 else 1 end"

_STATUS = """
    select image_id, arg_max(status, (uploaded_at, {rank})) as status, count(*) as attempts,
      count(*) filter (status = 'ERROR') as failures, min(uploaded_at) + interval 7 days as expires_at
    from image_events group by image_id""".format(rank=_RANK)


@_q.add(duck(_STATUS, "image_events"))
def latest_status_per_key(spark: SparkSession, folder: str) -> DataFrame:
    return ev.latest_status(image_events(spark, folder), _ORDER)


@_q.add(duck(f"select * from ({_STATUS}) s where status = 'ERROR' and failures >= 3", "image_events"))
def dead_letter_rows(spark: SparkSession, folder: str) -> DataFrame:
    return ev.dead_letters(image_events(spark, folder), order=_ORDER)


@_q.add(duck(f"""
    select image_id, attempts, case when status = 'DONE' then 'done' when status <> 'ERROR' then 'wait'
      when failures >= 3 then 'dead_letter' else 'retry' end as route
    from ({_STATUS}) s""", "image_events"))
def event_routes(spark: SparkSession, folder: str) -> DataFrame:
    return ev.routed(ev.latest_status(image_events(spark, folder), _ORDER)).select("image_id", "attempts", "route")


@_q.add(duck(f"""
    with done as (
      select image_id from image_events where uploaded_at < timestamp '2024-01-20 12:00:00' group by image_id
      having arg_max(status, (uploaded_at, {_RANK})) = 'DONE')
    select event_id, image_id, uploaded_at from (
      select * from image_events where uploaded_at >= timestamp '2024-01-20 12:00:00'
      qualify row_number() over (partition by image_id order by uploaded_at, source, event_id) = 1)
    where image_id not in (select image_id from done)""", "image_events"))
def skip_processed_images(spark: SparkSession, folder: str) -> DataFrame:
    rows = image_events(spark, folder)
    cut = F.lit(_CUTOFF.isoformat(sep=" ")).cast("timestamp_ntz")
    status = ev.latest_status(rows.where(F.col("uploaded_at") < cut), _ORDER)
    incoming = rows.where(F.col("uploaded_at") >= cut)
    return ev.skip_done(incoming, status, ["source", "event_id"]).select("event_id", "image_id", "uploaded_at")


# ---- Metrics ------------------------------------------------------------------------

_HOURLY = """
    select date_trunc('hour', uploaded_at) as hour_start, source, count(*) as uploads
    from image_events group by all"""


@_q.add(duck(_HOURLY, "image_events"))
def uploads_per_hour(spark: SparkSession, folder: str) -> DataFrame:
    return ev.uploads_per_hour(image_events(spark, folder))


@_q.add(duck(f"""
    select * from ({_HOURLY}) h
    where hour_start + interval 1 hour <= (select max(uploaded_at) from image_events) - interval 1 hour""", "image_events"))
def stream_uploads_per_hour(spark: SparkSession, folder: str) -> DataFrame:
    root = scratch_path(spark, "hourly")
    counts = streams.hourly_counts(_event_stream(spark, folder))
    streams.write_appended(counts, f"{root}/counts", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/counts").withColumn("hour_start", F.col("hour_start").cast("timestamp_ntz"))


@_q.add(duck("select distinct image_id from image_events", "image_events"))
def stream_first_deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """Images passed on by the stream, at its window of seven days.

    The watermark moves between micro-batches only. The table is one, so no event is late
    and no state is dropped while it runs: each image passes exactly once.
    """
    root = scratch_path(spark, "deliveries")
    once = streams.first_deliveries(_event_stream(spark, folder))
    streams.write_appended(once, f"{root}/images", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/images").select("image_id")


# ---- Late events and state that expires ------------------------------------------------

# Events arrive in six runs of five days each, but every tenth only two runs later.
_RUN_STARTS = ("2024-01-06", "2024-01-11", "2024-01-16", "2024-01-21", "2024-01-26")
_LAST_RUN = len(_RUN_STARTS)
_OWN_RUN = " + ".join(f"case when uploaded_at >= timestamp '{d} 00:00:00' then 1 else 0 end" for d in _RUN_STARTS)
_ARRIVAL = f"case when event_id % 10 = 3 then least({_OWN_RUN} + 2, {_LAST_RUN}) else {_OWN_RUN} end"

# A stream reads the watermark of a run from the events of the runs before it, in whole milliseconds.
_RUNS_SQL = f"""
    arrived as (select event_id, image_id, source, uploaded_at, {_ARRIVAL} as run from image_events),
    latest as (
      select run, date_trunc('milliseconds', max(max(uploaded_at)) over (order by run rows between unbounded preceding and 1 preceding)) as seen
      from arrived group by run)"""

# At most one event of an image in a run, so that which one is first doesn't depend on the order inside a run.
_SINGLE_SQL = f"""{_RUNS_SQL},
    single as (
      select a.*, seen from arrived a left join latest using (run)
      qualify row_number() over (partition by image_id, run order by uploaded_at, event_id) = 1),
    ontime as (select * from single where seen is null or uploaded_at > seen - interval 7 days),
    run0 as (select * from ontime where run = 0)""" + "".join(f""",
    run{n} as (
      select * from run{n - 1} union all
      select * from ontime o where run = {n} and not exists (
        select 1 from run{n - 1} p where p.image_id = o.image_id and p.uploaded_at + interval 7 days > o.seen - interval 7 days))"""
    for n in range(1, _LAST_RUN + 1))


def _arrivals(spark: SparkSession, folder: str) -> DataFrame:
    rows = image_events(spark, folder).select("event_id", "image_id", "source", "uploaded_at", F.expr(_ARRIVAL).alias("run"))
    return rows.withColumn("uploaded_at", F.col("uploaded_at").cast("timestamp"))


def _run_by_run(spark: SparkSession, root: str, arrivals: DataFrame, start) -> list[streams.Finished]:
    """Each run's events arrive, then a stream takes what is new and stops, as once an hour."""
    schema, done = arrivals.schema, []
    for run in range(_LAST_RUN + 1):
        arrivals.where(F.col("run") == run).write.mode("append").parquet(f"{root}/in")
        with streams.rocksdb_state(spark):
            query = streams.write_appended(start(spark.readStream.schema(schema).parquet(f"{root}/in")), f"{root}/out", f"{root}/checkpoint")
        done.append(streams.finished(spark, query))
    return done


def _deliver(spark: SparkSession, folder: str) -> tuple[str, list[streams.Finished]]:
    root = scratch_path(spark, "deliveries")
    single = keep_first(_arrivals(spark, folder), ["image_id", "run"], ["uploaded_at", "event_id"])
    return root, _run_by_run(spark, root, single, streams.first_deliveries)


@_q.add(duck(f"with {_SINGLE_SQL} select event_id, image_id, uploaded_at, run from run{_LAST_RUN}", "image_events"))
def stream_deliveries_by_run(spark: SparkSession, folder: str) -> DataFrame:
    """What the deduplication passes on over six runs: events older than the window are refused, an
    image that comes back after its state has expired passes again."""
    root, _ = _deliver(spark, folder)
    return spark.read.parquet(f"{root}/out").select(
        "event_id", "image_id", F.col("uploaded_at").cast("timestamp_ntz").alias("uploaded_at"), "run")


@_q.add(duck(f"""
    with {_SINGLE_SQL}
    select run, count(*) as rows_read, count(*) filter (uploaded_at <= seen - interval 7 days) as rows_refused,
      (select count(*) from run{_LAST_RUN} r where r.run = s.run) as rows_delivered from single s group by run""", "image_events"))
def stream_refused_by_run(spark: SparkSession, folder: str) -> DataFrame:
    """Rows read, refused by the watermark and delivered in each run, as the stream itself counts them."""
    root, done = _deliver(spark, folder)
    counted = spark.createDataFrame([(n, d.rows, d.refused) for n, d in enumerate(done)], "run int, rows_read long, rows_refused long")
    delivered = spark.read.parquet(f"{root}/out").groupBy("run").agg(F.count(F.lit(1)).alias("rows_delivered"))
    return counted.join(delivered, "run", "left").fillna(0, ["rows_delivered"])


@_q.add(duck(f"""
    with {_RUNS_SQL}
    select date_trunc('hour', uploaded_at) as hour_start, source, count(*) as uploads
    from arrived left join latest using (run)
    where (seen is null or date_trunc('hour', uploaded_at) + interval 1 hour > seen - interval 1 hour)
      and date_trunc('hour', uploaded_at) + interval 1 hour <= (select date_trunc('milliseconds', max(uploaded_at)) from arrived) - interval 1 hour
    group by all""", "image_events"))
def stream_hours_without_late(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly counts over six runs: a closed hour is emitted once and refuses what comes after."""
    root = scratch_path(spark, "late-hours")
    _run_by_run(spark, root, _arrivals(spark, folder), streams.hourly_counts)
    return spark.read.parquet(f"{root}/out").withColumn("hour_start", F.col("hour_start").cast("timestamp_ntz"))


@_q.add(duck(f"select * from ({_STATUS}) s where expires_at >= timestamp '{_CUTOFF}'", "image_events"))
def stream_image_status(spark: SparkSession, folder: str) -> DataFrame:
    """The index after five micro-batches, each bucket folded at every second: images not expired at the cut-off."""
    root = scratch_path(spark, "status")
    _track(spark, root, table(spark, folder, "events"))
    since = F.lit(_CUTOFF.isoformat(sep=" ")).cast("timestamp_ntz")
    status = state.read_status(spark, f"{root}/state", since=since.cast("timestamp"))
    return status.drop("last_at").withColumn("expires_at", F.col("expires_at").cast("timestamp_ntz"))


def _track(spark: SparkSession, root: str, given: DataFrame) -> None:
    """The status index of the given events below ``root``, from five micro-batches in order of time."""
    given.repartitionByRange(5, "ts").write.parquet(f"{root}/events.parquet")
    events = _event_stream(spark, root, maxFilesPerTrigger=1)
    state.track_status(events, f"{root}/state", f"{root}/checkpoint", compact_every=2, buckets=16).awaitTermination()


@_q.add(duck(f"""
    with incoming as (select * from image_events where uploaded_at >= timestamp '{_CUTOFF}'),
    done as (
      select image_id from image_events where uploaded_at < timestamp '{_CUTOFF}' group by image_id
      having arg_max(status, (uploaded_at, {_RANK})) = 'DONE'
        and min(uploaded_at) + interval 7 days >= (select min(uploaded_at) from incoming))
    select event_id, image_id, uploaded_at from (
      select * from incoming qualify row_number() over (partition by image_id order by uploaded_at, source, event_id) = 1)
    where image_id not in (select image_id from done)""", "image_events"))
def stream_skip_processed(spark: SparkSession, folder: str) -> DataFrame:
    """One micro-batch after the cut-off against the index of the events before it; expired images are new again."""
    root, given = scratch_path(spark, "skip"), table(spark, folder, "events")
    cut = F.lit(_CUTOFF.isoformat(sep=" ")).cast("timestamp_ntz")
    _track(spark, root, given.where(F.col("ts") < cut))
    given.where(F.col("ts") >= cut).write.parquet(f"{root}/incoming/events.parquet")
    incoming = _event_stream(spark, f"{root}/incoming").withColumn("dt", F.to_date("uploaded_at"))
    state.process_new_images(incoming, f"{root}/state", f"{root}/todo", f"{root}/todo-checkpoint", ["source", "event_id"]).awaitTermination()
    return spark.read.parquet(f"{root}/todo").select("event_id", "image_id", F.col("uploaded_at").cast("timestamp_ntz").alias("uploaded_at"))


_PERCENTILES = ", ".join(
    f"round(quantile_cont(duration_ms, {p}), 4) as {name}" for name, p in ev.LATENCY_PERCENTILES.items()
)


def _rounded(frame: DataFrame) -> DataFrame:
    return frame.withColumns({name: F.round(name, 4) for name in ev.LATENCY_PERCENTILES})


@_q.add(duck(f"select source, {_PERCENTILES} from image_events group by source", "image_events"))
def latency_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(ev.latency_percentiles(image_events(spark, folder)))


@_q.add(duck(f"select source, {_PERCENTILES}, true as within_bound from image_events group by source", "image_events"))
def latency_percentiles_estimate(spark: SparkSession, folder: str) -> DataFrame:
    """The exact values, and whether each estimate's rank is as near as the sketch promises."""
    rows, accuracy = image_events(spark, folder).where("duration_ms is not null"), 10000
    estimates = quantiles.estimated_percentiles(rows, ["source"], "duration_ms", ev.LATENCY_PERCENTILES, accuracy)
    named = estimates.withColumnsRenamed({n: f"est_{n}" for n in ev.LATENCY_PERCENTILES})
    total, near = F.count(F.lit(1)), []
    for name, share in ev.LATENCY_PERCENTILES.items():
        slack = total / accuracy + 1
        near.append((F.count_if(F.col("duration_ms") < F.col(f"est_{name}")) <= share * total + slack)
                    & (F.count_if(F.col("duration_ms") <= F.col(f"est_{name}")) >= share * total - slack))
    ranked = lookup_join(rows, named, ["source"], "inner", null_safe=True).groupBy("source").agg(
        reduce(and_, near).alias("within_bound")
    )
    exact = _rounded(ev.latency_percentiles(rows))
    return lookup_join(exact, ranked, ["source"], "inner", null_safe=True)


@_q.add(duck("""
    select dt, count(*) as images, count(*) filter (status = 'ERROR') as failed,
      round(count(*) filter (status = 'ERROR') / count(*), 6) as failure_rate
    from image_events group by dt""", "image_events"))
def failure_rate_daily(spark: SparkSession, folder: str) -> DataFrame:
    return ev.failure_rate_daily(image_events(spark, folder))


@_q.add(duck("""
    select format, count(*) as images, round(count(*) / sum(count(*)) over (), 6) as share
    from image_events group by format""", "image_events"))
def format_mix(spark: SparkSession, folder: str) -> DataFrame:
    return ev.format_mix(image_events(spark, folder))


@_q.add(duck(f"""
    select dt, source, count(*) as images, count(*) filter (status = 'ERROR') as failed,
      round(count(*) filter (status = 'ERROR') / count(*), 6) as failure_rate,
      cast(sum(bytes_in) as bigint) as bytes_in, {_PERCENTILES}
    from image_events group by dt, source""", "image_events"))
def daily_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(ev.daily_metrics(image_events(spark, folder)))


_WEEKLY = """
    select date_trunc('week', dt)::date as week, source, count(*) as images, count(*) filter (status = 'ERROR') as failed,
      cast(sum(bytes_in) as bigint) as bytes_in, round(count(*) filter (status = 'ERROR') / count(*), 6) as failure_rate,
      true as percentiles_within_bound, true as distinct_within_bound
    from image_events group by all"""


@_q.add(duck(_WEEKLY, "image_events"))
def weekly_metrics_from_summaries(spark: SparkSession, folder: str) -> DataFrame:
    """Weeks rolled up from stored daily rows; the events serve to hold the estimates against their bounds only."""
    root, events = scratch_path(spark, "summaries"), image_events(spark, folder)
    tables.write_by_day(summaries.daily_summaries(events), root)
    week = {"week": F.to_date(F.date_trunc("week", "dt")), "source": F.col("source")}
    weekly = summaries.summary_metrics(summaries.rolled_up(spark.read.parquet(root), week))
    told = weekly.select("week", "source", "distinct_images", *ev.LATENCY_PERCENTILES)
    rows = lookup_join(events.withColumn("week", week["week"]).select("week", "source", "duration_ms", "image_id"), told, ["week", "source"],
                       "inner", null_safe=True)
    total, near = F.count("duration_ms"), []
    for name, share in ev.LATENCY_PERCENTILES.items():
        slack = 2 * summaries.rank_error() * total + 1
        near.append((F.count_if(F.col("duration_ms") < F.col(name)) <= share * total + slack)
                    & (F.count_if(F.col("duration_ms") <= F.col(name)) >= share * total - slack))
    exact = F.count_distinct("image_id")
    held = rows.groupBy("week", "source").agg(
        reduce(and_, near).alias("percentiles_within_bound"),
        (F.abs(F.first("distinct_images") - exact) <= 4 * summaries.distinct_error() * exact + 1).alias("distinct_within_bound"))
    return weekly.drop("distinct_images", *ev.LATENCY_PERCENTILES).join(held, ["week", "source"])


@_q.add(duck(f"select week, sum(images)::bigint as images, sum(failed)::bigint as failed, sum(bytes_in)::bigint as bytes_in from ({_WEEKLY}) w group by week",
             "image_events"))
def weekly_metrics_after_sweep(spark: SparkSession, folder: str) -> DataFrame:
    """All weeks, although the sweep has removed the events of most; daily rows are rolled up twice."""
    root, events = scratch_path(spark, "swept-summaries"), image_events(spark, folder)
    tables.write_by_day(summaries.daily_summaries(events), f"{root}/daily")
    tables.write_by_day(retention.kept(events, _CUTOFF), f"{root}/events")
    by_source = summaries.rolled_up(spark.read.parquet(f"{root}/daily"), {"dt": F.col("dt"), "source": F.lit("all")})
    weekly = summaries.rolled_up(by_source, {"week": F.to_date(F.date_trunc("week", "dt"))})
    return summaries.summary_metrics(weekly).select("week", "images", "failed", "bytes_in")


# ---- Retention ------------------------------------------------------------------------

_LIMIT = f"timestamp '{_CUTOFF}' - interval 7 days"


@_q.add(duck(f"select event_id, image_id, uploaded_at from image_events where uploaded_at < {_LIMIT}", "image_events"))
def retention_expired(spark: SparkSession, folder: str) -> DataFrame:
    return retention.expired(image_events(spark, folder), _CUTOFF).select("event_id", "image_id", "uploaded_at")


@_q.add(duck(f"select event_id, image_id, uploaded_at from image_events where uploaded_at >= {_LIMIT}", "image_events"))
def retention_kept(spark: SparkSession, folder: str) -> DataFrame:
    return retention.kept(image_events(spark, folder), _CUTOFF).select("event_id", "image_id", "uploaded_at")


@_q.add(duck(f"""
    select dt, objects, objects_older_than_7d, case when objects_older_than_7d = objects then 'drop'
      when objects_older_than_7d > 0 then 'rewrite' else 'keep' end as action
    from (select dt, count(*) as objects, count(*) filter (uploaded_at < {_LIMIT}) as objects_older_than_7d
      from image_events group by dt) d""", "image_events"))
def retention_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return retention.manifest(image_events(spark, folder), _CUTOFF)


@_q.add(duck(f"""
    select dt, count(*) as objects, count(*) filter (uploaded_at < {_LIMIT}) as objects_older_than_7d
    from image_events where uploaded_at >= {_LIMIT} or uploaded_at is null group by dt""", "image_events"))
def retention_after_sweep(spark: SparkSession, folder: str) -> DataFrame:
    """What a swept table holds, per day: nothing older than the limit, and everything else."""
    name = f"swept_{uuid.uuid4().hex}"
    image_events(spark, folder).select("event_id", "uploaded_at", "dt").write.partitionBy("dt").saveAsTable(name)
    try:
        retention.sweep_table(spark, name, _CUTOFF)
        return settled(retention.manifest(spark.table(name), _CUTOFF).drop("action"))
    finally:
        spark.sql(f"DROP TABLE {name}")
