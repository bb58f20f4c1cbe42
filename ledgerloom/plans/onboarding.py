"""Queries of the onboarding flow, over the applications derived from ``customer``."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .. import functions as fx, rules
from ..operators import applications as ap, integrity, quality, sampling, summaries
from ..session import scratch_path
from ..sources import batches, replay, runs, sinks, tables
from ..streaming.applications import stream_applications as start_applications
from .registry import Collected
from .views import applications, duck, table

_q = Collected()
QUERIES = _q.queries

_POSITION = ["source_file", "app_id"]
_BATCHES = ("batch_0.csv", "batch_1.csv", "batch_2.csv")
_RUNS = (datetime(2026, 9, 17, 10, 0, 0), datetime(2026, 9, 18, 10, 41, 59))


def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return ap.clean(applications(spark, folder))


def validated(spark: SparkSession, folder: str, reference: date = rules.REFERENCE_DATE) -> DataFrame:
    return ap.validate(ap.clean(applications(spark, folder), reference))


def accepted(spark: SparkSession, folder: str) -> DataFrame:
    """Accepted rows with their place in the input."""
    return ap.decided(validated(spark, folder)).where("is_successful").select(
        "membership_id", "first_name", "last_name", "email", F.col("birthday_ymd").alias("birthday"),
        "above_18", F.col("mobile_normalised").alias("mobile"), "source_file", "app_id",
    )


# ---- Ingest ---------------------------------------------------------------------


def _csv_folder(spark: SparkSession, folder: str) -> str:
    """The applications as CSV batches in three layouts: usual, reordered, with an extra column."""
    rows = applications(spark, folder)
    source = {v: k for k, v in rules.SOURCE_COLUMNS.items()}
    layouts = {
        "batch_0.csv": ["name", "email", "birthday", "mobile"],
        "batch_1.csv": ["mobile", "birthday", "email", "name"],
        "batch_2.csv": ["app_id", "name", "email", "birthday", "mobile"],
    }
    root = scratch_path(spark, "batches")
    for file, columns in layouts.items():
        batch = rows.where(F.col("source_file") == file)
        named = batch.select(*[F.col(c).alias(source.get(c, c)) for c in columns])
        (named.write.mode("append").option("header", True).option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(root))
    return root


@_q.add(duck("select name, email, birthday, mobile from applications", "applications"))
def ingest_applications(spark: SparkSession, folder: str) -> DataFrame:
    files = batches.discover_batches(spark, _csv_folder(spark, folder))
    return batches.scan_batches(spark, files).select("name", "email", "birthday", "mobile")


# What line-by-line reading would lose or tear: a blank row, a carriage return inside a
# name, a line break inside a name. Each file also holds all applications of one batch.
_AWKWARD = {"batch_0.csv": "   ,,,\n", "batch_1.csv": "Bob\rHorn,b@x.com,1990-01-01,11111111\n",
            "batch_2.csv": '"Cy\nDee",c@x.com,1991-01-01,22222222\n'}


def _awkward_folder(spark: SparkSession, folder: str) -> str:
    """One file per batch, with an awkward row in the middle."""
    rows = applications(spark, folder)
    root = scratch_path(spark, "awkward")
    cell = [F.coalesce(F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')), F.lit(""))
            for c in (F.col("name"), F.col("email"), F.col("birthday"), F.col("mobile"))]
    header = ",".join(rules.SOURCE_COLUMNS)
    for n, (file, awkward) in enumerate(_AWKWARD.items()):
        body = rows.where(F.col("source_file") == file).select(F.concat_ws(",", *cell).alias("value"))
        line = spark.createDataFrame([(awkward.rstrip("\n"),)], "value string")
        # The header is one line per part file: every part is a batch of its own.
        parts = body.union(line).coalesce(1)
        parts = parts.select(F.when(F.monotonically_increasing_id() == 0, F.concat(F.lit(header + "\n"), "value")).otherwise(F.col("value")))
        parts.write.option("lineSep", "\n").text(f"{root}/{n}")
    return root


@_q.add(duck("""
    select name, email, birthday, mobile from applications
    union all values ('   ', null, null, null), ('Bob' || chr(13) || 'Horn', 'b@x.com', '1990-01-01', '11111111'),
      ('Cy' || chr(10) || 'Dee', 'c@x.com', '1991-01-01', '22222222')""", "applications"))
def ingest_awkward_rows(spark: SparkSession, folder: str) -> DataFrame:
    root = _awkward_folder(spark, folder)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").load(root)
    files = [r["path"] for r in listed.select("path").collect()]
    return batches.scan_batches(spark, files).select("name", "email", "birthday", "mobile")


# Names and addresses of every third application get line breaks, quotes and commas.
_SPANNING = "case when app_id % 3 = 0 then concat(coalesce({c}, ''), chr(10), '\"', app_id, '\", ', chr(10), chr(10), ',') else {c} end"


def _write_batch(rows: DataFrame, path: str) -> None:
    """Append applications to a folder of CSV files with the headers of the source."""
    named = rows.select("name", "email", "birthday", "mobile").withColumnsRenamed({v: k for k, v in rules.SOURCE_COLUMNS.items()})
    (named.write.mode("append").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def _by_batch(spark: SparkSession, rows: DataFrame, label: str) -> str:
    """One folder of CSV files per batch."""
    root = scratch_path(spark, label)
    for batch in _BATCHES:
        _write_batch(rows.where(F.col("source_file") == batch), f"{root}/source_file={batch}")
    return root


def _with_batch(spark: SparkSession, root: str) -> DataFrame:
    """The rows of all files below ``root``, each with the batch folder that its ``source_file`` lies in."""
    files = _listed(spark, root)
    rows = batches.scan_batches(spark, [r["path"] for r in files.collect()])
    return rows.join(F.broadcast(files.select("source_file", "batch")), "source_file").drop("source_file")


def _listed(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """(path, source_file, batch) of the files below the batch folders of ``root``."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    return listed.select("path", F.col("_metadata.file_name").alias("source_file"),
                         F.regexp_extract("path", "source_file=([^/]+)", 1).alias("batch"))


@_q.add(duck(f"""
    select {', '.join(_SPANNING.format(c=c) + ' as ' + c for c in ('name', 'email'))}, birthday, mobile, source_file as batch
    from applications""", "applications"))
def ingest_spanning_records(spark: SparkSession, folder: str) -> DataFrame:
    """Records that span lines, put together from lines that are read in parallel."""
    rows = applications(spark, folder).selectExpr(
        *[f"{_SPANNING.format(c=c)} as {c}" for c in ("name", "email")], "birthday", "mobile", "source_file")
    return _with_batch(spark, _by_batch(spark, rows, "spanning"))


@_q.add(duck("select name, email, birthday, mobile, source_file as batch from applications", "applications"))
def ingest_provenance(spark: SparkSession, folder: str) -> DataFrame:
    """Each row with the batch that its ``source_file`` was written from."""
    return _with_batch(spark, _by_batch(spark, applications(spark, folder), "provenance"))


def _ledger_runs(spark: SparkSession, folder: str, fmt: str = "parquet") -> str:
    """Three runs over one folder: two batches, then a third that arrives, then the second run again.

    In between a run finds nothing to do. All share a ledger.
    """
    out, rows = scratch_path(spark, "ledger-runs"), applications(spark, folder)
    inbox, ledger = f"{out}/in", f"{out}/ledger"

    def arrive(*arrived: str) -> None:
        _write_batch(rows.where(F.col("source_file").isin(*arrived)), inbox)

    first, second = _RUNS
    arrive(*_BATCHES[:2])
    runs.run(spark, inbox, f"{out}/out", first, ledger=ledger, fmt=fmt)
    runs.run(spark, inbox, f"{out}/out", first + timedelta(hours=1), ledger=ledger, fmt=fmt)
    arrive(*_BATCHES[2:])
    for _ in range(2):
        runs.run(spark, inbox, f"{out}/out", second, ledger=ledger, fmt=fmt)
    return f"{out}/out"


_RUN_OF = f"case when source_file = '{_BATCHES[2]}' then '{_RUNS[1]:%Y%m%d_%H%M%S}' else '{_RUNS[0]:%Y%m%d_%H%M%S}' end"


@_q.add(duck(f"""
    select {_RUN_OF} as run_ts, count(*) as rows_read, count(*) filter (is_successful) as rows_successful,
      count(*) filter (not is_successful) as rows_unsuccessful from validated group by all""", "validated"))
def ledger_run_records(spark: SparkSession, folder: str) -> DataFrame:
    """Audit rows: finished files are not read again, an idle run leaves none, a repeated one replaces its own."""
    return sinks.read_records(spark, _ledger_runs(spark, folder)).drop("files").withColumn("run_ts", F.col("run_ts").cast("string"))


@_q.add(duck(f"""
    select membership_id, first_name, last_name, email, birthday, above_18, mobile, {_RUN_OF} as run_ts from accepted""", "accepted"))
def ledger_run_outputs(spark: SparkSession, folder: str) -> DataFrame:
    out = _ledger_runs(spark, folder)
    return spark.read.parquet(f"{out}/successful").withColumn("run_ts", F.col("run_ts").cast("string"))


@_q.add(duck(f"""
    select name, email, birthday_raw, mobile_raw, first_name, last_name, birthday, cast(age as varchar) as age,
      cast(above_18 as varchar) as above_18, rejection_reason, {_RUN_OF} as run_ts from rejected""", "rejected"))
def ledger_run_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The rejected output of the same runs as CSV, read back as text.

    A null is an empty cell and an empty text a quoted one; with another mark for null the reader tells them apart.
    """
    out = _ledger_runs(spark, folder, "csv")
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", True).option("nullValue", "\0")
    return reader.csv(f"{out}/unsuccessful").drop("source_file").withColumn("run_ts", F.col("run_ts").cast("string"))


@_q.add(duck("select app_id, name, email, source_file from applications", "applications"))
def batch_union(spark: SparkSession, folder: str) -> DataFrame:
    rows = applications(spark, folder)
    first = rows.where("source_file = 'batch_0.csv'").select("app_id", "name", "email", "source_file")
    second = rows.where("source_file = 'batch_1.csv'").select("source_file", "email", "name", "app_id")
    third = rows.where("source_file = 'batch_2.csv'").select("email", "app_id", "source_file", "name")
    return batches.union_batches([first, second, third])


@_q.add(duck("""
    select membership_id, first_name, last_name, email, birthday, above_18, mobile from accepted""", "accepted"))
def stream_applications(spark: SparkSession, folder: str) -> DataFrame:
    out = scratch_path(spark, "stream-applications")
    start_applications(spark, _csv_folder(spark, folder), out, f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/successful").drop("batch_id")


@_q.add(duck("""
    select name, email, birthday_raw, mobile_raw, first_name, last_name, birthday, age, above_18, rejection_reason
    from rejected""", "rejected"))
def stream_rejected_applications(spark: SparkSession, folder: str) -> DataFrame:
    out = scratch_path(spark, "stream-rejected")
    start_applications(spark, _csv_folder(spark, folder), out, f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/unsuccessful").drop("batch_id", "source_file")


@_q.add(duck("""
    select count(*) as rows_read, count(*) filter (is_successful) as rows_successful,
      count(*) filter (not is_successful) as rows_unsuccessful from validated""", "validated"))
def stream_run_records(spark: SparkSession, folder: str) -> DataFrame:
    """Audit rows of a stream that takes two files at a time, added up."""
    out = scratch_path(spark, "stream-records")
    start_applications(spark, _csv_folder(spark, folder), out, f"{out}/checkpoint", max_files=2).awaitTermination()
    counts = ("rows_read", "rows_successful", "rows_unsuccessful")
    return sinks.read_records(spark, out).agg(*[F.sum(c).alias(c) for c in counts])


@_q.add(duck("""
    select membership_id, first_name, last_name, email, birthday, above_18, mobile from accepted""", "accepted"))
def latest_run_slice(spark: SparkSession, folder: str) -> DataFrame:
    out = scratch_path(spark, "runs")
    for run_ts, reference in zip(_RUNS, (date(2021, 1, 1), rules.REFERENCE_DATE)):
        sinks.write_outputs(validated(spark, folder, reference), out, run_ts)
    return tables.latest_run(spark, out).drop("run_ts")


@_q.add("""
    select o_orderkey, strptime(strftime(o_orderdate, '%Y%m%d_%H%M%S'), '%Y%m%d_%H%M%S') as run_ts from orders""")
def file_stamp_parse(spark: SparkSession, folder: str) -> DataFrame:
    name = F.concat(F.lit("successful_applications_"), F.date_format("o_orderdate", "yyyyMMdd_HHmmss"), F.lit(".csv"))
    return table(spark, folder, "orders").select("o_orderkey", fx.run_stamp_of(name).alias("run_ts"))


@_q.add(duck("""
    select membership_id, first_name, last_name, email, cast(strptime(birthday, '%Y%m%d') as date) as birthday,
      above_18, mobile from accepted""", "accepted"))
def members_typed_load(spark: SparkSession, folder: str) -> DataFrame:
    as_text = accepted(spark, folder).withColumn("above_18", F.col("above_18").cast("string"))
    return tables.typed_members(as_text)


# ---- Column builders ------------------------------------------------------------


@_q.add(duck("""
    select app_id, len(tokens) as token_count, array_to_string(tokens, '|') as tokens
    from (select app_id, regexp_extract_all(name, '\\S+') as tokens from applications)""", "applications"))
def name_tokens(spark: SparkSession, folder: str) -> DataFrame:
    tokens = fx.name_tokens(F.col("name"))
    return applications(spark, folder).select("app_id", tokens.alias("t")).select(
        "app_id", F.array_size("t").cast("long").alias("token_count"), F.array_join("t", "|").alias("tokens")
    )


@_q.add(duck("select app_id, array_to_string(core, '|') as core from cleaned", "cleaned"))
def name_core(spark: SparkSession, folder: str) -> DataFrame:
    core = fx.core_tokens(fx.core_name(F.col("name")))
    return applications(spark, folder).select("app_id", F.array_join(core, "|").alias("core"))


@_q.add(duck("select app_id, name, first_name, last_name from cleaned", "cleaned"))
def name_split(spark: SparkSession, folder: str) -> DataFrame:
    return cleaned(spark, folder).select("app_id", "name", "first_name", "last_name")


@_q.add(duck("select app_id, birthday, birthday_date, birthday_ymd from cleaned", "cleaned"))
def birthday_parse(spark: SparkSession, folder: str) -> DataFrame:
    return cleaned(spark, folder).select("app_id", "birthday", "birthday_date", "birthday_ymd")


@_q.add(duck("select app_id, birthday_date, age, above_18 from checked", "checked"))
def age_at_reference(spark: SparkSession, folder: str) -> DataFrame:
    return cleaned(spark, folder).select("app_id", "birthday_date", "age", "above_18")


@_q.add(duck("select app_id, mobile, mobile_normalised from cleaned", "cleaned"))
def mobile_normalise(spark: SparkSession, folder: str) -> DataFrame:
    return cleaned(spark, folder).select("app_id", "mobile", "mobile_normalised")


@_q.add(duck("""
    select app_id, email, not f_email as accepted,
      coalesce(regexp_matches(lower(trim(email)), '@emailprovider\\.(com|net)$'), false) as accepted_strict
    from checked""", "checked"))
def email_suffix_check(spark: SparkSession, folder: str) -> DataFrame:
    def passes(suffixes):
        return F.coalesce(fx.has_suffix(F.col("email"), suffixes), F.lit(False))

    return applications(spark, folder).select(
        "app_id", "email", passes(rules.EMAIL_SUFFIXES).alias("accepted"),
        passes(rules.EMAIL_SUFFIXES_STRICT).alias("accepted_strict"),
    )


@_q.add(duck("select app_id, birthday_ymd, substring(sha256(birthday_ymd), 1, 5) as birthday_hash from cleaned", "cleaned"))
def birthday_hash(spark: SparkSession, folder: str) -> DataFrame:
    return cleaned(spark, folder).select(
        "app_id", "birthday_ymd", fx.birthday_hash(F.col("birthday_ymd")).alias("birthday_hash")
    )


@_q.add(duck("select app_id, is_successful, membership_id from validated", "validated"))
def membership_ids(spark: SparkSession, folder: str) -> DataFrame:
    return validated(spark, folder).select("app_id", "is_successful", "membership_id")


@_q.add(duck("""
    select app_id, name, email, birthday, mobile, source_file, first_name, last_name, birthday_date,
      mobile_normalised, birthday_ymd, age, above_18 from checked""", "checked"))
def applications_clean(spark: SparkSession, folder: str) -> DataFrame:
    return cleaned(spark, folder)


# ---- Verdicts -------------------------------------------------------------------


@_q.add(duck("""
    select app_id, f_name as missing_name, f_birthday as unparseable_birthday, f_age as under_18,
      f_mobile as invalid_mobile, f_email as invalid_email from checked""", "checked"))
def rule_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return ap.rule_matrix(cleaned(spark, folder), ap.application_rules(), ["app_id"])


@_q.add(duck("select app_id, rejection_reason from validated", "validated"))
def rejection_reasons(spark: SparkSession, folder: str) -> DataFrame:
    return cleaned(spark, folder).select(
        "app_id", ap.failed_codes(ap.application_rules()).alias("rejection_reason")
    )


@_q.add(duck("""
    select app_id, name, email, birthday, mobile, source_file, first_name, last_name, birthday_date,
      mobile_normalised, birthday_ymd, age, above_18, is_successful, rejection_reason, membership_id
    from validated""", "validated"))
def applications_validated(spark: SparkSession, folder: str) -> DataFrame:
    return validated(spark, folder)


@_q.add(duck("""
    select membership_id, first_name, last_name, email, birthday, above_18, mobile from accepted""", "accepted"))
def successful_applications(spark: SparkSession, folder: str) -> DataFrame:
    return ap.successful(validated(spark, folder))


@_q.add(duck("select * from rejected", "rejected"))
def unsuccessful_applications(spark: SparkSession, folder: str) -> DataFrame:
    return ap.unsuccessful(validated(spark, folder))


# Stored outputs as if someone had edited them: some reasons, ids, mobiles and birthdays.
_EDITED_REASON = "case when mobile_raw like '%1' then 'edited' else rejection_reason end"
_EDITED = {
    "membership_id": "case when last_name = 'Lee' then concat(membership_id, 'x') else membership_id end",
    "mobile": "case when mobile like '%7' then substring(mobile, 2) else mobile end",
    "birthday": "case when mobile like '%30' then concat(birthday, '0') when mobile like '%31' then '20100101' else birthday end",
    "email": "case when mobile like '%4' then concat(email, '.org') else email end",
}


@_q.add(duck(f"""
    select name, email, birthday_raw, mobile_raw, {_EDITED_REASON} as stored_reason,
      rejection_reason as recomputed_reason, source_file
    from rejected where rejection_reason <> {_EDITED_REASON}""", "rejected"))
def verdict_recheck(spark: SparkSession, folder: str) -> DataFrame:
    stored = ap.unsuccessful(validated(spark, folder)).withColumn("rejection_reason", F.expr(_EDITED_REASON))
    return ap.recheck_rejections(stored)


@_q.add(duck(f"""
    with edited as (
      select {', '.join(f"{e} as {c}" for c, e in _EDITED.items())}, first_name, last_name, above_18, app_id from accepted),
    dated as (
      select *, case when regexp_full_match(birthday, '[0-9]{{8}}') then try_strptime(birthday, '%Y%m%d') end as born from edited),
    judged as (
      select app_id, membership_id, concat_ws(';',
        case when born is null then 'birthday_layout' end,
        case when not coalesce(born <= date '2003-01-01' and above_18, false) then 'above_18' end,
        case when not regexp_full_match(mobile, '[0-9]{{8}}') then 'mobile' end,
        case when not (lower(trim(email)) like '%.com' or lower(trim(email)) like '%.net') then 'email' end,
        case when membership_id <> concat(last_name, '_', substring(sha256(birthday), 1, 5)) then 'membership_id' end) as broken
      from dated)
    select * from judged where broken <> ''""", "accepted"))
def accepted_recheck(spark: SparkSession, folder: str) -> DataFrame:
    stored = accepted(spark, folder).withColumns({c: F.expr(e) for c, e in _EDITED.items()})
    return ap.recheck_accepted(stored).select("app_id", "membership_id", "broken")


_LATER = """
    with later as (
      select *, concat_ws(';',
        case when f_name then 'missing_name' end, case when f_birthday then 'unparseable_birthday' end,
        case when birthday_date is not null and age + 1 <= 18 then 'under_18' end,
        case when f_mobile then 'invalid_mobile' end, case when f_email then 'invalid_email' end) as later_reason
      from validated)"""


@_q.add(duck(_LATER + """
    select name, email, birthday as birthday_raw, mobile as mobile_raw, rejection_reason as stored_reason,
      later_reason as recomputed_reason, source_file
    from later where rejection_reason <> '' and rejection_reason <> later_reason""", "validated"))
def verdict_recheck_later_reference(spark: SparkSession, folder: str) -> DataFrame:
    return ap.recheck_rejections(ap.unsuccessful(validated(spark, folder)), reference=date(2023, 1, 1))


# ---- Profiles -------------------------------------------------------------------


@_q.add(duck("""
    select rejection_reason, count(*) as applications, round(count(*) / sum(count(*)) over (), 6) as share
    from rejected group by rejection_reason""", "rejected"))
def rejection_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return quality.rejection_histogram(validated(spark, folder))


@_q.add(duck("""
    select 'missing_name' as rule, count(*) filter (f_name) as failures from checked
    union all select 'unparseable_birthday', count(*) filter (f_birthday) from checked
    union all select 'under_18', count(*) filter (f_age) from checked
    union all select 'invalid_mobile', count(*) filter (f_mobile) from checked
    union all select 'invalid_email', count(*) filter (f_email) from checked""", "checked"))
def rejections_by_rule(spark: SparkSession, folder: str) -> DataFrame:
    return quality.rejections_by_rule(cleaned(spark, folder), ap.application_rules())


@_q.add(duck("""
    select source_file, count(*) as rows_in, count(*) filter (not is_successful) as unsuccessful
    from validated group by source_file""", "validated"))
def rejects_by_source_file(spark: SparkSession, folder: str) -> DataFrame:
    return quality.rejections_by_file(validated(spark, folder))


@_q.add(duck("""
    select count(*) as rows_in, count(*) filter (is_successful) as successful,
      count(*) filter (not is_successful) as unsuccessful, true as balanced from validated""", "validated"))
def run_summary(spark: SparkSession, folder: str) -> DataFrame:
    return quality.run_counts(validated(spark, folder))


@_q.add(duck("""
    select count(*) as members, count(distinct membership_id) as distinct_ids,
      (select count(*) from (select 1 from accepted group by membership_id having count(*) > 1)) as colliding_ids
    from accepted""", "accepted"))
def membership_id_uniqueness(spark: SparkSession, folder: str) -> DataFrame:
    return quality.id_uniqueness(accepted(spark, folder))


@_q.add(duck("""
    select membership_id, count(*) as applicants from accepted group by 1 having count(*) > 1""", "accepted"))
def membership_id_collisions(spark: SparkSession, folder: str) -> DataFrame:
    return quality.id_collisions(accepted(spark, folder))


@_q.add(duck("""
    select * from (select *, count(*) over (partition by membership_id) as applicants from accepted)
    where applicants > 1""", "accepted"))
def membership_id_collision_rows(spark: SparkSession, folder: str) -> DataFrame:
    return quality.collision_rows(accepted(spark, folder))


@_q.add(duck("""
    select count(*) as emails, count(distinct split_part(lower(trim(email)), '@', -1)) as distinct_domains
    from applications where email like '%@%'""", "applications"))
def email_domain_profile(spark: SparkSession, folder: str) -> DataFrame:
    return quality.email_domain_profile(applications(spark, folder))


@_q.add(duck("""
    select count(*) as emails, count(distinct split_part(lower(trim(email)), '@', -1)) as distinct_domains,
      true as within_bound
    from applications where email like '%@%'""", "applications"))
def email_domain_estimate(spark: SparkSession, folder: str) -> DataFrame:
    """The exact number, and whether the sketch is within three standard errors of it."""
    rows, error = applications(spark, folder), 0.02
    estimate = quality.email_domain_estimate(rows, error).select(F.col("distinct_domains").alias("estimate"), "emails")
    off = F.abs(F.col("estimate") - F.col("distinct_domains"))
    return quality.email_domain_profile(rows).join(estimate, "emails").select(
        "emails", "distinct_domains", (off <= F.greatest(F.lit(1), 3 * error * F.col("distinct_domains"))).alias("within_bound")
    )


@_q.add(duck("""
    select layout, count(*) as applications,
      count(*) filter (try_cast(parts[1] as integer) > 12) as first_above_12,
      count(*) filter (try_cast(parts[2] as integer) > 12) as second_above_12
    from (
      select case when regexp_full_match(b, '\\d{4}-\\d{2}-\\d{2}') then 'yyyy-MM-dd'
          when regexp_full_match(b, '\\d{4}/\\d{2}/\\d{2}') then 'yyyy/MM/dd'
          when regexp_full_match(b, '\\d{2}/\\d{2}/\\d{4}') then 'MM/dd/yyyy'
          when regexp_full_match(b, '\\d{2}-\\d{2}-\\d{4}') then 'dd-MM-yyyy' else 'other' end as layout,
        regexp_split_to_array(b, '[-/]') as parts
      from (select trim(birthday) as b from applications where birthday is not null))
    group by layout""", "applications"))
def birthday_format_profile(spark: SparkSession, folder: str) -> DataFrame:
    return quality.birthday_layout_profile(applications(spark, folder))


# ---- Outputs against each other ---------------------------------------------------


# A tenth of the applicants hand in a second form with a mobile that is refused.
_OVERLAP = """
    with refused as (
      select first_name, last_name, email from rejected union all
      select first_name, last_name, email from checked where app_id % 10 = 0)
    select {keys}, a.n as accepted_rows, r.n as rejected_rows
    from (select {keys}, count(*) as n from accepted group by all) a
    join (select {keys}, count(*) as n from refused group by all) r using ({keys})"""


def _with_second_forms(spark: SparkSession, folder: str) -> DataFrame:
    forms = applications(spark, folder)
    return ap.validate(ap.clean(forms.union(forms.where("app_id % 10 = 0").withColumn("mobile", F.lit("1")).select(*forms.columns))))


@_q.add(duck(_OVERLAP.format(keys="first_name, last_name, email"), "checked", "accepted", "rejected"))
def output_overlap(spark: SparkSession, folder: str) -> DataFrame:
    return quality.shared_within(_with_second_forms(spark, folder), ["first_name", "last_name", "email"])


@_q.add(duck(_OVERLAP.format(keys="email"), "checked", "accepted", "rejected"))
def output_overlap_by_email(spark: SparkSession, folder: str) -> DataFrame:
    rows = _with_second_forms(spark, folder)
    return quality.shared_applicants(ap.successful(rows), ap.unsuccessful(rows), ["email"])


_IDENTITIES = {"email": "lower(trim(email))", "domain": "case when email like '%@%' then split_part(lower(trim(email)), '@', -1) end"}


def _batch_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """Sketches of addresses and domains, stored for each batch by its own run, per output."""
    root = scratch_path(spark, "sketches")
    values = {"email": F.lower(F.btrim("email", F.lit(rules.WHITESPACE))), "domain": fx.email_domain(F.col("email"))}
    for batch in _BATCHES:
        rows = validated(spark, folder).where(F.col("source_file") == batch)
        side = F.when(F.col("is_successful"), "accepted").otherwise("rejected")
        summaries.identity_sketches(rows.withColumn("side", side), ["source_file", "side"], values).write.parquet(f"{root}/run={batch}")
    return spark.read.parquet(root)


@_q.add(duck(f"""
    select count(*) as rows, count(email) as email_rows, count(distinct {_IDENTITIES['email']}) as emails,
      count({_IDENTITIES['domain']}) as domain_rows, count(distinct {_IDENTITIES['domain']}) as domains, true as within_bound
    from applications""", "applications"))
def distinct_from_batch_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """Exact numbers, and whether those merged from the sketches of all batches are within four standard errors."""
    merged = summaries.merged_identities(_batch_sketches(spark, folder), [], ["email", "domain"])
    exact = applications(spark, folder).select(
        F.lower(F.btrim("email", F.lit(rules.WHITESPACE))).alias("email"), fx.email_domain(F.col("email")).alias("domain")
    ).agg(F.count_distinct("email").alias("emails"), F.count_distinct("domain").alias("domains"))
    told = merged.select("rows", "email_rows", "domain_rows", *[F.hll_sketch_estimate(f"{v}_distinct").alias(f"est_{v}s") for v in ("email", "domain")])
    names = ("emails", "domains")
    near = [F.abs(F.col(f"est_{n}") - F.col(n)) <= 4 * summaries.distinct_error() * F.col(n) + 1 for n in names]
    return _one_row(told, exact).select("rows", "email_rows", "emails", "domain_rows", "domains", reduce(and_, near).alias("within_bound"))


def _one_row(*rows: DataFrame) -> DataFrame:
    """Single rows with different columns laid over each other."""
    laid = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return laid.agg(*[F.max(c).alias(c) for c in laid.columns])


@_q.add(duck(f"""
    with sides as (select distinct is_successful, {_IDENTITIES['domain']} as d from validated where {_IDENTITIES['domain']} is not null)
    select count(*) filter (is_successful) as accepted, count(*) filter (not is_successful) as rejected, count(distinct d) as either,
      count(*) - count(distinct d) as both, true as within_bound from sides""", "validated"))
def overlap_from_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """Domains met in both outputs, exact, and whether the theta sketches are within four errors of the union."""
    merged = summaries.merged_identities(_batch_sketches(spark, folder), ["side"], ["domain"])
    estimate = summaries.overlap_estimate(merged, "side", ["accepted", "rejected"], "domain")
    sides = validated(spark, folder).select("is_successful", fx.email_domain(F.col("email")).alias("d")).where("d is not null").distinct()
    exact = sides.agg(F.count_if("is_successful").alias("accepted"), F.count_if(~F.col("is_successful")).alias("rejected"),
                      F.count_distinct("d").alias("either")).withColumn("both", F.expr("accepted + rejected - either"))
    names = ("accepted", "rejected", "either", "both")
    told = estimate.select(*[F.col(n).alias(f"est_{n}") for n in names])
    near = [F.abs(F.col(f"est_{n}") - F.col(n)) <= 4 * summaries.distinct_error() * F.col("either") + 1 for n in names]
    return _one_row(exact, told).select(*names, reduce(and_, near).alias("within_bound"))


def _two_runs(spark: SparkSession, folder: str) -> tuple[sinks.Written, sinks.Written]:
    """Two written runs; before the second, the e-mails of one batch were lost."""
    out, rows = scratch_path(spark, "replay"), applications(spark, folder)
    lost = rows.withColumn("email", F.expr("case when source_file <> 'batch_1.csv' then email end"))
    first, second = (
        sinks.write_outputs(ap.validate(ap.clean(frame)), out, run_ts) for frame, run_ts in zip((rows, lost), _RUNS)
    )
    return first, second


def _replayed(spark: SparkSession, folder: str, side: str) -> DataFrame:
    root, found = scratch_path(spark, "kept-runs"), _two_runs(spark, folder)
    paths = [f"{root}/{run.run}" for run in found]
    for run, path in zip(found, paths):
        replay.keep_run(spark.read.parquet(run.folders[side]), path, buckets=64)
    return replay.kept_difference(spark, *paths)


_BALANCE = """
    select {columns}, case when sum(v) > 0 then 'first' else 'second' end as only_in, abs(sum(v))::bigint as copies
    from votes group by {columns} having sum(v) <> 0"""
_ACCEPTED = "membership_id, first_name, last_name, email, birthday, above_18, mobile"
_REJECTED = ("name, email, birthday_raw, mobile_raw, first_name, last_name, birthday, age, above_18, rejection_reason, "
             "source_file")


@_q.add(duck(f"""
    with votes as (
      select *, 1 as v from accepted union all select *, -1 from accepted where source_file <> 'batch_1.csv')
    {_BALANCE.format(columns=_ACCEPTED)}""", "accepted"))
def replay_diff(spark: SparkSession, folder: str) -> DataFrame:
    return _replayed(spark, folder, "successful")


@_q.add(duck(f"""
    with votes as (
      select {_REJECTED}, 1 as v from rejected
      union all select {_REJECTED}, -1 from rejected where source_file <> 'batch_1.csv'
      union all select name, null, birthday, mobile, first_name, last_name, birthday_ymd, age, above_18,
        concat_ws(';', case when f_name then 'missing_name' end, case when f_birthday then 'unparseable_birthday' end,
          case when f_age then 'under_18' end, case when f_mobile then 'invalid_mobile' end, 'invalid_email'),
        source_file, -1
      from checked where source_file = 'batch_1.csv')
    {_BALANCE.format(columns=_REJECTED)}""", "rejected"))
def replay_diff_rejected(spark: SparkSession, folder: str) -> DataFrame:
    return _replayed(spark, folder, "unsuccessful")


@_q.add(duck(_LATER + """
    select app_id, rejection_reason, 'first' as only_in, 1::bigint as copies
    from later where rejection_reason <> later_reason
    union all select app_id, later_reason, 'second', 1 from later where rejection_reason <> later_reason""", "validated"))
def replay_diff_later_reference(spark: SparkSession, folder: str) -> DataFrame:
    """Which verdicts another reference date changes."""
    first = validated(spark, folder).select("app_id", "rejection_reason")
    second = validated(spark, folder, date(2023, 1, 1)).select("app_id", "rejection_reason")
    return quality.replay_difference(first, second)


# ---- Member seed ------------------------------------------------------------------

_FIRST_50 = "(select * from accepted order by source_file, app_id limit 50)"
_SEEDED = f"""(select * from {_FIRST_50} f
      qualify row_number() over (partition by membership_id order by source_file, app_id) = 1)"""


@_q.add(duck(f"select * from {_FIRST_50} f", "accepted"))
def first_n_members(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.first_rows(accepted(spark, folder), rules.MEMBER_SEED_ROWS, _POSITION)


# The first 50 rows share no id; these many do.
_MORE = 400
_FIRST_MORE, _SEEDED_MORE = (t.replace("limit 50", f"limit {_MORE}") for t in (_FIRST_50, _SEEDED))


@_q.add(duck(f"select * from {_SEEDED_MORE} s", "accepted"))
def dedupe_first_members(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.seed_members(accepted(spark, folder), _POSITION, _MORE)


@_q.add(duck("""
    select * from accepted
    qualify row_number() over (partition by membership_id order by source_file, app_id) = 1""", "accepted"))
def dedupe_members(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.keep_first(accepted(spark, folder), ["membership_id"], _POSITION)


@_q.add(duck("""
    select * from accepted
    qualify row_number() over (partition by membership_id order by source_file, app_id) > 1""", "accepted"))
def dedupe_dropped_rows(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.dropped_duplicates(accepted(spark, folder), ["membership_id"], _POSITION)


@_q.add(duck(f"""
    with source as (select membership_id, row_number() over (order by source_file, app_id) as place from {_FIRST_MORE} f),
    loaded as (select membership_id, row_number() over (order by source_file, app_id) as place from {_SEEDED_MORE} s)
    select place, s.membership_id is not null as in_first, l.membership_id is not null as in_second
    from source s full join loaded l using (place)
    where s.membership_id is distinct from l.membership_id""", "accepted"))
def members_match_source(spark: SparkSession, folder: str) -> DataFrame:
    rows = accepted(spark, folder)
    # At most _MORE rows reach this window.
    place = F.row_number().over(Window.orderBy(*_POSITION)).cast("long").alias("place")
    source = sampling.first_rows(rows, _MORE, _POSITION).select(place, "membership_id")
    loaded = sampling.seed_members(rows, _POSITION, _MORE).select(place, "membership_id")
    return sampling.position_differences(source, loaded, "place")


@_q.add(duck("""
    select app_id, birthday_date, not above_18 as above_18 from checked
    where birthday_date is not null and app_id % 17 = 0""", "checked"))
def above_18_consistency(spark: SparkSession, folder: str) -> DataFrame:
    """With the flag of every 17th row turned round."""
    flag = F.when(F.col("app_id") % 17 == 0, ~F.col("above_18")).otherwise(F.col("above_18"))
    rows = cleaned(spark, folder).withColumn("above_18", flag)
    return rows.where(
        F.col("above_18") != (F.col("birthday_date") <= integrity.latest_adult_birthday())
    ).select("app_id", "birthday_date", "above_18")
