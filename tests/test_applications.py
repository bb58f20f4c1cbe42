"""Verdicts, reasons, the two outputs and their profiles."""

from datetime import date

from conftest import SF, VALID, bag
from pyspark.sql import functions as F

from ledgerloom.operators import applications as ap, quality
from ledgerloom.plans import views


def test_each_rule_reports_its_own_code(validated):
    cases = [
        ({}, ""),
        ({"name": ""}, "missing_name"),
        ({"birthday": "1996/02/31"}, "unparseable_birthday"),
        ({"birthday": "2010-07-12"}, "under_18"),
        ({"mobile": "737931"}, "invalid_mobile"),
        ({"email": "ann@example.biz"}, "invalid_email"),
        ({"birthday": "2010-07-12", "mobile": "1", "email": "x"}, "under_18;invalid_mobile;invalid_email"),
        ({"birthday": "1996/02/31", "mobile": "1"}, "unparseable_birthday;invalid_mobile"),
    ]
    rows = validated(*[{**VALID, **change} for change, _ in cases])
    assert [r["rejection_reason"] for r in rows] == [reason for _, reason in cases]
    assert [r["is_successful"] for r in rows] == [reason == "" for _, reason in cases]
    assert all((r["membership_id"] is not None) == r["is_successful"] for r in rows)


def test_all_null_row_gets_a_verdict(validated):
    row = validated({})[0]
    assert row["is_successful"] is False
    assert row["rejection_reason"] == "missing_name;unparseable_birthday;invalid_mobile;invalid_email"


def test_no_rule_is_ever_null(applications):
    matrix = ap.rule_matrix(ap.clean(applications({})), ap.application_rules())
    assert None not in matrix.first().asDict().values()


def test_reasons_follow_the_rule_list(spark, applications):
    codes = [r.code for r in ap.application_rules()]
    assert codes == ["missing_name", "unparseable_birthday", "under_18", "invalid_mobile", "invalid_email"]
    extra = ap.Rule("short_name", F.length("first_name") > 3)
    frame = ap.validate(ap.clean(applications(VALID, {})), [*ap.application_rules(), extra])
    assert [r.rejection_reason.split(";")[-1] for r in frame.collect()] == ["short_name", "short_name"]


def test_submitted_columns_survive(cleaned):
    row = cleaned({**VALID, "name": " Mr. Ann Lee", "birthday": " 14-03-1973", "mobile": "6655 1251"})[0]
    assert (row["name"], row["birthday"], row["mobile"]) == (" Mr. Ann Lee", " 14-03-1973", "6655 1251")
    assert (row["birthday_ymd"], row["mobile_normalised"]) == ("19730314", "66551251")


def test_outputs_have_fixed_columns_and_hold_every_row_once(spark):
    rows = ap.validate(ap.clean(views.applications(spark, SF)))
    good, bad = ap.successful(rows), ap.unsuccessful(rows)
    assert tuple(good.columns) == ap.SUCCESSFUL_COLUMNS
    assert tuple(bad.columns) == ap.UNSUCCESSFUL_COLUMNS
    assert good.count() + bad.count() == rows.count() == 150
    assert good.count() > 0 and bad.count() > 0


def test_recheck_finds_a_tampered_reason(spark):
    audit = ap.unsuccessful(ap.validate(ap.clean(views.applications(spark, SF))))
    assert ap.recheck_rejections(audit).count() == 0
    forged = audit.withColumn(
        "rejection_reason", F.when(F.col("rejection_reason") == "invalid_email", "under_18")
        .otherwise(F.col("rejection_reason"))
    )
    expected = audit.where("rejection_reason = 'invalid_email'").count()
    assert ap.recheck_rejections(forged).count() == expected > 0


def test_cleaning_and_validating_run_no_job(spark, applications):
    frame = applications(VALID)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "no job expected")
    try:
        ap.validate(ap.clean(frame))
        assert list(tracker.getJobIdsForGroup("lazy")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_profiles_on_a_known_batch(spark, applications):
    rows = [VALID, VALID, {**VALID, "mobile": "1"}, {**VALID, "mobile": "1"},
            {**VALID, "mobile": "1", "email": "x@y.org"}, {**VALID, "name": None, "source_file": "b.csv"}]
    frame = ap.validate(ap.clean(applications(*rows)))
    assert bag(quality.rejection_histogram(frame)) == [
        ("invalid_mobile", 2, 0.5), ("invalid_mobile;invalid_email", 1, 0.25), ("missing_name", 1, 0.25)
    ]
    assert dict(bag(quality.rejections_by_rule(frame, ap.application_rules()))) == {
        "missing_name": 1, "unparseable_birthday": 0, "under_18": 0, "invalid_mobile": 3, "invalid_email": 1
    }
    assert bag(quality.rejections_by_file(frame)) == [("a.csv", 5, 3), ("b.csv", 1, 1)]
    assert bag(quality.run_counts(frame)) == [(6, 2, 4, True)]
    good = ap.successful(frame)
    assert bag(quality.id_uniqueness(good)) == [(2, 1, 1)]
    assert bag(quality.id_collisions(good)) == [("Lee_3864b", 2)]
    assert quality.collision_rows(good).count() == 2
    assert bag(quality.email_domain_profile(frame)) == [(6, 2)]
    assert bag(quality.email_domain_estimate(frame)) == [(6, 2)]


def test_profiles_of_an_empty_batch(spark, applications):
    frame = ap.validate(ap.clean(applications().limit(0)))
    assert bag(quality.rejection_histogram(frame)) == []
    assert bag(quality.run_counts(frame)) == [(0, 0, 0, True)]
    assert bag(quality.id_uniqueness(ap.successful(frame))) == [(0, 0, 0)]
    assert bag(quality.email_domain_profile(frame)) == [(0, 0)]


def test_birthday_layouts_and_their_evidence(applications):
    texts = ["1986/01/10", "1986/01/20", "02/27/1974", "02/03/1974", "14-03-1973", "1974-09-10", "junk", None]
    frame = applications(*[{"birthday": t} for t in texts])
    assert bag(quality.birthday_layout_profile(frame)) == [
        ("MM/dd/yyyy", 2, 0, 1), ("dd-MM-yyyy", 1, 1, 0), ("other", 1, 0, 0),
        ("yyyy-MM-dd", 1, 1, 0), ("yyyy/MM/dd", 2, 2, 0),
    ]


def test_same_applicants_on_both_sides_are_found_null_safe(spark):
    schema = "first_name string, email string"
    good = spark.createDataFrame([("A", "x"), ("A", "x"), (None, None), ("B", "y")], schema)
    bad = spark.createDataFrame([("A", "x"), (None, None), (None, None), ("C", "z")], schema)
    assert bag(quality.shared_applicants(good, bad, ["first_name", "email"])) == [
        ("A", "x", 2, 1), (None, None, 1, 2)
    ]


def test_replay_difference_counts_copies(spark):
    first = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, v string")
    second = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, v string")
    assert bag(quality.replay_difference(first, first)) == []
    assert bag(quality.replay_difference(first, second)) == [(1, "a", "first", 1), (3, "c", "second", 1)]


def test_reference_date_changes_the_verdict(applications):
    frame = applications({**VALID, "birthday": "2003-06-15"})
    for reference, reason in [(date(2022, 1, 1), "under_18"), (date(2023, 1, 1), ""), (date(2022, 6, 15), "")]:
        got = ap.validate(ap.clean(frame, reference)).first()["rejection_reason"]
        assert got == reason


def test_a_filter_after_validation_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "forms")
    columns = "name string, email string, birthday string, mobile string, source_file string"
    spark.createDataFrame([("Ann Lee", "a@x.com", "1990-01-01", "11111111", "f")], columns).write.parquet(path)
    checked = ap.validate(ap.clean(spark.read.parquet(path)))
    plan = checked.where("mobile = '11111111'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(mobile,11111111)" in plan
    split = ap.successful(checked)._jdf.queryExecution().executedPlan().toString()
    assert split.count("sha2(") == 1 and "CollectMetrics" in split
