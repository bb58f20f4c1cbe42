"""CSV batches, run outputs, typed loads, whole runs."""

import random
from dataclasses import replace
from datetime import date, datetime

import pytest
from conftest import bag

from ledgerloom.operators import applications as ap, sampling
from ledgerloom.sources import batches, runs, sinks, tables

RUN_TS = datetime(2026, 9, 18, 10, 41, 59)
STAMP = "20260918_104159"

# Golden batches, fixed values: the published sample rows with their published verdicts.
BATCH_A = (
    "name,email,date_of_birth,mobile_no\n"
    "Mr. William Dixon,William_Dixon@provider.com,1986/01/10,4060 1711\n"
    "Kristen Horn,Kristen_Horn@lin.com,1974-09-10,737931\n"
    "Cathy Werner,Cathy_Werner@martinez.net,2018-09-25,71380411\n"
)
BATCH_B = (
    "name,email,date_of_birth,mobile_no\n"
    "Sherry Gonzalez DDS,Sherry_Gonzalez@caldwell.net,14-03-1973,66744895\n"
    ",Nobody_Here@jackson.com,1990-01-01,12345678\n"
)
BATCH_C = (
    "name,email,date_of_birth,mobile_no\n"
    "Mary Ball,Mary_Ball@stevens.biz,02/05/1968,88635912\n"
    "Lori Torres,Lori_Torres@hill.net,1996/02/31,57951752\n"
    "Kimberly Chang,Kimberly_Chang@johnson-lopez.biz,02/27/1974,2692047\n"
)


@pytest.fixture
def folder(tmp_path):
    """Writes batch files into an input folder and returns its path."""
    root = tmp_path / "in"
    root.mkdir()

    def write(**files):
        for name, text in files.items():
            (root / f"{name}.csv").write_text(text, encoding="utf-8")
        return str(root)

    return write


def _scan(spark, path, **kwargs):
    return batches.scan_batches(spark, batches.discover_batches(spark, path), **kwargs)


def test_batches_are_found_by_name(spark, folder, tmp_path):
    path = folder(b=BATCH_B, a=BATCH_A)
    (tmp_path / "in" / "note.txt").write_text("x")
    (tmp_path / "in" / "archive").mkdir()
    (tmp_path / "in" / "archive" / "old.csv").write_text(BATCH_A)
    assert [f.rsplit("/", 1)[-1] for f in batches.discover_batches(spark, path)] == ["a.csv", "b.csv"]


def test_empty_folder_is_no_error_and_a_missing_one_is(spark, folder, tmp_path):
    assert batches.discover_batches(spark, folder()) == []
    with pytest.raises(NotADirectoryError):
        batches.discover_batches(spark, str(tmp_path / "absent"))
    with pytest.raises(NotADirectoryError):
        batches.discover_batches(spark, folder(a=BATCH_A) + "/a.csv")
    with pytest.raises(ValueError):
        batches.scan_batches(spark, [])


def test_columns_are_found_by_name_in_each_file(spark, folder):
    path = folder(
        a="name,email,date_of_birth,mobile_no\nAnn,a@x.com,1990-01-01,11111111\n",
        b="mobile_no,date_of_birth,email,name\n22222222,1991-01-01,b@x.com,Bob\n",
        c="id,name,email,note,date_of_birth,mobile_no\n7,Cy,c@x.com,hi,1992-01-01,33333333\n",
    )
    frame = _scan(spark, path)
    assert frame.columns == ["name", "email", "birthday", "mobile", "source_file"]
    assert {t for _, t in frame.dtypes} == {"string"}
    assert bag(frame) == [
        ("Ann", "a@x.com", "1990-01-01", "11111111", "a.csv"),
        ("Bob", "b@x.com", "1991-01-01", "22222222", "b.csv"),
        ("Cy", "c@x.com", "1992-01-01", "33333333", "c.csv"),
    ]


def test_missing_columns_are_named(spark, folder):
    path = folder(a="name,email,birthday\nAnn,a@x.com,1990-01-01\n")
    with pytest.raises(batches.MissingColumns) as error:
        _scan(spark, path)
    assert "date_of_birth, mobile_no" in str(error.value) and "a.csv" in str(error.value)
    assert issubclass(batches.MissingColumns, ValueError)


QUOTED = (
    "name,email,date_of_birth,mobile_no\n"
    '"Lee, Ann",a@x.com,1990-01-01,11111111\n'
    '"Bob ""B"" Ray",b@x.com,1991-01-01,22222222\n'
    '"Cy\nDee",c@x.com,1992-01-01,33333333\n'
    " Eli ,,,\n"
)


def test_quoted_fields_and_empty_cells(spark, folder):
    rows = {r.name: r for r in _scan(spark, folder(a=QUOTED)).collect()}
    assert set(rows) == {"Lee, Ann", 'Bob "B" Ray', "Cy\nDee", " Eli "}
    assert (rows[" Eli "].email, rows[" Eli "].birthday, rows[" Eli "].mobile) == (None, None, None)


HEADER = "name,email,date_of_birth,mobile_no\n"
# Cases in which line-by-line reading would lose or tear a row, and one in which it does not.
SHAPES = {
    "plain": ("Ann,a@x.com,1990-01-01,11111111\r\nBob,b@x.com,1991-01-01,22222222\n", True, ["Ann", "Bob"]),
    "blank_row": ("Ann,a@x.com,,\n   \n   ,,,\nBob,,,\n", False, ["Ann", "   ", "   ", "Bob"]),
    "carriage_return": ("Bob\rHorn,b@x.com,1990-01-01,11111111\n", False, ["Bob\rHorn"]),
    "line_break": ('"Cy\nDee",c@x.com,1990-01-01,11111111\n', False, ["Cy\nDee"]),
    "empty_lines": ("\n\nAnn,,,\n\n", True, ["Ann"]),
    "mixed_ends": ('"Cy\nDee",c@x.com,,11111111\r\nBob,,,22222222\n', False, ["Cy\nDee", "Bob"]),
    "quotes": ('"Bob ""B"" Ray, Jr",b@x.com,,\n', True, ['Bob "B" Ray, Jr']),
}


@pytest.mark.parametrize("shape", list(SHAPES))
@pytest.mark.parametrize("lines_more", [0, 30_000])
def test_size_does_not_change_rows(spark, folder, shape, lines_more):
    body, whole, names = SHAPES[shape]
    more = "".join(f"More,m{i}@x.com,1990-01-01,{10000000 + i}\n" for i in range(lines_more))
    path = folder(a=HEADER + body + more)
    files = batches.discover_batches(spark, path)
    assert [w for _, _, w, _ in batches._layouts(spark, files)] == [whole]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        frame = batches.scan_batches(spark, files)
        blocks = batches.scan_batches(spark, files, positions=True).select("_block").distinct().count()
        assert (blocks > 4) == (lines_more > 0)  # whatever the file holds, it is read in splits
        rows = frame.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(r.name for r in rows if r.name != "More") == sorted(names)
    assert len({r.mobile for r in rows if r.name == "More"}) == lines_more
    assert not any("\\r" in (r.mobile or "") for r in rows)


def _cells(seed, returns):
    """A file with every kind of cell: breaks, doubled quotes, blanks, empty lines, returns inside."""
    pick = random.Random(seed)
    lines = [HEADER.strip()]
    for i in range(600):
        kind = pick.randrange(12)
        name = ['"a\nb%d"', '"x, ""q"" %d"', "   %.0s", "plain %d", '""%.0s', "%.0s", '"' + "\n" * pick.randrange(1, 90) + '%d"',
                "B\rC%d", '""""%.0s', '"l1\n""\n,\n""z%d"', "n%d", "m%d"][kind] % i
        lines.append(f'{name},"e{i}",{"" if kind == 3 else "1990"},m{i}')
        lines += {10: [""], 11: ["   "]}.get(kind, [])
    end = "\r\n" if returns else "\n"
    return end.join(lines) + end


def _multi_line(spark, path):
    """What one task reads, fields of the last column without the return of a mixed line end."""
    rows = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).csv(path)
    return [(*r[:3], (r[3] or "").removesuffix("\r") or None) for r in rows.collect()]


@pytest.mark.parametrize("returns", [False, True])
@pytest.mark.parametrize("split", ["700", "4000", "128m"])
def test_spanning_records_in_splits_equal_one_reader(spark, tmp_path, returns, split):
    path = tmp_path / "a.csv"
    path.write_text(_cells(3, returns), newline="")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        frame = batches.scan_batches(spark, [str(path)], positions=True)
        found = [tuple(r)[:4] for r in frame.orderBy(*batches.POSITION).collect()]
        assert (frame.select("_block").distinct().count() > 4) == (split != "128m")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert found == _multi_line(spark, str(path)) and len(found) > 600


def test_quotes_that_open_nothing_are_left_to_one_reader(spark, folder):
    """A quote inside an unquoted field, or text after a closed one: the quotes don't tell where records end."""
    odd = HEADER + 'Ann 5" pipe,a@x.com,1990-01-01,11111111\nBob,b@x.com,,22222222\n"Cy\nDee",c@x.com,,3\n'
    after = HEADER + '"Ann"x,a@x.com,1990-01-01,11111111\n"Cy\nDee",c@x.com,,3\n'
    fine = HEADER + '"Eve\nFox",e@x.com,,4\n'
    path = folder(a=odd, b=fine, c=after)
    assert bag(_scan(spark, path).drop("source_file")) == sorted(
        (r for f in "abc" for r in _multi_line(spark, f"{path}/{f}.csv")), key=repr)


@pytest.mark.parametrize("text", [HEADER, HEADER + "   ", HEADER + '"open\nto the end,a,b\nc', '\n\n"name",email,date_of_birth,mobile_no\n"x\ny",,,\n'])
def test_short_awkward_files(spark, folder, text):
    path = folder(a=text)
    assert bag(_scan(spark, path).drop("source_file")) == sorted(_multi_line(spark, f"{path}/a.csv"), key=repr)


@pytest.mark.parametrize("shape", ["empty_lines", "quotes"])
def test_both_readings_agree_where_lines_are_split(spark, folder, shape):
    path = folder(a=HEADER + SHAPES[shape][0])
    schema = "name string, email string, birthday string, mobile string"
    by_line, whole = (batches._csv(spark, m).schema(schema).csv(path + "/a.csv") for m in (False, True))
    assert bag(by_line) == bag(whole)


def test_plain_paths_and_odd_names(spark, folder, tmp_path):
    folder(**{"a b%20é": HEADER + "Ann,a@x.com,1990-01-01,11111111\n"})
    frame = batches.scan_batches(spark, [str(tmp_path / "in" / "a b%20é.csv")])
    assert [(r.name, r.mobile) for r in frame.collect()] == [("Ann", "11111111")]


def test_jobs_do_not_grow_with_the_files(spark, folder):
    counts = []
    for n in (40, 80):  # beyond 32 paths Spark lists them in a job
        path = folder(**{f"f{i}": HEADER + f"Ann,a{i}@x.com,1990-01-01,1111111{i % 10}\n" for i in range(n)})
        files = batches.discover_batches(spark, path)
        spark.sparkContext.setJobGroup(f"headers-{n}", "")
        assert batches.scan_batches(spark, files).count() == n
        counts.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"headers-{n}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts[0] == counts[1]


def test_headers_with_breaks_repeats_and_no_names(spark, folder):
    text = '"na\nme",x,x,,name,email,date_of_birth,mobile_no\n1,2,3,4,Ann,a@x.com,1990-01-01,11111111\n'
    assert [r.name for r in _scan(spark, folder(a=text)).collect()] == ["Ann"]


def test_positions_give_file_order(spark, folder):
    path = folder(b=BATCH_B, a=BATCH_A)
    frame = _scan(spark, path, positions=True).orderBy(*batches.POSITION)
    assert [r.name for r in frame.collect()] == [
        "Mr. William Dixon", "Kristen Horn", "Cathy Werner", "Sherry Gonzalez DDS", None
    ]


def test_run_on_two_batches(spark, folder, tmp_path):
    summary = runs.run(spark, folder(a=BATCH_A, b=BATCH_B), str(tmp_path / "out"), RUN_TS)
    assert (summary.files, *summary.rows.values()) == (2, 5, 2, 3)
    good = spark.read.parquet(summary.folders["successful"])
    assert tuple(good.columns) == ap.SUCCESSFUL_COLUMNS
    assert {(r.membership_id, r.mobile, r.above_18) for r in good.collect()} == {
        ("Dixon_3864b", "40601711", True), ("Gonzalez_" + _hash("19730314"), "66744895", True)
    }
    bad = spark.read.parquet(summary.folders["unsuccessful"])
    assert tuple(bad.columns) == ap.UNSUCCESSFUL_COLUMNS
    assert {(r.name, r.rejection_reason, r.source_file) for r in bad.collect()} == {
        ("Kristen Horn", "invalid_mobile", "a.csv"), ("Cathy Werner", "under_18", "a.csv"),
        (None, "missing_name", "b.csv"),
    }


def _hash(text):
    import hashlib

    return hashlib.sha256(text.encode()).hexdigest()[:5]


def test_run_on_three_batches_meets_every_reason(spark, folder, tmp_path):
    summary = runs.run(spark, folder(a=BATCH_A, b=BATCH_B, c=BATCH_C), str(tmp_path / "out"), RUN_TS)
    assert tuple(summary.rows.values()) == (8, 2, 6)
    reasons = {r.rejection_reason for r in spark.read.parquet(summary.folders["unsuccessful"]).collect()}
    assert reasons == {"invalid_mobile", "under_18", "missing_name", "invalid_email", "unparseable_birthday",
                       "invalid_mobile;invalid_email"}


def test_idle_run_writes_nothing(spark, folder, tmp_path):
    summary = runs.run(spark, folder(), str(tmp_path / "out"), RUN_TS)
    assert (summary.files, summary.rows["read"], summary.folders) == (0, 0, {})
    assert not (tmp_path / "out").exists()
    with pytest.raises(NotADirectoryError):
        runs.run(spark, str(tmp_path / "absent"), str(tmp_path / "out"), RUN_TS)


def test_repeating_a_run_replaces_its_output(spark, folder, tmp_path):
    path, out, ledger = folder(a=BATCH_A), str(tmp_path / "out"), str(tmp_path / "ledger")
    first = runs.run(spark, path, out, RUN_TS, ledger=ledger)
    before = bag(spark.read.parquet(first.folders["successful"]))
    second = runs.run(spark, path, out, RUN_TS, ledger=ledger)
    assert second == first and bag(spark.read.parquet(second.folders["successful"])) == before


def test_finished_files_are_left_out_of_later_runs(spark, folder, tmp_path):
    out, ledger = str(tmp_path / "out"), str(tmp_path / "ledger")
    later = RUN_TS.replace(hour=11)
    assert runs.run(spark, folder(a=BATCH_A), out, RUN_TS, ledger=ledger).files == 1
    assert runs.run(spark, folder(), out, later, ledger=ledger).files == 0
    summary = runs.run(spark, folder(b=BATCH_B), out, later, ledger=ledger)
    assert (summary.files, summary.rows["read"]) == (1, 2)


def test_failed_run_leaves_its_files_for_the_next(spark, folder, tmp_path):
    path, ledger = folder(a="name,email\nAnn,a@x.com\n"), str(tmp_path / "ledger")
    with pytest.raises(batches.MissingColumns):
        runs.run(spark, path, str(tmp_path / "out"), RUN_TS, ledger=ledger)
    path = folder(a=BATCH_A)
    assert runs.run(spark, path, str(tmp_path / "out"), RUN_TS.replace(hour=11), ledger=ledger).files == 1


def test_reference_date_reaches_the_run(spark, folder, tmp_path):
    text = "name,email,date_of_birth,mobile_no\nAnn Lee,a@x.com,2003-06-15,11111111\n"
    path = folder(a=text)
    assert runs.run(spark, path, str(tmp_path / "o1"), RUN_TS).rows["successful"] == 0
    assert runs.run(spark, path, str(tmp_path / "o2"), RUN_TS, reference=date(2030, 1, 1)).rows["successful"] == 1


def test_csv_output_keeps_spaces_and_tells_empty_from_null(spark, folder, tmp_path):
    text = "name,email,date_of_birth,mobile_no\nCher, c@x.com ,1990-01-01,11111111\n,,,\n"
    summary = runs.run(spark, folder(a=text), str(tmp_path / "out"), RUN_TS, fmt="csv")
    parts = [p.read_text() for p in (tmp_path / "out" / "successful" / f"run_ts={STAMP}").glob("*.csv")]
    line = [l for p in parts for l in p.splitlines() if l.startswith("_")][0]
    assert line == f'_{_hash("19900101")},Cher,"", c@x.com ,19900101,true,11111111'
    back = spark.read.option("header", True).csv(summary.folders["unsuccessful"]).first()
    assert (back.name, back.first_name, back.last_name) == (None, None, None)
    with pytest.raises(ValueError):
        sinks.write_frame(spark.range(1), str(tmp_path / "x"), "avro")


def test_rescanning_instead_of_keeping_gives_the_same_outputs(spark, folder, tmp_path):
    frame = ap.validate(ap.clean(_scan(spark, folder(a=BATCH_A, b=BATCH_B))))
    kept = sinks.write_outputs(frame, str(tmp_path / "kept"), RUN_TS)
    again = sinks.write_outputs(frame, str(tmp_path / "again"), RUN_TS, keep=None)
    assert replace(kept, folders={}) == replace(again, folders={})
    for name in kept.folders:
        assert bag(spark.read.parquet(kept.folders[name])) == bag(spark.read.parquet(again.folders[name]))


def test_empty_frame_is_counted_without_keeping_it(spark, tmp_path):
    frame = ap.validate(ap.clean(spark.createDataFrame([], "name string, email string, birthday string, mobile string, source_file string")))
    summary = sinks.write_outputs(frame, str(tmp_path / "out"), RUN_TS, keep=None, order_by=["name"])
    assert tuple(summary.rows.values()) == (0, 0, 0)


def test_finished_runs_are_recorded(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    runs.run(spark, folder(a=BATCH_A, b=BATCH_B), out, RUN_TS)
    assert [tuple(r) for r in sinks.read_records(spark, out).collect()] == [(2, 5, 2, 3, STAMP)]


def test_a_run_without_record_is_not_the_newest(spark, folder, tmp_path):
    out = tmp_path / "out"
    runs.run(spark, folder(a=BATCH_A), str(out), RUN_TS)
    later = sinks.write_outputs(ap.validate(ap.clean(_scan(spark, folder(b=BATCH_B)))), str(out), RUN_TS.replace(year=2030))
    assert tables.latest_run(spark, str(out)).first().run_ts == later.run.split("=")[1]
    (out / "runs" / later.run).rename(tmp_path / "lost")
    assert tables.latest_run(spark, str(out)).first().run_ts == STAMP


def test_latest_run_goes_by_stamp(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    runs.run(spark, folder(b=BATCH_B), out, RUN_TS)
    runs.run(spark, folder(a=BATCH_A), out, RUN_TS.replace(year=2025))
    latest = tables.latest_run(spark, out)
    assert [(r.run_ts, r.first_name) for r in latest.collect()] == [(STAMP, "Sherry")]
    assert all(STAMP in file for file in latest.inputFiles())
    with pytest.raises(FileNotFoundError):
        tables.latest_run(spark, str(tmp_path / "absent"))


def test_latest_run_of_csv_outputs_loads_as_members(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    runs.run(spark, folder(a=BATCH_A, b=BATCH_B), out, RUN_TS, fmt="csv")
    members = tables.typed_members(tables.latest_run(spark, out, fmt="csv"))
    assert sorted((r.membership_id, r.birthday, r.above_18, r.mobile) for r in members.collect()) == [
        ("Dixon_3864b", date(1986, 1, 10), True, "40601711"),
        ("Gonzalez_" + _hash("19730314"), date(1973, 3, 14), True, "66744895"),
    ]


@pytest.mark.parametrize("in_order", [False, True])
@pytest.mark.parametrize("text, rows", [
    ("name,email,date_of_birth,mobile_no\n", 0),
    ("name,email,date_of_birth,mobile_no\n,,,\n", 1),
])
def test_run_without_accepted_rows(spark, folder, tmp_path, text, rows, in_order):
    summary = runs.run(spark, folder(a=text), str(tmp_path / "out"), RUN_TS, in_order=in_order)
    assert (summary.files, *summary.rows.values()) == (1, rows, 0, rows)
    assert tables.latest_run(spark, str(tmp_path / "out")).count() == 0


def test_byte_order_mark_and_windows_line_ends(spark, folder):
    text = "\ufeff" + BATCH_A.replace("\n", "\r\n")
    rows = _scan(spark, folder(a=text)).collect()
    assert [r.mobile for r in rows] == ["4060 1711", "737931", "71380411"]
    assert rows[0].name == "Mr. William Dixon"


def test_seed_from_the_newest_run_in_input_order(spark, folder, tmp_path):
    people = [f"P{i:03d} Q{i % 90:02d}" for i in range(200)]
    header = "name,email,date_of_birth,mobile_no\n"
    first = header + "".join(f"{p},{p[:4]}@x.com,1990-01-01,11111111\n" for p in people[:120])
    second = header + "".join(f"{p},{p[:4]}@x.com,1990-01-01,11111111\n" for p in people[120:])
    out = str(tmp_path / "out")
    summary = runs.run(spark, folder(b=second, a=first), out, RUN_TS, in_order=True)
    rows, place = tables.read_in_order(spark, summary.folders["successful"])
    assert [r.first_name for r in rows.orderBy(*place).collect()] == [p[:4] for p in people]
    seeded = sampling.seed_members(rows, place, 100)
    members = tables.typed_members(seeded)
    assert members.count() == 90
    assert dict(members.dtypes)["birthday"] == "date" and dict(members.dtypes)["above_18"] == "boolean"


@pytest.mark.parametrize("field, value", [
    ("birthday", "19900231"), ("birthday", "1990-01-01"), ("birthday", None), ("above_18", "yes"), ("above_18", None),
])
def test_typed_load_is_strict(spark, field, value):
    row = {"membership_id": "a", "first_name": "A", "last_name": "B", "email": "e", "birthday": "19900101",
           "above_18": " TRUE ", "mobile": "00000001"}
    schema = ", ".join(f"{c} string" for c in row)
    good = tables.typed_members(spark.createDataFrame([tuple(row.values())], schema)).first()
    assert (good.birthday, good.above_18, good.mobile) == (date(1990, 1, 1), True, "00000001")
    bad = spark.createDataFrame([tuple({**row, field: value}.values())], schema)
    with pytest.raises(Exception, match=f"bad {field}"):
        tables.typed_members(bad).collect()


def test_days_are_written_apart_replaced_alone_and_pruned(spark, tmp_path):
    root = str(tmp_path / "days")
    frame = spark.range(300).selectExpr("id", "date_add(date'2024-01-01', cast(id % 3 as int)) as dt")
    tables.write_by_day(frame, root)
    tables.write_by_day(frame.where("dt = date'2024-01-02' and id < 10"), root)
    assert {(str(r.dt), r["count"]) for r in spark.read.parquet(root).groupBy("dt").count().collect()} == {
        ("2024-01-01", 100), ("2024-01-02", 3), ("2024-01-03", 100)
    }
    recent = tables.read_days(spark, root, "2024-01-02", "2024-01-02")
    assert recent.count() == 3
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert len(list((tmp_path / "days" / "dt=2024-01-01").glob("*.parquet"))) == 1
