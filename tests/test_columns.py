"""Names, birthdays, ages, contact fields and ids."""

import hashlib
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerloom import functions as fx, rules

NAMES = [
    # plain, titled, tailed, both
    ("Rosa Marsh", "Rosa", "Marsh"),
    ("Mr. Rosa Marsh", "Rosa", "Marsh"),
    ("mr Rosa Marsh", "Rosa", "Marsh"),
    ("MADAM. Rosa Marsh", "Rosa", "Marsh"),
    ("Mrs Rosa Marsh", "Rosa", "Marsh"),
    ("Rosa Marsh DDS", "Rosa", "Marsh"),
    ("Rosa Marsh phd.", "Rosa", "Marsh"),
    ("Rosa Marsh III", "Rosa", "Marsh"),
    ("Dr. Rosa Marsh Jr.", "Rosa", "Marsh"),
    # further tokens stay with the last name
    ("Rosa Jane Marsh", "Rosa", "Jane Marsh"),
    ("Prof. Dr. Rosa Marsh", "Dr.", "Rosa Marsh"),
    ("Rosa Marsh MD PhD", "Rosa", "Marsh MD"),
    # one token
    ("Rosa", "Rosa", ""),
    ("MD", "MD", ""),
    ("Mr. Rosa", "Rosa", ""),
    ("Rosa MD", "Rosa", ""),
    # whitespace of any kind
    ("  Rosa   Marsh ", "Rosa", "Marsh"),
    ("\tRosa\t\tJane \n Marsh\t", "Rosa", "Jane Marsh"),
    ("Rosa Marsh MD", "Rosa", "Marsh"),
    # words that only start like a title or suffix
    ("Mravko Vine", "Mravko", "Vine"),
    ("Drew Dove", "Drew", "Dove"),
    # nothing usable
    (None, None, None),
    ("", None, None),
    ("   ", None, None),
    ("\t", None, None),
    ("Mr.", None, None),
    ("Dr", None, None),
    ("Mr. MD", None, None),
]


def test_names_split_into_first_and_last(cleaned):
    rows = cleaned(*[{"name": n} for n, _, _ in NAMES])
    assert [(r["name"], r["first_name"], r["last_name"]) for r in rows] == NAMES


def test_tokens_of_null_and_blank_names(spark):
    frame = spark.createDataFrame([(None,), (" \t",), (" a  b ",)], "name string")
    tokens = [r[0] for r in frame.select(fx.name_tokens(F.col("name"))).collect()]
    assert tokens == [None, [], ["a", "b"]]


def test_core_tokens(spark):
    frame = spark.createDataFrame([("Mr. A B C MD",), ("Mr.",), (None,)], "name string")
    core = fx.core_tokens(fx.core_name(F.col("name")))
    assert [r[0] for r in frame.select(core).collect()] == [["A", "B", "C"], [], None]


BIRTHDAYS = [
    ("2000/12/31", date(2000, 12, 31)),
    ("1961-07-04", date(1961, 7, 4)),
    ("10/30/1958", date(1958, 10, 30)),
    ("30-10-1958", date(1958, 10, 30)),
    # the separator decides between month first and day first
    ("03/04/2001", date(2001, 3, 4)),
    ("03-04-2001", date(2001, 4, 3)),
    ("  1961/07/04", date(1961, 7, 4)),
    ("1961-07-04\r\n", date(1961, 7, 4)),
    ("2000-02-29", date(2000, 2, 29)),
    ("1900-02-29", None),
    ("30-02-1977", None),
    ("1977/00/12", None),
    ("31/12/1977", None),
    ("1977/1/12", None),
    ("12071977", None),
    ("07/04-1961", None),
    ("-1961-07-04", None),
    ("1961-07-04 08:00", None),
    ("July 4, 1961", None),
    ("", None),
    (None, None),
]


def test_birthdays_parse_in_each_layout(cleaned):
    rows = cleaned(*[{"birthday": b} for b, _ in BIRTHDAYS])
    assert [(r["birthday"], r["birthday_date"]) for r in rows] == BIRTHDAYS
    for row in rows:
        known = row["birthday_date"] is not None
        assert row["birthday_ymd"] == (row["birthday_date"].strftime("%Y%m%d") if known else None)
        assert (row["age"] is None) == (not known)
        assert (row["above_18"] is None) == (not known)


def test_layouts_are_an_argument(spark):
    frame = spark.createDataFrame([("2001-02-03",), ("03.02.2001",)], "b string")
    only_dots = frame.select(fx.parse_birthday(F.col("b"), ["dd.MM.yyyy"]))
    assert [r[0] for r in only_dots.collect()] == [None, date(2001, 2, 3)]


def test_layouts_of_one_shape_are_tried_in_order(spark):
    frame = spark.createDataFrame([("02/27/1974",), ("27/02/1974",), ("03/02/1974",)], "b string")
    both = frame.select(fx.parse_birthday(F.col("b"), ["MM/dd/yyyy", "dd/MM/yyyy"]))
    assert [r[0] for r in both.collect()] == [date(1974, 2, 27), date(1974, 2, 27), date(1974, 3, 2)]


# Fixed by the rule: more than 18 whole years on 2022-01-01.
AGES = [
    ("2003-01-01", 19, True),
    ("2002-12-31", 19, True),
    ("2003-01-02", 18, False),
    ("2003-12-31", 18, False),
    ("2004-01-01", 18, False),
    ("2004-01-02", 17, False),
    ("2004-02-29", 17, False),
    ("2022-01-01", 0, False),
    ("2022-01-02", -1, False),
    ("1900-01-01", 122, True),
]


def test_age_at_the_boundaries(cleaned):
    rows = cleaned(*[{"birthday": b} for b, _, _ in AGES])
    assert [(r["birthday"], r["age"], r["above_18"]) for r in rows] == AGES


@pytest.mark.parametrize("reference, age", [
    (date(2022, 2, 28), 17), (date(2022, 3, 1), 18), (date(2024, 2, 28), 19), (date(2024, 2, 29), 20),
])
def test_leap_day_birthday(cleaned, reference, age):
    assert cleaned({"birthday": "2004-02-29"}, reference=reference)[0]["age"] == age


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.dates(date(1900, 1, 1), date(2030, 12, 31)), min_size=1, max_size=60),
    st.dates(date(1990, 1, 1), date(2030, 12, 31)),
)
def test_age_equals_the_calendar_rule(cleaned, days, reference):
    rows = cleaned(*[{"birthday": d.isoformat()} for d in days], reference=reference)
    for day, row in zip(days, rows):
        due = (reference.month, reference.day) < (day.month, day.day)
        assert row["age"] == reference.year - day.year - due


MOBILES = [
    ("98765432", "98765432", True),
    ("9876 5432", "98765432", True),
    ("9 8 7 6 5 4 3 2", "98765432", True),
    ("\n98\t765432 ", "98765432", True),
    ("11111111", "11111111", True),
    ("987654", "987654", False),
    ("0987654321", "0987654321", False),
    ("+98765432", "+98765432", False),
    ("9876.5432", "9876.5432", False),
    ("९८७६५४३२", "९८७६५४३२", False),
    ("   ", "", False),
    (None, None, False),
]


def test_mobile_normalised_and_checked(validated):
    rows = validated(*[{"mobile": m} for m, _, _ in MOBILES])
    got = [(r["mobile"], r["mobile_normalised"], "invalid_mobile" not in r["rejection_reason"]) for r in rows]
    assert got == MOBILES


EMAILS = [
    ("ann@example.com", True), ("ann@example.net", True), ("ANN@EXAMPLE.COM", True),
    ("  ann@example.net\t", True), ("ann@example.org", False), ("ann@example.net.org", False),
    ("ann@example.com.sg", False), ("anncom", False), ("", False), (None, False),
]


def test_email_suffixes(validated):
    rows = validated(*[{"email": e} for e, _ in EMAILS])
    assert [(r["email"], "invalid_email" not in r["rejection_reason"]) for r in rows] == EMAILS


def test_strict_email_suffixes(spark):
    frame = spark.createDataFrame([("a@emailprovider.com",), ("a@EmailProvider.NET",), ("a@x.com",)], "e string")
    strict = fx.has_suffix(F.col("e"), rules.EMAIL_SUFFIXES_STRICT)
    assert [r[0] for r in frame.select(strict).collect()] == [True, True, False]


def test_email_domain(spark):
    frame = spark.createDataFrame([("a@X.com ",), ("a@b@y.net",), ("none",), (None,)], "e string")
    assert [r[0] for r in frame.select(fx.email_domain(F.col("e"))).collect()] == ["x.com", "y.net", None, None]


def test_membership_id_uses_the_hash_of_the_birthday(validated):
    full = {"email": "w@p.com", "mobile": "40601711", "birthday": "1986/01/10"}
    rows = validated({**full, "name": "Mr. William Dixon"}, {**full, "name": "Cher"}, {**full, "name": "Mr."})
    digest = hashlib.sha256(b"19860110").hexdigest()
    assert digest[:5] == "3864b"
    assert [r["membership_id"] for r in rows] == ["Dixon_3864b", "_3864b", None]


def test_run_stamp(spark):
    frame = spark.createDataFrame(
        [("successful_applications_20260918_104159.csv",), ("plain.csv",), ("x_20269918_104159.csv",)], "f string"
    )
    got = [r[0] for r in frame.select(fx.run_stamp_of(F.col("f"))).collect()]
    assert [g.isoformat() if g else None for g in got] == ["2026-09-18T10:41:59", None, None]


def _brute_force(name):
    """First and last name by walking over the tokens."""
    tokens = name.split()
    bare = [t.lower().rstrip(".") for t in tokens]
    start = 1 if tokens and bare[0] in rules.SALUTATIONS else 0
    stop = len(tokens) - (1 if len(tokens) > 1 and bare[-1] in rules.POST_NOMINALS else 0)
    core = tokens[start:max(start, stop)]
    return (core[0], " ".join(core[1:])) if core else (None, None)


def test_random_names_split_like_the_token_walk(spark):
    import random

    rng = random.Random(11)
    words = ["Mr", "mr.", "MRS..", "Dr", "Prof.", "Madam", "Sir", "Mrx", "Xmr", "Ann", "Lee", "O'Hara", "É.", "李",
             "MD", "md.", "Jr..", "III", "v", "V.", "Do", "PhD", "PhDs", "a.b", ".", "..", "Esq,"]
    gaps = [" ", "  ", "\t", " \n ", " ", " ", "　"]
    names = []
    for _ in range(4000):
        parts = [rng.choice(words) for _ in range(rng.randrange(0, 6))]
        text = "".join(p + rng.choice(gaps) for p in parts)
        names.append(rng.choice(["", " ", "\t"]) + (text if rng.random() < 0.5 else text.rstrip()))
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    core = fx.core_name(F.col("name"))
    rows = frame.select("name", fx.first_name(core).alias("f"), fx.last_name(core).alias("l")).collect()
    wrong = [(r.name, r.f, r.l, _brute_force(r.name)) for r in rows if (r.f, r.l) != _brute_force(r.name)]
    assert wrong == []


def test_random_birthdays_parse_like_strptime_on_exact_shapes(spark):
    import random
    import re
    from datetime import datetime

    shapes = {r"\d{4}-\d\d-\d\d": "%Y-%m-%d", r"\d{4}/\d\d/\d\d": "%Y/%m/%d",
              r"\d\d/\d\d/\d{4}": "%m/%d/%Y", r"\d\d-\d\d-\d{4}": "%d-%m-%Y"}

    def expected(text):
        for shape, layout in shapes.items():
            if re.fullmatch(shape, text.strip()):
                try:
                    return datetime.strptime(text.strip(), layout).date()
                except ValueError:
                    return None
        return None

    rng = random.Random(4)
    texts = ["--", "-", "1986-01-10-", "--1986-01-10", "1986-01-10 1986-01-10"]
    for _ in range(4000):
        parts = [f"{rng.randrange(1900, 2030)}", f"{rng.randrange(0, 14):02d}", f"{rng.randrange(0, 33):02d}"]
        if rng.random() < 0.5:
            rng.shuffle(parts)
        gap = rng.choice("--//.")
        text = gap.join(parts)
        if rng.random() < 0.1:
            text = text.replace("0", "", 1)
        texts.append(rng.choice(["", " ", "\n"]) + text + rng.choice(["", "\t", "x", " "]))
    rows = spark.createDataFrame([(t,) for t in texts], "b string").select(
        "b", fx.parse_birthday(F.col("b")).alias("d")).collect()
    assert [(r.b, r.d) for r in rows if r.d != expected(r.b)] == []
    assert sum(r.d is not None for r in rows) > 500
