"""The given tables in the shape of the onboarding, sales and image tables.

Each view is a list of SQL expressions that Spark and DuckDB read alike, so that
both sides of a check start from the same rows.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# ---- Applications, one per customer -------------------------------------------

_APPLICANT = (
    "c_custkey",
    "cast(1950 + (c_custkey * 7) % 60 as string) as y",
    "lpad(cast(1 + c_custkey % 12 as string), 2, '0') as m",
    "lpad(cast(1 + (c_custkey * 5) % 28 as string), 2, '0') as d",
    "cast(10000000 + (c_custkey * 7919) % 90000000 as string) as p",
)

_APPLICATION = (
    "c_custkey as app_id",
    """case when c_custkey % 41 = 0 then null when c_custkey % 43 = 0 then 'Mr.' when c_custkey % 47 = 0 then '   '
       else concat(
         case c_custkey % 6 when 0 then 'Mr. ' when 1 then 'DR ' when 2 then '  ' else '' end,
         case c_custkey % 7 when 0 then 'Ann' when 1 then 'Bob' when 2 then 'Cy' when 3 then 'Dee'
           when 4 then 'Eli' when 5 then 'Fay' else 'Gus' end,
         case when c_custkey % 37 = 0 then '' else concat(
           case when c_custkey % 9 = 0 then ' Lou' else '' end, ' ',
           case c_custkey % 11 when 0 then 'Lee' when 1 then 'Horn' when 2 then 'Dixon' when 3 then 'Werner'
             when 4 then 'Ball' else 'Torres' end) end,
         case c_custkey % 5 when 0 then ' MD' when 1 then ' Jr.' else '' end) end as name""",
    """case when c_custkey % 53 = 0 then null else concat('u', cast(c_custkey as string),
         case c_custkey % 8 when 0 then '@X.COM' when 1 then '@x.net ' when 2 then '@x.org'
           when 3 then '@x.com.sg' when 4 then '@x.biz' else '@x.com' end) end as email""",
    """case when c_custkey % 59 = 0 then '1996/02/31' when c_custkey % 61 = 0 then null
         when c_custkey % 67 = 0 then '2004-02-29' when c_custkey % 73 = 0 then '2003-01-01'
         when c_custkey % 79 = 0 then '2003-01-02'
         when c_custkey % 4 = 0 then concat(y, '-', m, '-', d) when c_custkey % 4 = 1 then concat(y, '/', m, '/', d)
         when c_custkey % 4 = 2 then concat(m, '/', d, '/', y) else concat(d, '-', m, '-', y) end as birthday""",
    """case when c_custkey % 71 = 0 then null when c_custkey % 6 = 5 then '737931'
         when c_custkey % 10 = 7 then concat(substring(p, 1, 4), '-', substring(p, 5, 4))
         when c_custkey % 3 = 0 then concat(substring(p, 1, 4), ' ', substring(p, 5, 4)) else p end as mobile""",
    "concat('batch_', cast(c_custkey % 3 as string), '.csv') as source_file",
)

# ---- Sales tables ---------------------------------------------------------------

_MEMBERS = (
    "cast(c_custkey as string) as membership_id", "c_name as first_name", "c_mktsegment as last_name",
)

_TRANSACTIONS = (
    "o_orderkey as transaction_id", "cast(o_custkey as string) as membership_id",
    "o_orderdate as transaction_ts", "cast(o_totalprice as decimal(12,2)) as total_items_price",
    "cast(0 as decimal(10,3)) as total_items_weight",
)

_ITEMS = (
    "p_partkey as item_id", "p_name as item_name", "p_brand as manufacturer_name",
    "cast(p_retailprice as decimal(10,2)) as cost", "cast(p_size as decimal(8,3)) as weight_kg",
)

# The paid unit price is the line price over the quantity, cut to whole cents.
_LINES = (
    "l_orderkey as transaction_id", "l_partkey as item_id", "cast(l_quantity as int) as quantity",
    "cast(cast(floor(l_extendedprice / l_quantity * 100) as bigint) * 0.01 as decimal(10,2)) as unit_cost_at_purchase",
    "cast((cast(round(l_discount * 100) as bigint) + 1) * 0.010 as decimal(8,3)) as unit_weight_at_purchase",
    "l_linenumber as line_number", "l_returnflag as return_flag", "l_linestatus as line_status",
)

# ---- Image events -----------------------------------------------------------------


def _events(key: str) -> tuple[str, ...]:
    """``key`` is the engine's expression for field k of the JSON text."""
    return (
        "event_id", f"concat('img-', cast(user_id as string), '-', cast({key} as string)) as image_id",
        "case when event_type in ('view', 'click') then 'api' else 'kafka' end as source",
        "ts as uploaded_at", "cast(ts as date) as dt",
        "cast(round(value * 100) as bigint) as duration_ms",
        "case when event_type = 'error' then 'ERROR' when event_type = 'signup' then 'PENDING' else 'DONE' end as status",
        f"case cast({key} as int) % 4 when 0 then 'jpeg' when 1 then 'png' when 2 then 'webp' else 'gif' end as format",
        f"cast({key} as bigint) * 1024 as bytes_in",
        f"concat('raw/', cast(user_id as string), '/', cast({key} as string)) as s3_key",
    )


_EVENTS_SPARK = _events("get_json_object(props, '$.k')")
_EVENTS_DUCK = _events("json_extract_string(props, '$.k')")


def applications(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").selectExpr(*_APPLICANT).selectExpr(*_APPLICATION)


def members(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").selectExpr(*_MEMBERS)


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(*_TRANSACTIONS)


def items(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").selectExpr(*_ITEMS)


def lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").selectExpr(*_LINES)


def image_events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(*_EVENTS_SPARK)


# ---- The same in DuckDB -------------------------------------------------------------


def _pick(columns: tuple[str, ...], source: str) -> str:
    return f"select {', '.join(columns)} from {source}"


_DUCK_VIEWS = {
    "applications": _pick(_APPLICATION, f"({_pick(_APPLICANT, 'customer')}) applicant"),
    "cleaned": r"""
      select c.*, strftime(birthday_date, '%Y%m%d') as birthday_ymd,
        cast(case when birthday_date is null then null
          else 2022 - year(birthday_date)
            - case when (month(birthday_date), day(birthday_date)) > (1, 1) then 1 else 0 end end as integer) as age
      from (
        select n.*, core[1] as first_name,
          case when len(core) >= 1 then array_to_string(core[2:], ' ') end as last_name,
          try_cast(try_strptime(trim(birthday), ['%Y-%m-%d', '%Y/%m/%d', '%m/%d/%Y', '%d-%m-%Y']) as date) as birthday_date,
          regexp_replace(mobile, '\s+', '', 'g') as mobile_normalised
        from (
          select t.*, tokens[
              1 + case when rtrim(lower(tokens[1]), '.') in
                ('mr','mrs','ms','miss','mx','dr','prof','rev','sir','madam') then 1 else 0 end
              : len(tokens) - case when len(tokens) > 1 and rtrim(lower(tokens[-1]), '.') in
                ('jr','sr','ii','iii','iv','v','md','dds','dvm','phd','esq','do','rn') then 1 else 0 end] as core
          from (select a.*, regexp_extract_all(name, '\S+') as tokens from applications a) t
        ) n
      ) c""",
    "checked": r"""
      select k.*, age > 18 as above_18,
        first_name is null as f_name, birthday_date is null as f_birthday,
        birthday_date is not null and not coalesce(age > 18, false) as f_age,
        not coalesce(regexp_full_match(mobile_normalised, '[0-9]{8}'), false) as f_mobile,
        not coalesce(lower(trim(email)) like '%.com' or lower(trim(email)) like '%.net', false) as f_email
      from cleaned k""",
    "validated": r"""
      select v.*, rejection_reason = '' as is_successful,
        case when rejection_reason = '' then concat(last_name, '_', substring(sha256(birthday_ymd), 1, 5)) end as membership_id
      from (
        select c.*, concat_ws(';',
          case when f_name then 'missing_name' end, case when f_birthday then 'unparseable_birthday' end,
          case when f_age then 'under_18' end, case when f_mobile then 'invalid_mobile' end,
          case when f_email then 'invalid_email' end) as rejection_reason
        from checked c) v""",
    "accepted": """
      select membership_id, first_name, last_name, email, birthday_ymd as birthday, above_18,
        mobile_normalised as mobile, source_file, app_id from validated where is_successful""",
    "rejected": """
      select name, email, birthday as birthday_raw, mobile as mobile_raw, first_name, last_name,
        birthday_ymd as birthday, age, above_18, rejection_reason, source_file
      from validated where not is_successful""",
    "members": _pick(_MEMBERS, "customer"),
    "transactions": _pick(_TRANSACTIONS, "orders"),
    "items": _pick(_ITEMS, "part"),
    "lines": _pick(_LINES, "lineitem"),
    "image_events": _pick(_EVENTS_DUCK, "events"),
}

_NEEDS = {"cleaned": ["applications"], "checked": ["cleaned"], "validated": ["checked"],
          "accepted": ["validated"], "rejected": ["validated"]}


@cache
def _with_needed(names: tuple[str, ...]) -> tuple[str, ...]:
    out: list[str] = []
    for name in names:
        for needed in (*_with_needed(tuple(_NEEDS.get(name, ()))), name):
            if needed not in out:
                out.append(needed)
    return tuple(out)


def duck(body: str, *names: str) -> str:
    """``body`` over the named views, as one statement on the given tables."""
    views = ", ".join(f"{n} as materialized ({_DUCK_VIEWS[n]})" for n in _with_needed(names))
    return f"with {views} {body.strip()}" if not body.strip().startswith("with ") else (
        f"with {views}, {body.strip()[5:]}"
    )
