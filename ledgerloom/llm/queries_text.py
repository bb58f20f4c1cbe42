"""Queries of the operators that work document by document."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.registry import Collected
from ..session import scratch_path
from . import langid, preferences as pf, secret_scan as ss, tokens
from .common import fold, table

_QUERIES = Collected()
QUERIES = _QUERIES.queries

TOKENIZER = "word_bpe_49k.json"


@_QUERIES.add()
def op2_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    tokens.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER))
    return tokens.token_digests(spark, path)


def _completion_sql(side: str) -> str:
    return f"""
  select pair_id, string_agg(rendered, '' order by turn, role, text) as body,
    string_agg((start + head) || ':' || (start + length(rendered) - 1), ',' order by turn, role, text)
      filter (role = '{pf.TRAINED_ROLE}') as mask
  from (select *, coalesce(sum(length(rendered)) over (partition by pair_id order by turn, role, text
          rows between unbounded preceding and 1 preceding), 0)::bigint as start
        from turns where {side} and not common)
  group by pair_id"""


_PREFERENCE_SQL = f"""
with distinct_turns as (
  select conv_id // 2 as pair_id, coalesce(turn, -9223372036854775808) as turn,
    replace(replace(replace(coalesce(role, ''), '{pf.OPEN}', '< |'), '{pf.CLOSE}', '| >'), chr(10), ' ') as role,
    coalesce(text, '') as text, bool_or(conv_id % 2 = 0) as good, bool_or(conv_id % 2 <> 0) as bad
  from conversations where conv_id is not null group by all
),
ends as (select pair_id, min(turn) filter (not (good and bad)) as first from distinct_turns group by pair_id),
turns as (
  select d.*, (first is null or turn < first) as common,
    '{pf.OPEN}' || role || '{pf.CLOSE}' || chr(10) || replace(text, '{pf.OPEN}', '< |') || '{pf.END}' || chr(10) as rendered,
    length('{pf.OPEN}' || role || '{pf.CLOSE}') + 1 as head
  from distinct_turns d join ends using (pair_id)
),
chosen as ({_completion_sql('good')}),
rejected as ({_completion_sql('bad')}),
prompts as (select pair_id, count(*) as n, string_agg(rendered, '' order by turn, role, text) as prompt from turns where common group by pair_id)
select pair_id, coalesce(p.n, 0)::int as n_common, coalesce(p.prompt, '') as prompt, coalesce(c.body, '') as chosen,
  coalesce(r.body, '') as rejected, coalesce(c.mask, '') as chosen_mask, coalesce(r.mask, '') as rejected_mask
from ends left join prompts p using (pair_id) left join chosen c using (pair_id) left join rejected r using (pair_id)
"""


@_QUERIES.add(_PREFERENCE_SQL)
def op3_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations 2k (preferred) and 2k + 1 (not) are a pair."""
    turns = table(spark, sf_dir, "conversations").select(
        F.floor(F.col("conv_id") / 2).alias("pair_id"), (F.col("conv_id") % 2 == 0).alias("chosen"), "turn", "role", "text"
    )
    found = pf.preference_records(turns)
    return found.withColumns({c: pf.mask_text(F.col(c)) for c in ("chosen_mask", "rejected_mask")})


def _spans_sql(pattern: str, kind: str, number: int, keep: str = "true", group: int = 0) -> str:
    """Spans of one pattern: lengths between and inside the matches, summed up to each match."""
    return f"""
  select doc_key, list_transform(list_filter(range(1, len(found) + 1), lambda i: {keep}), lambda i: struct_pack(
    s := (list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda f: length(f))), 0))::bigint,
    k := {number}, f := found[i], kind := '{kind}')) as spans
  from (select doc_key, regexp_extract_all(body, '{pattern}') as found,
          regexp_extract_all(body, '{pattern}', {group}) as inner_,
          string_split_regex(body, '{pattern}') as gaps
        from texts where regexp_matches(body, '{pattern}'))"""


def _quoted(pattern: str) -> str:
    return pattern.replace("'", "''")


def _secrets_sql() -> str:
    terms = ", ".join(str(t) for t in ss.entropy_terms(ss.WINDOW))
    widest = ss.CLASSES[-1].characters
    kinds = " ".join(f"when regexp_full_match(f, '[{c.characters}]*') then '{c.kind}'" for c in ss.CLASSES)
    numbers = " ".join(f"when regexp_full_match(f, '[{c.characters}]*') then {len(ss.BASE_KINDS) + i}" for i, c in enumerate(ss.CLASSES))
    limits = " ".join(f"when regexp_full_match(f, '[{c.characters}]*') then {ss.entropy_limit(ss.WINDOW, c.bits)}" for c in ss.CLASSES)
    allowed = " or ".join(f"regexp_matches(f, '{_quoted(p)}')" for p in ss.ALLOWED)
    w = ss.WINDOW
    return f"""
with texts as materialized (select row_number() over () as doc_key, doc_id, coalesce(text, '') as body from documents),
base as (
  select doc_key, unnest(spans, recursive := true) from ({_spans_sql(_quoted(ss.ASSIGN), 'assign', 0, f'length(inner_[i]) >= {ss.ASSIGN_LENGTH}', 2)})
  union all select doc_key, unnest(spans, recursive := true) from ({_spans_sql(ss.ACCESS, 'access', 1)})
  union all select doc_key, unnest(spans, recursive := true) from ({_spans_sql(ss.HEX, 'hex', 2)})
),
candidates as (
  select doc_key, s, f from (
    select doc_key, unnest(spans, recursive := true) from ({_spans_sql(f'[{widest}]{{{w},}}', '', 9)})
  ) where not ({allowed})
),
windows as (
  select doc_key, s, f, unnest(range(0, length(f) - {w} + 1)) as o from candidates
),
dense as (
  select doc_key, s, f, min(o) as first, max(o) as last from (
    select *, list_sum(list_transform(list_distinct(cs), lambda c: ([{terms}])[len(list_filter(cs, lambda x: x = c)) + 1])) as total
    from (select *, string_split(f[o + 1:o + {w}], '') as cs from windows)
  ) where total <= case {limits} end group by all
),
added as (
  select doc_key, s + first as s, case {numbers} end as k, s + last + {w} as e, case {kinds} end as kind from dense
),
spans as (
  select doc_key, s, k, s + length(f) as e, kind, true as is_base from base
  union all
  select a.doc_key, a.s, a.k, a.e, a.kind, false from added a where not exists (
    select 1 from base b where b.doc_key = a.doc_key and b.s <= a.s and a.e <= b.s + length(b.f))
),
per_doc as (
  select doc_key, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
    count(*) filter (kind = 'hex') as n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' order by s, k) filter (is_base) as base,
    string_agg(kind || ':' || s || ':' || e, ',' order by s, k) as spans
  from spans group by doc_key
)
select doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access,
  coalesce(n_hex, 0)::bigint as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from texts left join per_doc using (doc_key)
"""


@_QUERIES.add(_secrets_sql())
def op4_secret_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ss.with_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("secrets")
    return found.select(
        "doc_id", *[ss.count_kind(spans, k).alias(f"n_{k}") for k in ss.BASE_KINDS],
        F.sha2(ss.span_text(ss.base_spans(spans)), 256).alias("base_sha256"), ss.span_text(spans).alias("spans"),
    )


@_QUERIES.add()
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold(F.col("doc_id"), 5) == 0)
    model = langid.train(docs.where(~F.col("held_out")))
    found = langid.identified(docs.select("doc_id", "text", "held_out"), model)
    return found.select("doc_id", "held_out", F.col("identified.lang").alias("lang_pred"),
                        F.col("identified.score").alias("score"), F.col("identified.rejected").alias("rejected"))
