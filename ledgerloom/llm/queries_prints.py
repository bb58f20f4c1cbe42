"""Queries of fingerprints, vector codes and conversation prefixes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.registry import Collected
from . import multiset_hash as mh, prefix_trie as pt, vector_codes as vc
from .common import table

_QUERIES = Collected()
QUERIES = _QUERIES.queries


def _word_sql(digest: str, number: str) -> str:
    return f"('0x' || substr({digest}, 8 * {number} + 1, 8))::bigint"


def _lanes_sql(text: str) -> str:
    """All lanes of a text: sums over its paragraphs, then over its sentences."""
    exact = f"""list_transform(range({mh.EXACT}), lambda i: list_sum(list_transform(string_split({text}, chr(10)), lambda p:
      {_word_sql(f"sha256((i // {mh.EXACT // 2}) || ':' || p)", f"(i % {mh.EXACT // 2})")}))::bigint)"""
    signed = f"""list_transform(range({mh.LIKE}), lambda i: coalesce(list_sum(list_transform(string_split_regex({text}, '{mh.SENTENCE}'), lambda s:
      round(sqrt(length(s)))::bigint * (2 * (({_word_sql('sha256(s)', '(i // 32)')} >> (i % 32)::bigint) & 1) - 1))), 0)::bigint)"""
    return f"list_transform({exact} || {signed}, lambda n: (n % {mh.MODULUS} + {mh.MODULUS}) % {mh.MODULUS})"


def _print_sql(lanes: str) -> str:
    return f"list_aggregate(list_transform({lanes}, lambda n: lpad(lower(to_hex(n)), 8, '0')), 'string_agg', '')"


def _likeness_sql(a: str, b: str) -> str:
    def signed(lanes: str) -> str:
        return (f"list_transform(({lanes})[{mh.EXACT + 1}:], lambda n: "
                f"(case when n >= {mh.MODULUS // 2} then n - {mh.MODULUS} else n end)::double)")

    def product(x: str, y: str) -> str:
        return f"list_inner_product({signed(x)}, {signed(y)})"

    both = f"({product(a, a)} + {product(b, b)})"
    return f"""case when ({a})[1:{mh.EXACT}] = ({b})[1:{mh.EXACT}] then 1.0::double when {both} = 0 then 0.0::double
      else greatest(0.0::double, least(1.0::double, 2.0::double * {product(a, b)} / {both})) end"""


_FINGERPRINT_SQL = f"""
with texts as (select doc_id, coalesce(text, '') as text from documents),
pairs as (
  select doc_id, text, coalesce(lead(text) over (order by doc_id nulls last), first_value(text) over (order by doc_id nulls last)) as next_text
  from texts
),
edits as (
  select *, length(text) as n_chars,
    left(text, length(text) - length(text) // 2) || left(next_text, length(text) // 2) as edited from pairs
),
lanes as (
  select *, {_lanes_sql('text')} as a, {_lanes_sql('edited')} as b, {_lanes_sql('next_text')} as c from edits
)
select doc_id, n_chars::bigint as n_chars, sha256(edited) as edited_sha256, {_print_sql('a')} as fingerprint,
  {_print_sql('b')} as edited_fingerprint, {_likeness_sql('a', 'b')} as near_edited, {_likeness_sql('a', 'c')} as near_next
from lanes
"""


@_QUERIES.add(_FINGERPRINT_SQL)
def op12_multiset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mh.edited_fingerprints(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
                        "near_edited", "near_next")


def _assign_sql(books: str) -> str:
    """(row, label, p, x, k, d): nearest entry of every part; the lowest index wins a tie."""
    return f"""
  select row, label, p, any_value(x) as x, (min(d * {vc.ENTRIES} + k) % {vc.ENTRIES})::bigint as k, (min(d * {vc.ENTRIES} + k) // {vc.ENTRIES})::bigint as d
  from (select row, label, r.p, r.x, c.k, (list_inner_product(r.x, r.x) - 2 * list_inner_product(r.x, c.x) + list_inner_product(c.x, c.x))::bigint as d
        from parts r join {books} c on r.p = c.p) group by row, label, p"""


_ROUNDS_SQL = "".join(f"""
a{t} as materialized ({_assign_sql(f'c{t}')}),
c{t + 1} as materialized (
  select c.p, c.k, coalesce(m.x, c.x) as x from c{t} c left join (
    select p, k, list(v order by i) as x from (
      select p, k, i, floor(sum(x[i]) / count(*)) as v from a{t}, (select unnest(range(1, len(x) + 1)) as i from (select x from parts limit 1)) group by p, k, i
    ) group by p, k
  ) m on c.p = m.p and c.k = m.k
),""" for t in range(vc.ROUNDS))

_VECTOR_CODES_SQL = f"""
with kept as (
  select row_number() over (order by vec_id nulls last, embedding) as row, vec_id, label,
    list_transform(embedding, lambda x: floor(x::double * {vc.SCALE})) as e
  from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
parts as materialized (
  select row, vec_id, label, p, e[(p * len(e) // {vc.PARTS} + 1)::int:((p + 1) * len(e) // {vc.PARTS})::int] as x
  from kept, (select unnest(range({vc.PARTS})) as p)
),
c0 as materialized (select p, row - 1 as k, x from parts where row <= {vc.ENTRIES}),{_ROUNDS_SQL}
last as materialized ({_assign_sql(f'c{vc.ROUNDS}')}),
codes as (select row, label, string_agg(lpad(lower(to_hex(k)), 2, '0'), '' order by p) as code, sum(d)::bigint as error from last group by row, label),
digest as (
  select sha256(string_agg(list_aggregate(list_transform(x, lambda v: v::bigint::varchar), 'string_agg', ','), ',' order by p, k)) as codebooks_sha256
  from c{vc.ROUNDS}
)
select vec_id, code, error, (sum(error) over (partition by c.label))::bigint as label_error, codebooks_sha256
from codes c join kept using (row), digest
"""


@_QUERIES.add(_VECTOR_CODES_SQL)
def op13_norm_of_sum_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vc.compressed(table(spark, sf_dir, "embeddings"))
    return vc.with_label_errors(coded).select(
        "vec_id", vc.code_text(F.col("codes")).alias("code"), "error", "label_error", F.lit(vc.books_sha256(books)).alias("codebooks_sha256"))


def _crc32_sql(text: str) -> str:
    """Unsigned crc32 of a short ASCII text, bit by bit."""
    bit = "lambda x, y: xor(x >> 1, 3988292384::bigint * (x & 1))"
    byte = f"lambda crc, c: list_reduce([xor(crc, c), 0, 0, 0, 0, 0, 0, 0, 0], {bit})"
    return f"xor(list_reduce([4294967295::bigint] || list_transform(string_split({text}, ''), lambda c: ascii(c)::bigint), {byte}), 4294967295)"


_TRIE_SQL = f"""
with turns as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as place,
    {{'digest': sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 'n': length(coalesce(text, ''))}} as turn
  from conversations where conv_id is not null
),
own as (select conv_id, list(turn order by place) as turns, {_crc32_sql('conv_id::varchar')} % 6 as h from turns group by conv_id),
rebuilt as (
  select o.conv_id, coalesce(b.turns[1:o.h], []) || o.turns[o.h + 1:] as turns
  from own o left join own b on b.conv_id = o.conv_id - o.conv_id % 100
),
prefixes as (select conv_id, len(turns) as length, unnest(range(len(turns) + 1)) as depth, turns from rebuilt),
nodes as (
  select turns[1:depth] as prefix, depth, min(conv_id) as conv_id, count(*) as n,
    sha256(coalesce(string_agg(conv_id, ',' order by conv_id) filter (length = depth), '')) as ends
  from prefixes group by all
),
children as (select prefix[1:depth - 1] as prefix, depth - 1 as depth, count(*) as n from nodes where depth > 0 group by all),
described as (
  select v.*, coalesce(c.n, 0) as n_children, case when v.depth > 0 then (v.n - 1) * v.prefix[v.depth]['n'] else 0 end as saved
  from nodes v left join children c on v.prefix = c.prefix and v.depth = c.depth
),
upward as (select prefix[1:up] as prefix, up as depth, n_children, saved from (select *, unnest(range(depth + 1)) as up from described)),
subtrees as (select prefix, depth, count(*) filter (n_children = 0) as n_leaves, sum(saved) as saved from upward group by all)
select v.conv_id, v.depth::bigint as depth, p.conv_id as parent_conv_id, v.n::bigint as n_convs, v.n_children::bigint as n_children,
  s.n_leaves::bigint as n_leaves, s.saved::bigint as saved_tokens, v.ends as ends_sha256
from described v join subtrees s on v.prefix = s.prefix and v.depth = s.depth
left join nodes p on v.depth > 0 and p.depth = v.depth - 1 and p.prefix = v.prefix[1:v.depth - 1]
"""


@_QUERIES.add(_TRIE_SQL)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pt.prefix_trie(pt.with_shared_heads(pt.sequences(table(spark, sf_dir, "conversations"))))
