"""Queries of mixing and sharding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.registry import Collected
from . import mixing, sharding
from .common import WORD, table

_QUERIES = Collected()
QUERIES = _QUERIES.queries

_MIX_SQL = f"""
with sizes as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::bigint as size,
    md5(concat('{mixing.SEED}:', doc_id, ':', md5(coalesce(text, '')), ':',
      row_number() over (partition by doc_id, coalesce(text, '')) - 1)) as drawn_from from documents
),
sources as (
  select source, sum(size)::bigint as source_size,
    ([5.0, 2.0, 1.0]::double[])[((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as weight
  from sizes group by source
),
caps as (select *, 2.0::double * source_size as cap, 2.0::double * source_size / weight as stop from sources),
levels as (
  select *, row_number() over (order by stop, source nulls last) as number, (1.5::double * sum(source_size) over ()
      - coalesce(sum(cap) over (order by stop, source nulls last rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over (order by stop, source nulls last rows between current row and unbounded following) as level
  from caps
),
targets as (
  select source, source_size, least(cap, weight * (select arg_min(level, number) from levels where level <= stop)) as target from levels
),
rates as (
  select *, floor(rate) as certain, rate - floor(rate) as chance from (
    select *, case when source_size > 0 then target / source_size else 0 end as rate from targets)
),
drawn as (
  select d.*, r.source_size, r.target, r.certain, r.chance,
    case when chance > 0 then target - certain * r.source_size else 0 end as need,
    (('0x' || substr(drawn_from, 1, 13))::bigint + 0.5::double) / 4503599627370496.0::double as draw
  from sizes d join rates r on d.source is not distinct from r.source
),
ranked as (
  select *, case when chance > 0 then draw / (1.0::double - draw) / (chance / (1.0::double - chance)) else 0 end as rank from drawn
),
placed as (
  select *, floor(rank / (1.0::double + rank) * 4503599627370496.0::double)::bigint as place from ranked
),
places as (select source, need, place, sum(size) as words from placed where need > 0 group by all),
cuts as (
  select source, max(place) as cut from (
    select *, coalesce(sum(words) over (partition by source order by place rows between unbounded preceding and 1 preceding), 0) as start from places
  ) where start + words / 2.0 <= need group by source
)
select doc_id, size, source_size, target,
  ((certain::bigint + case when need > 0 and place <= cut then 1 else 0 end) * size)::bigint as taken
from placed p left join cuts c on p.source is not distinct from c.source
"""


@_QUERIES.add(_MIX_SQL)
def op5_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@_QUERIES.add()
def op10_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.sharded(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce(F.col("text"), F.lit(""))
    return rows.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
