"""Stand-in views over the given tables, as SQL that Spark and DuckDB both run.

Arithmetic is modular, as hash functions differ between engines; keys stay below 3.4e9.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "occ": """
select o_orderkey as obs_id,
  case o_orderpriority when '1-URGENT' then ' Protonotaria Citrea' when '2-HIGH' then 'Vireo griseus '
    when '3-MEDIUM' then 'Ursus americanus' when '5-LOW' then 'Setophaga coronata coronata'
    else 'Hyla cinerea' end as scientific_name,
  cast(cast(o_orderdate + interval '22' year as date) as string) as observation_date,
  case o_orderstatus when 'F' then 'Stationary' when 'O' then 'Traveling' else 'Incidental' end as protocol_name,
  case when o_custkey % 40 = 39 then null else cast(o_custkey % 40 as double) / cast(100 as double) end as effort_distance_km,
  cast(-92 as double) + cast(((o_orderkey * 7919) % 10007) * 4 as double) / cast(10007 as double) as longitude,
  cast(32 as double) + cast(((o_orderkey * 1299709) % 10009) * 4 as double) / cast(10009 as double) as latitude,
  cast((o_orderkey * 7919) % 60 as int) as cx, cast((o_orderkey * 1299709) % 60 as int) as cy
from orders""",
    "gbif": """
select c_custkey as obs_id, case when c_custkey % 11 = 0 then null else 'HUMAN_OBSERVATION' end as basisofrecord,
  case c_mktsegment when 'BUILDING' then 'Ursus americanus' else 'Hyla avivoca' end as species,
  cast(32 as double) + cast((c_custkey * 7919) % 4000 as double) / cast(1000 as double) as latitude,
  cast(-92 as double) + cast((c_custkey * 104729) % 4000 as double) / cast(1000 as double) as longitude,
  cast((c_custkey * 37) % 250 as double) as coordinateuncertaintyinmeters,
  cast(2017 + c_custkey % 8 as int) as year, cast(1 + c_custkey % 12 as int) as month, cast(1 + (c_custkey * 7) % 31 as int) as day
from customer""",
    "cell": """
select cast((l_orderkey * 31 + l_linenumber) % 60 as int) as cx, cast((l_partkey * 17 + l_linenumber) % 60 as int) as cy,
  l_shipdate + interval '22' year as scene_ts, cast((l_suppkey + l_linenumber) % 9 as int) as label
from lineitem""",
    "scored": """
select event_id as id, cast(event_id % 8 as int) as grp,
  case when value + cast((event_id % 97) * 5 as double) > cast(500 as double) then 1 else 0 end as label,
  (value + cast((event_id * 31) % 50 as double)) / cast(600 as double) as score
from events""",
    "plot": """
select s_suppkey as poly_id, cast(-92 as double) + cast((s_suppkey * 7919) % 4001 as double) / cast(1000 as double) as x0,
  cast(32 as double) + cast((s_suppkey * 104729) % 4003 as double) / cast(1000 as double) as y0,
  cast(1 + s_suppkey % 5 as double) / cast(16 as double) as r
from supplier""",
    "vertex": """
select poly_id, cast(0 as int) as ring_id, cast(seq as int) as seq,
  case seq when 0 then x0 + r when 1 then x0 when 2 then x0 - r when 3 then x0 else x0 + r end as x,
  case seq when 0 then y0 when 1 then y0 + r when 2 then y0 when 3 then y0 - r else y0 end as y
from plot, (values (0), (1), (2), (3), (4)) as corner(seq)""",
    "edge": """
select a.poly_id, a.x as x1, a.y as y1, b.x as x2, b.y as y2
from vertex a join vertex b on a.poly_id = b.poly_id and a.ring_id = b.ring_id and b.seq = a.seq + 1""",
    "geojson": """
select obs_id, concat('{"type":"Point","coordinates":[', cast(cx as string), ',', cast(cy as string), ']}') as geo from occ""",
    "train": """
select obs_id as id, lower(replace(trim(scientific_name), ' ', '_')) as species,
  case when (obs_id * 31) % 7 + cx / 20 > 5 then 1 else 0 end as label,
  cast(cx as double) / cast(60 as double) as f1, cast(cy as double) / cast(60 as double) as f2, effort_distance_km as f3
from occ""",
    "fresh": """
select obs_id as id, lower(replace(trim(species), ' ', '_')) as species,
  case when obs_id % 13 = 0 then null else cast(obs_id % 60 as double) / cast(60 as double) end as f1 from gbif""",
}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _named(sql: str, names) -> list[str]:
    return [n for n in names if re.search(rf"(?:from|join|,)\s+{n}\b", sql)]


def ctes(sql: str) -> str:
    """sql with the views that it names before it, for an engine that has the tables only."""
    found: list[str] = []

    def visit(text: str) -> None:
        for n in _named(text, VIEWS):
            visit(VIEWS[n])
            if n not in found:
                found.append(n)

    visit(sql)
    body = sql.strip()
    head = ",\n".join(f"{n} as ({VIEWS[n].strip()})" for n in found)
    if not head:
        return body
    return f"with {head},\n{body[5:]}" if body.lower().startswith("with ") else f"with {head}\n{body}"


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of VIEWS over the tables in sf_dir, lazily."""
    return sql(spark, sf_dir, f"select * from {name}")


def sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A query over VIEWS and the tables in sf_dir."""
    text = ctes(text)
    used = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in _named(text, TABLES)}
    for n in used:
        text = re.sub(rf"((?:from|join|,)\s+){n}\b", rf"\1{{{n}}}", text)
    # Braces of the text itself must survive the substitution of the tables.
    text = text.replace('\'{"type"', '\'{{"type"').replace("']}'", "']}}'")
    return spark.sql(text, **used)
