"""Domain tables as views on the driver's tables, in SQL that Spark and DuckDB both run."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from berthline.session import joinable

DAILY_METRICS = """
select cast(o_orderdate as date) as date,
  sum(cast(o_totalprice as decimal(18,2))) as gmv,
  count(*) as bookings,
  sum(o_custkey % 50) - case when extract(day from cast(o_orderdate as date)) = 13 then sum(o_custkey % 50) else 0 end as sessions,
  case when extract(day from cast(o_orderdate as date)) % 3 = 0 then null else cast(count(*) as double) end as cvr,
  count(distinct o_custkey) as ships,
  max(o_custkey) as members,
  sum(case when o_orderstatus = 'P' then cast(o_totalprice as decimal(18,2)) end) as ad_spend_meta,
  sum(case when o_orderstatus = 'F' then cast(o_totalprice as decimal(18,2)) end) as ad_spend_google
from {orders} where extract(day from cast(o_orderdate as date)) <> 17
group by cast(o_orderdate as date)
"""

AD_DAILY = """
select cast(l_shipdate as date) as report_date,
  sum(cast(l_quantity as bigint)) * 100 as impressions,
  sum(cast(l_quantity as bigint)) as clicks,
  count(*) as conversions,
  sum(cast(l_extendedprice as decimal(18,2))) as ad_spend,
  sum(cast(l_extendedprice as decimal(18,2))) * 3 as revenue,
  case when extract(day from cast(l_shipdate as date)) % 5 = 0 then 0 else count(*) end as roas
from {lineitem} where extract(day from cast(l_shipdate as date)) % 4 <> 0
group by cast(l_shipdate as date)
"""

SEAT_LISTING = """
select o_orderkey as ord,
  case when o_orderkey % 97 = 0 then '' when o_orderkey % 10 = 3 then '만선호' when o_orderkey % 47 = 5 then concat('레드호 ', cast(o_orderkey % 5 as varchar(9)))
    when p_partkey % 4 = 0 then p_name else concat(p_name, ' ', cast(p_partkey as varchar(9))) end as ship_name,
  r_name as area_main, case when o_orderkey % 89 = 0 then '' else n_name end as area_sub,
  case when o_orderkey % 41 = 0 then null when o_orderkey % 10 = 3 then date '2026-01-25' else date '2026-01-01' + cast(o_custkey % 60 as int) end as fishing_date,
  case when o_orderkey % 2 = 0 then '05:30' else '13:00' end as depart_time,
  concat(p_type, case when o_orderkey % 4 = 0 then ', PROMO' else '' end) as fish_types,
  case when o_orderkey % 11 = 0 then 0 else cast(floor(o_totalprice) as bigint) end as price,
  case when o_orderkey % 13 = 0 then 0 else 50 end as total_seats,
  cast(o_custkey % 51 as int) as remain_seats,
  case o_orderstatus when 'O' then 'ING' when 'F' then 'END' else 'CALL' end as status_code,
  case when o_orderkey % 10 = 3 then 'S0' else concat('S', cast(o_custkey % 30 as varchar(9))) end as schedule_no,
  case when o_orderkey % 3 = 0 then 'b' else 'a' end as source
from (select *, o_orderkey % (select count(*) from {part}) as o_partkey from {orders}) o
  join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey
  join {region} on n_regionkey = r_regionkey join {part} on p_partkey = o_partkey
"""

ENTITY_MAP = """
select name, area, row_number() over (order by name, area) as ord,
  1000 + row_number() over (order by name, area) as boat_id
from (select distinct case when p_partkey % 4 = 1 then concat(p_name, ' ', cast(p_partkey as varchar(9))) else p_name end as name,
        concat('NATION_', cast(p_size % 3 as varchar(9))) as area
        from {part} where p_size % 10 in (1, 2)
 union select 'gear', 'NATION_5' union select 'red', 'NATION_1') t
"""

AREA_TABLE = """
select n_nationkey as ord, n_name as sub, r_name as main
from {nation} join {region} on n_regionkey = r_regionkey where n_nationkey % 4 <> 0
"""

VIEWS = {
    "daily_metrics": DAILY_METRICS,
    "ad_daily": AD_DAILY,
    "seat_listing": SEAT_LISTING,
    "entity_map": ENTITY_MAP,
    "area_table": AREA_TABLE,
}
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Tables that the views join to the orders, by their keys.
JOINED = ("customer", "part")

# Schemas of the tables that the views read: no job to infer them.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "pages": "page_id bigint, url string, html string",
}


def duckdb_sql(sql: str) -> str:
    """A query over the views, with the views it names as CTEs."""
    used = [v for v in VIEWS if f"{{{v}}}" in sql]
    text = sql
    ctes = []
    for view in used:
        body = VIEWS[view]
        for table in TABLES:
            body = body.replace(f"{{{table}}}", table)
        ctes.append(f"{view} as ({body.strip()})")
    for name in [*VIEWS, *TABLES]:
        text = text.replace(f"{{{name}}}", name)
    if not ctes:
        return text.strip()
    text = text.strip()
    if text.lower().startswith("with "):
        return "with " + ",\n".join(ctes) + ",\n" + text[5:]
    return "with " + ",\n".join(ctes) + "\n" + text


class Tables:
    """Driver tables and domain views as lazy DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.dir = sf_dir
        self._read: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._read:
            reader = self.spark.read
            if name in TABLE_SCHEMAS:
                reader = reader.schema(TABLE_SCHEMAS[name])
            path = f"{self.dir}/{name}.parquet"
            found = reader.parquet(path)
            self._read[name] = joinable(found, path) if name in JOINED else found
        return self._read[name]

    def sql(self, query: str, **frames: DataFrame) -> DataFrame:
        """Spark SQL with {name} standing for driver tables, domain views or given frames."""
        needed = {n: self.table(n) for n in TABLES if f"{{{n}}}" in query}
        needed |= {n: getattr(self, n) for n in VIEWS if f"{{{n}}}" in query}
        frames |= needed
        text = query.replace("{", "{{").replace("}", "}}")
        for name in frames:
            text = text.replace(f"{{{{{name}}}}}", f"{{{name}}}")
        return self.spark.sql(text, **frames)

    def spread(self, df: DataFrame) -> DataFrame:
        """Deal rows out evenly over the shuffle partitions: the tables are single files of one row group."""
        return df.repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")))

    @cached_property
    def daily_metrics(self) -> DataFrame:
        return self.sql(DAILY_METRICS)

    @cached_property
    def ad_daily(self) -> DataFrame:
        return self.sql(AD_DAILY)

    @cached_property
    def seat_listing(self) -> DataFrame:
        return self.sql(SEAT_LISTING)

    @cached_property
    def entity_map(self) -> DataFrame:
        return self.sql(ENTITY_MAP)

    @cached_property
    def area_table(self) -> DataFrame:
        return self.sql(AREA_TABLE)
