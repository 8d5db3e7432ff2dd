"""The queries that keep something in scratch space, where tasks run outside the driver and nothing sets spark.checkpoint.dir."""

import os
import subprocess
import sys
from pathlib import Path

REPO = str(Path(__file__).resolve().parent.parent)

KEEPING = """
change_rows clustered_filters coordinates daily_doc_counts daily_docs_round_trip daily_docs_whole_round_trip entity_staged
entity_report facets_kept deep_pages fuzzy_indexed incremental_ingest ingest_history ingest_repeats manifest_read
metrics_document page_assembly_short page_assembly_empty payload_written page_assembly_total refreshed_order refreshed_table
"""

RUN = """
import sys
import duckdb
from pyspark.sql import SparkSession
import __spark_entry__ as entry
from check_queries import table

here, names = sys.argv[1], sys.argv[2:]
con = duckdb.connect()
made = {
    "region": "select cast(i as int) as r_regionkey, ['ASIA', 'EUROPE'][i + 1] as r_name from range(2) t(i)",
    "nation": "select cast(i as int) as n_nationkey, concat('NATION_', i) as n_name, cast(i % 2 as int) as n_regionkey from range(8) t(i)",
    "customer": "select i as c_custkey, concat('Customer ', i) as c_name, cast(i % 8 as int) as c_nationkey, cast(i as double) as c_acctbal, 'X' as c_mktsegment from range(20) t(i)",
    "part": "select i as p_partkey, concat(['small red gear', 'blue bolt'][i % 2 + 1], '') as p_name, 'B' as p_brand, concat('TYPE ', i % 3) as p_type, cast(i % 12 as int) as p_size, cast(i as double) as p_retailprice from range(24) t(i)",
    "orders": "select i as o_orderkey, i * 7 % 20 as o_custkey, ['O', 'F', 'P'][i % 3 + 1] as o_orderstatus, cast(100 + i as double) as o_totalprice, timestamp '2000-05-22' + to_days(cast(i % 40 as int)) as o_orderdate, '1' as o_orderpriority from range(200) t(i)",
    "lineitem": "select i as l_orderkey, i % 24 as l_partkey, i % 5 as l_suppkey, 1::int as l_linenumber, 2::double as l_quantity, 10::double as l_extendedprice, 0::double as l_discount, 0::double as l_tax, 'A' as l_returnflag, 'O' as l_linestatus, timestamp '2000-05-22' + to_days(cast(i % 40 as int)) as l_shipdate from range(200) t(i)",
}
for name, sql in made.items():
    con.execute(f"copy ({sql}) to '{here}/{name}.parquet'")
    con.execute(f"create view {name} as select * from read_parquet('{here}/{name}.parquet')")
conf = {
    "spark.master": "local-cluster[2,1,1024]", "spark.executor.memory": "600m", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2",
    "spark.sql.session.timeZone": "UTC", "spark.sql.warehouse.dir": f"{here}/tables",
}
spark = SparkSession.builder.config(map=conf).getOrCreate()
queries, oracle = entry.queries(), entry.oracle_sql()
for name in names:
    df, res = queries[name](spark, here), con.execute(oracle[name])
    want = table([d[0] for d in res.description], res.fetchall())
    print(name, "same" if table(df.columns, df.collect()) == want and want[1] else "DIFFERS", flush=True)
"""


def test_queries_that_keep_something_run_outside_the_driver(tmp_path):
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": REPO, "TMPDIR": str(tmp_path), "TZ": "UTC"}
    command = [sys.executable, "-c", RUN, str(tmp_path), *KEEPING.split()]
    ran = subprocess.run(command, env=env, cwd=tmp_path, capture_output=True, text=True, timeout=600)
    assert ran.stdout.split("\n")[:-1] == [f"{name} same" for name in KEEPING.split()], ran.stderr[-2000:]
