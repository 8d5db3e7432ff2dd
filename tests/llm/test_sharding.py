import duckdb
import pytest
from pyspark.sql import functions as F

from berthline.llm import sharding


@pytest.mark.parametrize("limit", [700, 4000, 10**9])
def test_against_sql(spark, limit):
    df = spark.range(400).select(
        F.col("id").alias("doc_id"),
        F.expr("repeat('é', cast(1 + id % 97 as int))").alias("text"),
        F.expr("case when id % 3 = 0 then 'hot' when id % 50 = 1 then null else concat('s', id % 11) end").alias("source"),
        F.lit(3).alias("depth"),
    )
    df = df.withColumn("text", F.when(F.col("doc_id") == 7, None).when(F.col("doc_id") == 9, F.expr("repeat('x', 5000)")).otherwise(F.col("text")))
    got = sharding.shard(df, limit, key=["source"], spread=["doc_id"]).toPandas()
    documents = df.drop("depth").toPandas()  # noqa: F841
    want = duckdb.sql(sharding.oracle(limit)).df()
    columns = ["doc_id", "n_bytes", "shard", "depth", "shard_bytes"]
    got, want = (x[columns].sort_values("doc_id").reset_index(drop=True).astype({"depth": int, "shard_bytes": int}) for x in (got, want))
    assert got.equals(want.astype(got.dtypes))
    sums = got.groupby("shard").agg(total=("n_bytes", "sum"), rows=("n_bytes", "size"))
    assert ((sums["total"] <= limit) | (sums["rows"] == 1)).all()


def test_rows_that_no_bit_can_split(spark):
    rows = [(5, "copy of one row", "s")] * 60 + [(i, "other", "s") for i in range(100, 130)] + [(None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = sharding.shard(df, 100, key=["source"], spread=["doc_id"]).toPandas()
    sums = got.groupby("shard")["n_bytes"].sum()
    assert len(got) == len(rows) and sums.max() <= 100
    assert (got["shard_bytes"] == got["shard"].map(sums)).all()


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert sharding.shard(df, 100, key=["source"], spread=["doc_id"]).collect() == []
