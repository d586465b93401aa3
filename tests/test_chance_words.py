"""identify on customers whose unlike sequences have a word of 24 letters in common by chance, as some of 90,000 do."""

import pytest
from comparing import SF, assert_same, duck
from pyspark.sql import functions as F

from segtrace.plans import ORACLES, QUERIES


@pytest.mark.parametrize("name", ["identify", "identify_by_members"])
def test_hits_by_chance(spark, tmp_path, name):
    keys = [(k,) for k in (5801, 8591, 32827, 35701, 47095, 61392)]  # each second one holds a word of the one before
    customers = spark.createDataFrame(keys, "c_custkey long")
    customers.write.parquet(f"{tmp_path}/customer.parquet")
    orders = customers.select(F.explode(F.expr("sequence(0L, 3L)")).alias("o_orderkey"), F.col("c_custkey").alias("o_custkey"))
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    con = duck(SF)
    for table in ("customer", "orders"):
        con.execute(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    assert_same(QUERIES[name](spark, str(tmp_path)), con, ORACLES[name])
