"""Skew: one product carries a third of all order lines (data derived from the
given tables).  Results must stay exact and the plans must reduce the hot key
before any shuffle."""

import pytest
from pyspark.sql import functions as F

from shelfwise.plans import queries as Q
from shelfwise.sources.star import build_star
from tests.helpers import digest, plan_text

HOT = 7
HOT_CUSTOMER = 11


@pytest.fixture(scope="module")
def skewed(spark):
    from shelfwise.session import new_scratch
    root = new_scratch(spark, "skewed")
    src = "/root/testdata/sf0.01"
    li = spark.read.parquet(f"{src}/lineitem.parquet")
    hot = li.withColumn("l_partkey", F.when(F.col("l_orderkey") % 3 == 0, F.lit(HOT))
                        .otherwise(F.col("l_partkey")))
    hot.write.parquet(f"{root}/lineitem.parquet")
    orders = spark.read.parquet(f"{src}/orders.parquet")
    orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 1, F.lit(HOT_CUSTOMER))
                      .otherwise(F.col("o_custkey"))).write.parquet(f"{root}/orders.parquet")
    for t in ("part", "supplier", "nation", "customer", "region", "events"):
        spark.read.parquet(f"{src}/{t}.parquet").write.parquet(f"{root}/{t}.parquet")
    from shelfwise.session import local_path
    return root, local_path(root)


def _duck(path):
    import duckdb
    con = duckdb.connect()
    for t in ("lineitem", "orders", "part", "supplier", "nation", "customer", "region",
              "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}/{t}.parquet/*.parquet')")
    return con


@pytest.mark.parametrize("name", ["q1_supplier_drilldown", "q3_weekend_top5",
                                  "q5_sigma_anomaly", "q9_compat", "q9_line",
                                  "q10_entity_month_mv_compat", "q10_entity_month_mv_line",
                                  "q6_line", "dim_customer", "fact_load_compat"])
def test_hot_keys_exact(spark, skewed, name):
    import __spark_entry__ as E
    root, local = skewed
    df = E.queries()[name](spark, root)
    rows = [tuple(r) for r in df.collect()]
    res = _duck(local).execute(E.oracle_sql()[name])
    assert digest(df.columns, rows) == digest([d[0] for d in res.description], res.fetchall())


def test_hot_key_share(spark, skewed):
    root, _ = skewed
    li = spark.read.parquet(f"{root}/lineitem.parquet")
    share = li.where(F.col("l_partkey") == HOT).count() / li.count()
    assert share > 0.3
    o = spark.read.parquet(f"{root}/orders.parquet")
    assert o.where(F.col("o_custkey") == HOT_CUSTOMER).count() / o.count() > 0.3


def test_partial_aggregate_before_shuffle(spark, skewed):
    root, _ = skewed
    plan = plan_text(Q.q10_entity_month_mv_compat(build_star(spark, root)))
    # every exchange of raw lines is preceded by a partial aggregate
    assert "partial_sum(qty" in plan
    assert "partial_min(struct" in plan or "partial_min" in plan
