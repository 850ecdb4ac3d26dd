"""Hot keys: a third of the rows on one key, derived from the given tables."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kpimart.operators import enrich
from kpimart.plans import TEST_PARAMS, Inputs, build
from kpimart.plans.registry import TIE
from tests.conftest import SF0001, rows


def _skewed_cap_apo(spark, inputs):
    """Address records where every row with l_linenumber <= 3 points at one permit."""
    li = spark.read.parquet(f"{SF0001}/lineitem.parquet")
    hot = inputs["permits"].filter(F.col("permit_type") == "Construction").agg(F.min("cap_id")).first()[0]
    return li.select(F.when(F.col("l_linenumber") <= 3, F.lit(hot)).otherwise(F.col("l_orderkey"))
                     .alias("b1_alt_id")), hot


def test_hot_permit_weighted_equals_fan_out(spark, inputs_small):
    cap_apo, hot = _skewed_cap_apo(spark, inputs_small)
    share = cap_apo.filter(F.col("b1_alt_id") == hot).count() / cap_apo.count()
    assert share > 0.3
    skewed = Inputs({**inputs_small.tables, "cap_apo": cap_apo}, inputs_small.calendar, inputs_small.cal_rows)
    onepass = build("permits", skewed, TEST_PARAMS, "onepass", TIE)
    plain = build("permits", skewed, TEST_PARAMS, "plain", TIE)
    assert rows(onepass) == rows(plain)
    # The lookup reaches its shuffle only as partial counts per key.
    plan = onepass._jdf.queryExecution().executedPlan().toString()
    assert "partial_count(1)" in plan


def test_enrich_hot_key_uses_skew_split(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        # A cluster scans with many tasks; one small file is one task here, and AQE
        # splits a hot partition by ranges of map tasks, so spread it first.
        li = spark.read.parquet(f"{SF0001}/lineitem.parquet").repartition(8)
        left = li.select(F.when(F.col("l_linenumber") <= 3, F.lit(1)).otherwise(F.col("l_orderkey")).alias("k"),
                         "l_partkey")
        dim = spark.read.parquet(f"{SF0001}/orders.parquet").select(F.col("o_orderkey").alias("id"), "o_custkey")
        out = enrich(left, dim, {"k": "id"}, ["o_custkey"])
        assert len(out.collect()) == left.count()      # runs this Dataset's own adaptive plan
        final = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in final or "skew=true" in final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@pytest.mark.parametrize("descending", [False, True])
def test_row_rank_spreads_a_hot_key(spark, monkeypatch, descending):
    from kpimart.operators import joins

    monkeypatch.setattr(joins, "HOT_KEY_ROWS", 300)
    spread, by_range = [], joins._rank_by_range

    def watched(rows, key, sort, out_col):
        out = by_range(rows, key, sort, out_col)
        spread.extend(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
        return out

    monkeypatch.setattr(joins, "_rank_by_range", watched)
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 == 0, None).otherwise((F.col("id") % 500).cast("string")).alias("k"),
        F.lit(1).alias("k2"), (F.col("id") * 7919 % 13).alias("d"), F.when(F.col("id") % 11 > 0, F.col("id") % 11).alias("e"), "id")
    got = joins.row_rank(df, ["k", "k2"], ["d", "e"], ["id"], "n", descending)
    order = [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first() for c in ("d", "e")]
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("k", "k2").orderBy(*order, "id")))
    assert got.dtypes == want.dtypes and rows(got) == rows(want)
    # the hot key (3000 rows) and NULL (857) lie in all 8 partitions, none with much more than its share
    assert len(spread) == 8 and max(spread) < 1000


def test_row_rank_numbers_rows_tied_on_everything(spark, monkeypatch):
    from kpimart.operators import joins

    monkeypatch.setattr(joins, "HOT_KEY_ROWS", 100)
    df = spark.range(4000).select(F.lit("hot").alias("k"), F.lit(5).alias("d"))
    assert sorted(r.n for r in joins.row_rank(df, "k", ["d"], [], "n").collect()) == list(range(1, 4001))
    assert joins.row_rank(df.limit(0), "k", ["d"], [], "n").count() == 0


def test_hot_keys_are_bounded(spark):
    from kpimart.operators.joins import hot_keys

    df = spark.range(1000).select((F.col("id") % 100).alias("k"))
    assert hot_keys(df, ["k"], least=9) is None            # ten rows each: below a task's quarter
    assert hot_keys(df, ["k"], least=1000) is None
    one = hot_keys(df.union(spark.range(400).select(F.lit(None).cast("long"))), ["k"], least=9).collect()
    assert [(r["__h0"], r["__hot"]) for r in one] == [(None, 0)]


def test_a_key_hot_on_the_lookup_side_is_split(spark):
    from kpimart.operators import enrich_split

    left = spark.range(600).select((F.col("id") % 50).alias("k"), "id", F.when(F.col("id") % 9 == 0, None).otherwise(F.col("id")).alias("none"))
    left = left.withColumn("k", F.when(F.col("id") % 40 == 0, None).otherwise(F.col("k")))
    right = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 60).alias("kk"),
                                     (F.col("id") % 11).alias("v"), F.when(F.col("id") % 2 == 0, F.lit("w")).alias("u"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for columns in (["v", "u"], ["v"], []):
            got = enrich_split(left, right, {"k": "kk"}, columns, least=200)
            want = enrich(left, right, {"k": "kk"}, columns)
            assert got.columns == want.columns and rows(got) == rows(want)
            # the hot key's pairs, a third of the lookup times its rows, lie in many partitions
            spread = [r["count"] for r in got.filter("k = 7").groupBy(F.spark_partition_id()).count().collect()]
            assert len(spread) >= 5 and max(spread) < 0.5 * sum(spread)
        assert rows(enrich_split(left, right, {"k": "kk"}, ["v"])) == rows(enrich(left, right, {"k": "kk"}, ["v"]))
        two = right.withColumn("k2", F.lit(1))
        got = enrich_split(left.withColumn("j", F.lit(1)), two, {"k": "kk", "j": "k2"}, ["v"], least=200)
        assert rows(got) == rows(enrich(left.withColumn("j", F.lit(1)), two, {"k": "kk", "j": "k2"}, ["v"]))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
