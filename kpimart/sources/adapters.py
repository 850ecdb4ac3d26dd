"""Test shapes over the driver's TPC-H-like tables.

Each function builds one of the reference's source tables (with this
engine's canonical column names) from the parquet tables in ``sf_dir``, so
the marts run over data that grows with the scale factor. Column mapping
is the one fixed in FIXTURES.md section 3.
"""

from __future__ import annotations

import os
import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpimart.sources.schemas import as_declared


_LOCAL = threading.local()   # per-thread table readers while load_all runs


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table; inside :func:`load_all` each table is read once.

    Every ``spark.read`` runs a small schema-inference job, and the adapters
    share tables (orders feeds five of them).
    """
    path = os.path.join(sf_dir, f"{name}.parquet")
    reads = getattr(_LOCAL, "reads", None)
    if reads is None:
        return spark.read.parquet(path)
    if (sf_dir, name) not in reads:
        reads[(sf_dir, name)] = spark.read.parquet(path)
    return reads[(sf_dir, name)]


def _ward(c: Column) -> Column:
    return F.when(c % 9 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("Ward "), (c % 9).cast("string")))


def _job_class() -> Column:
    seg = F.col("c_mktsegment")
    return (F.when(seg == "BUILDING", "A-C").when(seg == "MACHINERY", "AA-C")
             .when(seg == "AUTOMOBILE", "V-C").otherwise("R-3"))


def _permit_types() -> Column:
    pr = F.col("o_orderpriority")
    return (F.when(pr == "1-URGENT", "New Building Permit")
             .when(pr == "2-HIGH", "Alteration and Repair Permit")
             .when(pr == "3-MEDIUM", "Raze Permit")
             .when(pr == "5-LOW", "Fence Permit"))


def _orders_customers(spark: SparkSession, sf_dir: str, order_cols: list[str], cust_cols: list[str]) -> DataFrame:
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", *order_cols)
    c = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), *cust_cols)
    return o.join(c, "o_custkey")


def address(spark: SparkSession, sf_dir: str) -> DataFrame:
    oc = _orders_customers(spark, sf_dir, [], ["c_nationkey"])
    return oc.select(F.col("o_orderkey").alias("b1_alt_id"), F.col("o_custkey").alias("address_id"),
                     _ward(F.col("c_nationkey")).alias("ward"))


def violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_returnflag", "l_shipdate")
    oc = _orders_customers(spark, sf_dir, ["o_orderstatus", "o_orderpriority", "o_orderdate"], ["c_mktsegment"])
    j = li.join(oc, "o_orderkey")
    seg, pr, st = F.col("c_mktsegment"), F.col("o_orderpriority"), F.col("o_orderstatus")
    key = F.col("o_orderkey")
    return j.select(
        key.alias("cap_id"),
        F.col("l_linenumber"),
        F.when(seg == "BUILDING", "Housing").when(seg == "HOUSEHOLD", "Proactive").otherwise(seg).alias("grp"),
        F.when(pr == "1-URGENT", "Emergency").when(pr.isin("2-HIGH", "3-MEDIUM"), "Routine")
         .when(pr == "5-LOW", "Low").alias("response_level"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string")).otherwise("Served").alias("service_status"),
        F.when(st == "F", "Closed").when(st == "O", "Open")
         .when(key % 3 == 0, "Cancelled").when(key % 3 == 2, "In Progress").alias("cap_status"),
        F.when(F.col("l_returnflag") == "A", "Abated").when(F.col("l_returnflag") == "R", "No Violations Found")
         .when(F.col("l_returnflag") == "N", "Pending").alias("abatement_status"),
        F.col("o_orderdate").alias("service_date"),
        F.col("l_shipdate").alias("abated_date"),
    )


def class_notice(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_suppkey", "l_linenumber",
        "l_returnflag", "l_linestatus", "l_shipdate")
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, "o_orderkey")
    return j.select(
        F.col("l_partkey").alias("ssl_info"),
        F.col("o_custkey").alias("otr_address"),
        F.col("l_shipdate").alias("record_date"),
        F.col("l_shipdate").alias("update_date_time"),
        F.when(F.col("l_linestatus") == "F", "Occupied").otherwise("Open").alias("workflow_status"),
        F.when(F.col("l_returnflag") == "N", "Failed").otherwise("Success").alias("update_status"),
        F.concat(F.lit("Class "), (1 + F.col("l_linenumber") % 4).cast("string")).alias("class_id_from"),
        F.concat(F.lit("Class "), (1 + F.col("l_suppkey") % 4).cast("string")).alias("class_id_to"),
        F.col("o_orderkey").alias("l_orderkey"),
        "l_linenumber", "l_suppkey", "l_returnflag", "l_linestatus",
    )


def owner_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _t(spark, sf_dir, "part")
    m = F.col("p_size") % 3
    return p.select(F.col("p_partkey").alias("ssl_key"),
                    F.when(m == 0, "Y").when(m == 1, "N").alias("delcode"))


def permits(spark: SparkSession, sf_dir: str) -> DataFrame:
    oc = _orders_customers(spark, sf_dir, ["o_orderstatus", "o_orderpriority", "o_orderdate"], ["c_mktsegment"])
    key = F.col("o_orderkey")
    return oc.select(
        key.alias("cap_id"),
        F.col("o_orderdate").alias("issued_date"),
        F.when(F.col("o_orderstatus") == "P", "Trade").otherwise("Construction").alias("permit_type"),
        _job_class().alias("job_class"),
        _permit_types().alias("permit_types"),
        F.nullif(F.col("o_custkey") % 5, F.lit(0)).alias("review_cycles"),
        F.when(key % 11 == 0, F.lit(None).cast("long")).otherwise(key % 97).alias("business_days"),
    )


def cap_apo(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("b1_alt_id"))


def uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate")
    oc = _orders_customers(spark, sf_dir, ["o_orderpriority"], ["c_mktsegment"])
    j = li.join(oc, "o_orderkey")
    return j.select(
        F.col("l_shipdate").alias("task_date"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("long")).otherwise(F.col("o_orderkey")).alias("upload_id"),
        F.when(F.col("l_returnflag") == "N", "Reviewer").otherwise("Applicant").alias("group_name"),
        F.when(F.col("l_linenumber") == 6, "Review").otherwise("ApplicantUpload").alias("task_name"),
        F.when(F.col("l_linestatus") == "F", "Complete").otherwise("Pending").alias("task_status"),
        _job_class().alias("job_class"),
        _permit_types().alias("permit_types"),
    )


def inspections(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _t(spark, sf_dir, "events")
    eid, uid = F.col("event_id"), F.col("user_id")
    et = F.col("event_type")
    return e.select(
        uid.alias("cap_id"),
        (F.col("ts") + F.make_ym_interval(F.lit(0), (eid % 6).cast("int"))).alias("completed_date"),
        (F.col("ts") - F.make_dt_interval((eid % 30).cast("int"))).alias("created_date"),
        F.when(et.isin("view", "click"), "Housing").otherwise(et).alias("grp"),
        F.when(eid % 4 == 0, "Follow Up Inspection").when(eid % 4 == 1, "Follow-Up Inspection")
         .when(eid % 4 == 2, "Initial").alias("action_type"),
        F.when(eid % 6 == 0, "No Access - Left Notice").when(eid % 6 == 1, F.lit(None).cast("string"))
         .otherwise("Passed").alias("cap_status"),
        F.when(eid % 10 == 0, "Scheduled").otherwise("Completed").alias("status_des"),
        F.when(eid % 13 == 0, "3RDPARTY").when(eid % 13 == 1, F.lit(None).cast("string"))
         .otherwise("AGENCY").alias("division_code"),
        F.when(eid % 7 == 0, "Historical").when(eid % 7 == 1, F.lit(None).cast("string"))
         .otherwise("Internal").alias("inspector_group"),
        _ward(uid).alias("ward"),
        eid.alias("event_id"),
    )


ADAPTERS = {
    "address": address,
    "violations": violations,
    "class_notice": class_notice,
    "owner_points": owner_points,
    "permits": permits,
    "cap_apo": cap_apo,
    "uploads": uploads,
    "inspections": inspections,
}


def makers(spark: SparkSession, sf_dir: str) -> dict[str, Callable[[], DataFrame]]:
    """A function for each source table; together they read each parquet table once."""
    reads: dict = {}

    def maker(name: str) -> Callable[[], DataFrame]:
        def make() -> DataFrame:
            _LOCAL.reads = reads
            try:
                return as_declared(name, ADAPTERS[name](spark, sf_dir))
            finally:
                _LOCAL.reads = None
        return make

    return {name: maker(name) for name in ADAPTERS}


def load_all(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All adapter tables for one scale-factor folder."""
    return {name: make() for name, make in makers(spark, sf_dir).items()}
