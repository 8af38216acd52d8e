"""Relational / profile / reshape group on lineitem, orders, customer, part, embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.operators import relational as rel
from orrery.plans.common import rnd
from orrery.sources import files
from orrery.sources.tables import TABLES, Tables

LI_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
           "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
DISTINCT_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag",
                 "l_linestatus", "l_shipdate"]


def q_prefix_filter(spark, sf):
    p = Tables(spark, sf).part
    return rel.prefix_filter(p, "p_type", "S", "p_brand", "Brand#13").select(
        "p_partkey", "p_type", "p_brand")


def q_row_slice(spark, sf):
    li = Tables(spark, sf).lineitem.select(*LI_KEY, "l_quantity")
    return rel.row_slice(li, LI_KEY, 10000, 20000)


def q_null_profile(spark, sf):
    return rel.null_profile(Tables(spark, sf).lineitem, LI_COLS)


def q_row_counts(spark, sf):
    t = Tables(spark, sf)
    return rel.stack_frames([rel.shape(getattr(t, n), n) for n in TABLES])


def q_distinct_counts(spark, sf):
    return rel.distinct_counts(Tables(spark, sf).lineitem, DISTINCT_COLS)


def q_class_share(spark, sf):
    e = Tables(spark, sf).embeddings
    return rel.class_share(e, "label").select("label", "n", rnd("pct", 6).alias("pct"))


def q_describe_exact(spark, sf):
    d = rel.describe_exact(Tables(spark, sf).lineitem, NUM)
    return d.select("column_name", "count", *[rnd(c, 4).alias(c) for c in
                                              ["mean", "std", "min", "q25", "q50", "q75", "max"]])


def q_group_mean_se(spark, sf):
    li = Tables(spark, sf).lineitem
    r = rel.mean_se(li, "l_extendedprice", [["l_returnflag"], ["l_linestatus"],
                                             ["l_returnflag", "l_linestatus"]],
                    ["l_returnflag", "l_linestatus"])
    return r.select("l_returnflag", "l_linestatus", F.col("gid").cast("int").alias("gid"), "n",
                    rnd("mean", 4).alias("mean"), rnd("sd", 4).alias("sd"), rnd("se", 4).alias("se"))


def q_argmin_row(spark, sf):
    li = Tables(spark, sf).lineitem
    return rel.argmin_row(li, ["l_returnflag"], "l_extendedprice", LI_KEY,
                          ["l_orderkey", "l_linenumber", "l_extendedprice"])


def q_group_mean_all(spark, sf):
    li = Tables(spark, sf).lineitem
    g = rel.group_mean_all(li, ["l_returnflag", "l_linestatus"], NUM)
    return g.select("l_returnflag", "l_linestatus", *[rnd(f"mean_{c}", 6).alias(f"mean_{c}") for c in NUM])


def q_unpivot_metrics(spark, sf):
    li = Tables(spark, sf).lineitem
    wide = li.groupBy("l_returnflag").agg(
        rnd(F.sum("l_quantity"), 2).alias("sum_qty"),
        rnd(F.avg("l_extendedprice"), 4).alias("avg_price"),
        rnd(F.avg("l_discount"), 6).alias("avg_disc"))
    return rel.unpivot_long(wide, ["l_returnflag"], ["sum_qty", "avg_price", "avg_disc"])


def q_dense_codes(spark, sf):
    p = Tables(spark, sf).part
    return rel.dense_codes(p, "p_brand", "p_partkey").withColumnRenamed("_first", "first_key")


def expand_input(spark, sf):
    li = Tables(spark, sf).lineitem
    return li.groupBy("l_returnflag", "l_linestatus", "l_linenumber").agg(
        F.count(F.lit(1)).alias("conducted"), F.count_if(F.col("l_discount") >= 0.05).alias("passed"))


def q_expand_counts(spark, sf):
    return rel.expand_counts(expand_input(spark, sf), ["l_returnflag", "l_linestatus", "l_linenumber"],
                             "conducted", "passed")


CUST = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
CUST_SCHEMA = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


def q_csv_roundtrip(spark, sf):
    """customer → ';'-separated CSV with header in the shared scratch folder →
    read back with an explicit schema, multi-line and trimming on."""
    c = Tables(spark, sf).customer.select(*CUST)
    path = files.write_csv(c, files.scratch_path(spark, "csv_roundtrip"), sep=";")
    return files.read_csv(spark, path, CUST_SCHEMA, sep=";", multiline=True)


def q_first_rows(spark, sf):
    """First 10 rows under the lineitem key order: a bounded top-k (TakeOrdered)."""
    li = Tables(spark, sf).lineitem.select(*LI_KEY, "l_quantity", "l_extendedprice")
    return li.orderBy(*LI_KEY).limit(10)


# The order priorities and states of the table.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
STATES = ["F", "O", "P"]


def q_transpose_grid(spark, sf):
    """Counts by priority (rows) and state (columns), then by state and priority."""
    o = Tables(spark, sf).orders
    grid = o.groupBy("o_orderpriority").pivot("o_orderstatus", STATES).agg(F.count(F.lit(1)))
    return rel.transpose(grid, "o_orderpriority", STATES, PRIORITIES, "state")


QUERIES = {
    "transpose_grid": q_transpose_grid,
    "first_rows": q_first_rows,
    "prefix_filter": q_prefix_filter,
    "row_slice": q_row_slice,
    "null_profile": q_null_profile,
    "row_counts": q_row_counts,
    "distinct_counts": q_distinct_counts,
    "class_share": q_class_share,
    "describe_exact": q_describe_exact,
    "group_mean_se": q_group_mean_se,
    "argmin_row": q_argmin_row,
    "group_mean_all": q_group_mean_all,
    "unpivot_metrics": q_unpivot_metrics,
    "dense_codes": q_dense_codes,
    "expand_counts": q_expand_counts,
    "csv_roundtrip": q_csv_roundtrip,
}

_TABLE_NCOLS = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6,
                "lineitem": 11, "events": 6, "documents": 5, "embeddings": 3, "pages": 3,
                "benchmark": 2, "labels": 3, "conversations": 4}

_desc = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean,
  round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min,
  round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50,
  round(quantile_cont({c}, 0.75), 4) AS q75, round(max({c}), 4) AS max FROM lineitem""" for c in NUM)

ORACLE = {
    "transpose_grid": "SELECT o_orderstatus AS state, " + ", ".join(
        f"""nullif(count(*) FILTER (WHERE o_orderpriority = '{p}'), 0) AS "{p}\"""" for p in PRIORITIES) + " FROM orders GROUP BY 1",
    "first_rows": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem
ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 10""",
    "prefix_filter": """SELECT p_partkey, p_type, p_brand FROM part
WHERE starts_with(p_type, 'S') AND p_brand <> 'Brand#13'""",
    "row_slice": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, row_pos FROM (
  SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS row_pos
  FROM lineitem) WHERE row_pos >= 10000 AND row_pos < 20000""",
    "null_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null, count(*) AS n_rows FROM lineitem"
        for c in LI_COLS),
    "row_counts": " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS n_rows, CAST({_TABLE_NCOLS[n]} AS BIGINT) AS n_cols FROM {n}"
        for n in TABLES),
    "distinct_counts": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM lineitem" for c in DISTINCT_COLS),
    "class_share": """SELECT label, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct
FROM embeddings GROUP BY label""",
    "describe_exact": _desc,
    "group_mean_se": """SELECT l_returnflag, l_linestatus, CAST(GROUPING(l_returnflag, l_linestatus) AS INTEGER) AS gid,
  count(l_extendedprice) AS n, round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS sd,
  round(stddev_samp(l_extendedprice) / sqrt(count(l_extendedprice)), 4) AS se
FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), (l_returnflag, l_linestatus))""",
    "argmin_row": """SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_returnflag
     ORDER BY l_extendedprice, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem) WHERE rn = 1""",
    "group_mean_all": "SELECT l_returnflag, l_linestatus, " + ", ".join(
        f"round(avg({c}), 6) AS mean_{c}" for c in NUM) + " FROM lineitem GROUP BY 1, 2",
    "unpivot_metrics": """WITH w AS (SELECT l_returnflag, round(sum(l_quantity), 2) AS sum_qty,
  round(avg(l_extendedprice), 4) AS avg_price, round(avg(l_discount), 6) AS avg_disc FROM lineitem GROUP BY 1)
SELECT l_returnflag, 'sum_qty' AS metric, sum_qty AS value FROM w
UNION ALL SELECT l_returnflag, 'avg_price', avg_price FROM w
UNION ALL SELECT l_returnflag, 'avg_disc', avg_disc FROM w""",
    "dense_codes": """SELECT p_brand, first_key, CAST(row_number() OVER (ORDER BY first_key, p_brand) - 1 AS BIGINT) AS code
FROM (SELECT p_brand, min(p_partkey) AS first_key FROM part GROUP BY 1)""",
    "expand_counts": """WITH a AS (SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS conducted,
   count(*) FILTER (WHERE l_discount >= 0.05) AS passed FROM lineitem GROUP BY 1, 2, 3)
SELECT l_returnflag, l_linestatus, l_linenumber, 1 AS result FROM (
  SELECT *, unnest(range(passed)) AS i FROM a)
UNION ALL
SELECT l_returnflag, l_linestatus, l_linenumber, 0 AS result FROM (
  SELECT *, unnest(range(conducted - passed)) AS i FROM a)""",
    "csv_roundtrip": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
}
