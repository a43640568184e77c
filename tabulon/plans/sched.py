"""A timetable-shaped relation over the star-schema tables, for queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAYS = ("Понеділок", "Вівторок", "Середа", "Четвер", "П'ятниця", "Субота")
STARTS = ("08:00", "09:30", "11:00", "12:30", "14:00")
ENDS = ("09:20", "10:50", "12:20", "13:50", "15:20")
#: The seven columns that order rows wholly.
ORDER = ("k1", "k2", "k3", "k4", "k5", "k6", "k7")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One schedule row per lineitem; blanks are empty strings, as in exported tables.

    The dimension joins carry no hints: the optimizer broadcasts what its size
    estimate allows and sort-merges the rest.
    """
    t = lambda name: read(spark, sf_dir, name)
    pick = lambda values, i: F.element_at(F.array(*map(F.lit, values)), i)
    orders = (
        t("orders").select("o_orderkey", "o_custkey")
        .join(t("customer").select("c_custkey", "c_nationkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    joined = (  # an order meets its customer before its lines meet it: lines are not shuffled by customer
        t("lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t("part").select("p_partkey", "p_name", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
        .join(t("supplier").select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    slot = (F.col("l_suppkey") % 5 + 1).cast("int")
    bare = F.col("l_discount") < 0.02
    return joined.select(
        F.concat(F.lit("src-"), F.col("n_regionkey").cast("string")).alias("source_name"),
        F.col("n_name").alias("faculty"), F.col("c_mktsegment").alias("program"),
        F.when(F.col("l_linenumber") >= 7, "").otherwise(pick(DAYS, F.least("l_linenumber", F.lit(6)))).alias("day"),
        pick(STARTS, slot).alias("start_time"),
        F.when(F.col("l_quantity") > 47, "").otherwise(pick(ENDS, slot)).alias("end_time"),
        F.when(F.col("l_quantity") < 3, "").otherwise(F.col("p_name")).alias("subject"),
        F.col("o_custkey").alias("doc"), F.concat(F.lit("pdf-"), "l_returnflag").alias("sheet_name"),
        F.when(bare, "").otherwise(F.col("s_name")).alias("teacher"),
        F.when(bare, "").otherwise(F.concat(F.lit("ауд. "), F.col("p_size").cast("string"))).alias("room"),
        F.when(F.col("l_returnflag") == "A", "лекція").when(F.col("l_returnflag") == "R", "семінар").otherwise("").alias("lesson_type"),
        F.when(F.col("l_linestatus") == "O", "Верхній").otherwise("Обидва").alias("week_type"),
        (F.col("l_linenumber") % 4 + 1).cast("string").alias("course"),
        F.concat(F.lit("G-"), ((F.col("o_custkey") + F.col("l_linenumber")) % 3).cast("string")).alias("groups"),
        F.col("l_orderkey").alias("k1"), F.col("l_linenumber").alias("k2"), F.col("l_partkey").alias("k3"), F.col("l_suppkey").alias("k4"),
        F.col("l_quantity").alias("k5"), F.col("l_extendedprice").alias("k6"), F.col("l_shipdate").alias("k7"),
    )


def _case(values, index):
    return "CASE " + index + " " + " ".join("WHEN {} THEN '{}'".format(i + 1, v.replace("'", "''")) for i, v in enumerate(values)) + " END"


SCHED_SQL = f"""sched AS (
  SELECT 'src-' || n_regionkey AS source_name, n_name AS faculty, c_mktsegment AS program,
    CASE WHEN l_linenumber >= 7 THEN '' ELSE {_case(DAYS, 'l_linenumber')} END AS day,
    {_case(STARTS, '(l_suppkey % 5 + 1)')} AS start_time,
    CASE WHEN l_quantity > 47 THEN '' ELSE {_case(ENDS, '(l_suppkey % 5 + 1)')} END AS end_time,
    CASE WHEN l_quantity < 3 THEN '' ELSE p_name END AS subject,
    o_custkey AS doc, 'pdf-' || l_returnflag AS sheet_name,
    CASE WHEN l_discount < 0.02 THEN '' ELSE s_name END AS teacher,
    CASE WHEN l_discount < 0.02 THEN '' ELSE 'ауд. ' || p_size END AS room,
    CASE l_returnflag WHEN 'A' THEN 'лекція' WHEN 'R' THEN 'семінар' ELSE '' END AS lesson_type,
    CASE WHEN l_linestatus = 'O' THEN 'Верхній' ELSE 'Обидва' END AS week_type,
    (l_linenumber % 4 + 1)::VARCHAR AS course, 'G-' || ((o_custkey + l_linenumber) % 3) AS groups,
    l_orderkey AS k1, l_linenumber AS k2, l_partkey AS k3, l_suppkey AS k4, l_quantity AS k5, l_extendedprice AS k6, l_shipdate AS k7
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""
