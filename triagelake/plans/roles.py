"""The given tables in the parts the operators need (Spark side and SQL side of the same thing)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table dealt evenly over all cores, where a row is much work: a small file is one split, thus one task."""
    return table(spark, sf_dir, name).repartition(max(32, 2 * spark.sparkContext.defaultParallelism))


# --- sessions: events of one user on one day ------------------------------------------------

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")

SESSIONS_SQL = """sess AS (
  SELECT concat_ws('_', user_id, strftime(ts, '%Y-%m-%d')) AS session_id, ts, event_id,
         event_type AS state, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS hit
  FROM events)"""


def session_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.concat_ws("_", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("session_id"),
        "ts", "event_id", F.col("event_type").alias("state"),
        F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("hit"),
    )


# --- honeypot log: the same events with log-style ids, messages, stamps and protocols -------

LOG_IDS = (
    "pot.session.connect", "pot.client.version", "pot.client.fingerprint", "pot.login.failed",
    "pot.login.success", "pot.command.success", "pot.command.failed", "pot.session.file_download",
    "pot.direct-tcpip.request", "pot.session.closed", "pot.log.open",
)

LOG_SQL = f"""log AS (
  SELECT concat_ws('_', user_id, strftime(ts, '%Y-%m-%d')) AS session_id, event_id AS pos,
         list_extract({list(LOG_IDS)}, (event_id % {len(LOG_IDS)} + 1)::INT) AS eventid,
         CASE event_id % 4 WHEN 0 THEN 'CMD:  ' || event_type || ';' || props
              WHEN 1 THEN event_type || ' -x ' || props WHEN 2 THEN 'CMD: ; ' || props END AS message,
         CASE WHEN event_id % 9 = 4 THEN NULL ELSE ts END AS stamp,
         CASE event_id % 3 WHEN 0 THEN 'telnet' WHEN 1 THEN 'ssh' END AS protocol
  FROM events)"""


def honeypot_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    i = F.col("event_id")
    ids = F.array(*[F.lit(x) for x in LOG_IDS])
    return e.select(
        F.concat_ws("_", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("session_id"),
        i.alias("pos"),
        F.get(ids, (i % len(LOG_IDS)).cast("int")).alias("eventid"),
        F.when(i % 4 == 0, F.concat(F.lit("CMD:  "), "event_type", F.lit(";"), "props"))
        .when(i % 4 == 1, F.concat("event_type", F.lit(" -x "), "props"))
        .when(i % 4 == 2, F.concat(F.lit("CMD: ; "), "props")).alias("message"),
        F.when(i % 9 == 4, "not a time")
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("timestamp"),
        F.when(i % 3 == 0, "telnet").when(i % 3 == 1, "ssh").alias("protocol"),
    )


# --- dependency DAG: part p depends on p div 2 and p div 3 ----------------------------------

DAG_SQL = """nodes AS (SELECT p_partkey AS node FROM part),
edges AS (
  SELECT DISTINCT src, dst FROM (
    SELECT p_partkey AS src, p_partkey // 2 AS dst FROM part WHERE p_partkey >= 1
    UNION ALL SELECT p_partkey, p_partkey // 3 FROM part WHERE p_partkey >= 1) t)"""


def dag(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    p = table(spark, sf_dir, "part").select("p_partkey")
    nodes = p.select(F.col("p_partkey").alias("node"))
    halves = F.explode(F.array(F.floor(F.col("p_partkey") / 2), F.floor(F.col("p_partkey") / 3)))
    edges = p.where("p_partkey >= 1").select(F.col("p_partkey").alias("src"), halves.alias("dst")).distinct()
    return nodes, edges


# --- bipartite incidence: customers and the brands they returned ----------------------------

INCIDENCE_SQL = """inc AS (
  SELECT DISTINCT o_custkey AS row_id, p_brand AS col_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  WHERE l_returnflag = 'R')"""


def incidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select("l_orderkey", "l_partkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return (
        li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
        .select(F.col("o_custkey").alias("row_id"), F.col("p_brand").alias("col_id")).distinct()
    )


# --- check facts: mean order price per customer and priority, with sentinels ----------------

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")

CHECKS_SQL = """checks AS (
  SELECT o_custkey AS repository, o_orderpriority AS name,
         CASE WHEN o_custkey % 7 = 0 AND o_orderpriority = '5-LOW' THEN -1.0::DOUBLE
              ELSE avg(o_totalprice) END AS score
  FROM orders GROUP BY o_custkey, o_orderpriority)"""


def checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.groupBy(F.col("o_custkey").alias("repository"), F.col("o_orderpriority").alias("name")).agg(
        F.avg("o_totalprice").alias("_mean")
    ).select(
        "repository", "name",
        F.when((F.col("repository") % 7 == 0) & (F.col("name") == "5-LOW"), -1.0)
        .otherwise(F.col("_mean")).alias("score"),
    )


# --- labelled scores: document length and line count against the toxic label ----------------

SCORED_SQL = """scored AS (
  SELECT d.doc_id, l.toxic AS y, l.quality,
         (d.n_chars // 50)::DOUBLE AS advanced, (d.doc_id * 7919 % 101)::DOUBLE AS baseline
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return labels.join(docs, "doc_id").select(
        "doc_id", F.col("toxic").alias("y"), "quality",
        F.floor(F.col("n_chars") / 50).cast("double").alias("advanced"),
        (F.col("doc_id") * 7919 % 101).cast("double").alias("baseline"),
    )
