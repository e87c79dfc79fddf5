"""Network flow partitions: header-less CSV with 43 fixed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triagelake.functions.scalars import attack_family, binary_label, clean_name

# The columns of the flow benchmark in file order.
COLUMNS = (
    "duration", "protocol_type", "service", "flag", "src_bytes", "dst_bytes",
    "land", "wrong_fragment", "urgent", "hot", "num_failed_logins",
    "logged_in", "num_compromised", "root_shell", "su_attempted", "num_root",
    "num_file_creations", "num_shells", "num_access_files", "num_outbound_cmds",
    "is_host_login", "is_guest_login", "count", "srv_count", "serror_rate",
    "srv_serror_rate", "rerror_rate", "srv_rerror_rate", "same_srv_rate",
    "diff_srv_rate", "srv_diff_host_rate", "dst_host_count", "dst_host_srv_count",
    "dst_host_same_srv_rate", "dst_host_diff_srv_rate",
    "dst_host_same_src_port_rate", "dst_host_srv_diff_host_rate",
    "dst_host_serror_rate", "dst_host_srv_serror_rate", "dst_host_rerror_rate",
    "dst_host_srv_rerror_rate", "attack_name", "difficulty",
)
CATEGORICAL = ("protocol_type", "service", "flag")
FEATURE_COLUMNS = tuple(c for c in COLUMNS if c not in ("attack_name", "difficulty"))


def _kind(name: str) -> T.DataType:
    if name in CATEGORICAL or name == "attack_name":
        return T.StringType()
    if name.endswith("_rate"):
        return T.DoubleType()
    return T.IntegerType() if name == "difficulty" else T.LongType()


FLOW_SCHEMA = T.StructType([T.StructField(c, _kind(c)) for c in COLUMNS])


def labelled_flows(flows: DataFrame) -> DataFrame:
    """Cleaned attack name, 0/1 label and attack family added."""
    return flows.withColumns({
        "label": binary_label("attack_name"),
        "attack_family": attack_family("attack_name"),
        "attack_name": clean_name("attack_name"),
    })


def read_flows(spark: SparkSession, path: str) -> DataFrame:
    """Flow files with the fixed schema; a malformed row fails the job."""
    return labelled_flows(spark.read.schema(FLOW_SCHEMA).csv(path, mode="FAILFAST"))


def parse_flows(lines: DataFrame) -> DataFrame:
    """The same from rows with one CSV line in ``value``; other columns are kept."""
    parsed = lines.select(
        *[c for c in lines.columns if c != "value"],
        F.from_csv("value", FLOW_SCHEMA.simpleString()[7:-1].replace(":", " "), {"mode": "FAILFAST"}).alias("f"))
    return labelled_flows(parsed.select("*", "f.*").drop("f"))
