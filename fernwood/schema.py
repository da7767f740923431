"""Fixed schemas and the label dictionary of the connection-log data set.

The 41 feature names, their order, the 40 label names and their categories
are fixed by the data set definition; they are stated here as plain values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)

# The 41 features in file order (9 basic, 13 content, 9 traffic, 10 host)
FEATURE_NAMES = [
    "duration", "protocol_type", "service", "flag", "src_bytes", "dst_bytes",
    "land", "wrong_fragment", "urgent",
    "hot", "num_failed_logins", "logged_in", "num_compromised", "root_shell",
    "su_attempted", "num_root", "num_file_creations", "num_shells",
    "num_access_files", "num_outbound_cmds", "is_host_login", "is_guest_login",
    "count", "srv_count", "serror_rate", "srv_serror_rate", "rerror_rate",
    "srv_rerror_rate", "same_srv_rate", "diff_srv_rate", "srv_diff_host_rate",
    "dst_host_count", "dst_host_srv_count", "dst_host_same_srv_rate",
    "dst_host_diff_srv_rate", "dst_host_same_src_port_rate",
    "dst_host_srv_diff_host_rate", "dst_host_serror_rate",
    "dst_host_srv_serror_rate", "dst_host_rerror_rate", "dst_host_srv_rerror_rate",
]
COLUMN_NAMES = FEATURE_NAMES + ["label", "difficulty"]
CATEGORICAL_COLUMNS = ["protocol_type", "service", "flag"]
NUMERIC_COLUMNS = [c for c in FEATURE_NAMES if c not in CATEGORICAL_COLUMNS]
DROPPABLE_COLUMNS = ["difficulty"]

# Category id order used by the 5-class task
FIVE_CATEGORIES = ["DoS", "Normal", "Probe", "R2L", "U2R"]

# Label id -> (name, category), 40 rows
LABELS = [
    (0, "apache2", "DoS"), (1, "back", "DoS"), (2, "buffer_overflow", "U2R"),
    (3, "ftp_write", "R2L"), (4, "guess_passwd", "R2L"), (5, "httptunnel", "R2L"),
    (6, "imap", "R2L"), (7, "ipsweep", "Probe"), (8, "land", "DoS"),
    (9, "loadmodule", "U2R"), (10, "mailbomb", "DoS"), (11, "mscan", "Probe"),
    (12, "multihop", "R2L"), (13, "named", "R2L"), (14, "neptune", "DoS"),
    (15, "nmap", "Probe"), (16, "normal", "Normal"), (17, "perl", "U2R"),
    (18, "phf", "R2L"), (19, "pod", "DoS"), (20, "portsweep", "Probe"),
    (21, "processtable", "DoS"), (22, "ps", "U2R"), (23, "rootkit", "U2R"),
    (24, "saint", "Probe"), (25, "satan", "Probe"), (26, "sendmail", "R2L"),
    (27, "smurf", "DoS"), (28, "snmpgetattack", "R2L"), (29, "snmpguess", "R2L"),
    (30, "spy", "R2L"), (31, "sqlattack", "U2R"), (32, "teardrop", "DoS"),
    (33, "udpstorm", "DoS"), (34, "warezclient", "R2L"), (35, "warezmaster", "R2L"),
    (36, "worm", "DoS"), (37, "xlock", "R2L"), (38, "xsnoop", "R2L"), (39, "xterm", "U2R"),
]

_INT_FEATURES = {
    "duration", "land", "wrong_fragment", "urgent", "hot", "num_failed_logins",
    "logged_in", "num_compromised", "root_shell", "su_attempted", "num_root",
    "num_file_creations", "num_shells", "num_access_files", "num_outbound_cmds",
    "is_host_login", "is_guest_login", "count", "srv_count", "dst_host_count",
    "dst_host_srv_count",
}


def connection_schema() -> StructType:
    """Explicit schema of the 43-column headerless files (types are our choice)."""
    fields = []
    for name in COLUMN_NAMES:
        if name in CATEGORICAL_COLUMNS or name == "label":
            t = StringType()
        elif name in ("src_bytes", "dst_bytes"):
            t = LongType()
        elif name in _INT_FEATURES or name == "difficulty":
            t = IntegerType()
        else:
            t = DoubleType()
        fields.append(StructField(name, t, True))
    return StructType(fields)


def columns_except(df: DataFrame, excluded) -> list[str]:
    """The columns of ``df`` that are not in ``excluded``, in order."""
    gone = set(excluded)
    return [c for c in df.columns if c not in gone]


def columns_with_prefix(df: DataFrame, prefixes) -> list[str]:
    """The columns that begin with one of ``prefixes``, in order (one-hot columns of a category)."""
    return [c for c in df.columns if c.startswith(tuple(prefixes))]


def dictionary_frames(spark: SparkSession, labels=LABELS) -> tuple[DataFrame, DataFrame]:
    """The two stored dictionaries: ``(label_id, name)`` and ``(label_id, category)``."""
    names = spark.createDataFrame([(i, n) for i, n, _ in labels], "label_id int, name string")
    cats = spark.createDataFrame([(i, c) for i, _, c in labels], "label_id int, category string")
    return names, cats


def compose_label_dim(names: DataFrame, cats: DataFrame,
                      categories: list[str] = FIVE_CATEGORIES) -> DataFrame:
    """``label_dim(label_id, name, category, category_id)``: inner join on the shared id.

    Ids present in only one dictionary are dropped, as the composed mapping does.
    """
    order = names.sparkSession.createDataFrame(
        list(enumerate(categories)), "category_id int, category string")
    return (names.join(cats, "label_id", "inner")
            .join(F.broadcast(order), "category", "left")
            .select("label_id", "name", "category", "category_id"))


def read_id_dictionary(spark: SparkSession, path: str, value: str) -> DataFrame:
    """``(label_id int, <value> string)`` from a JSON object file ``{"0": "name", ...}``."""
    text = spark.read.text(path, wholetext=True)
    entries = F.from_json("value", "map<string,string>", {"mode": "FAILFAST"})
    return text.select(F.explode(entries).alias("k", "v")).select(
        F.col("k").cast("int").alias("label_id"), F.col("v").alias(value))
