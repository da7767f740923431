"""Data sets, models and metrics on storage.

Everything is Parquet/JSON written by Spark (parent folders are created by
the writer); a missing path surfaces as ``AnalysisException`` naming it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TASKS = ("binary", "multiclass")


def save_dataset(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Overwrite ``path`` with ``df`` as Parquet."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def load_dataset(spark: SparkSession, path: str) -> DataFrame:
    """Read a saved data set; a missing path raises with the path in the message."""
    return spark.read.parquet(path)


def save_prepared(frames: dict[str, DataFrame], path: str, task: str) -> None:
    """A10: ``{split: frame}`` of one task into one data set partitioned by ``(task, split)``.

    Only the partitions being written are replaced (dynamic overwrite), so the
    binary and multiclass sets live side by side.
    """
    if task not in TASKS:
        raise ValueError(f"unknown task {task!r}; expected one of {TASKS}")
    parts = [f.withColumn("task", F.lit(task)).withColumn("split", F.lit(s)) for s, f in frames.items()]
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p, allowMissingColumns=True)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("task", "split").parquet(path)


def load_prepared(spark: SparkSession, path: str, task: str, split: str) -> DataFrame:
    """One ``(task, split)`` slice; partition pruning reads only that folder."""
    if task not in TASKS:
        raise ValueError(f"unknown task {task!r}; expected one of {TASKS}")
    return spark.read.parquet(path).where((F.col("task") == task) & (F.col("split") == split))


def save_model(model: PipelineModel, path: str) -> None:
    """Overwrite a fitted pipeline."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Load a fitted pipeline (a missing path raises)."""
    return PipelineModel.load(path)


def save_models(models: dict, folder: str) -> list[str]:
    """Save each named model under ``folder/name``; ``None`` entries are skipped.

    Returns the names actually saved.
    """
    saved = []
    for name, m in models.items():
        if m is None:
            continue
        save_model(m, f"{folder.rstrip('/')}/{name}")
        saved.append(name)
    return saved


METRICS_SCHEMA = "model string, task string, metric string, class_id int, value double"


_MANIFESTS = "_commits"


def _files(spark: SparkSession, path: str):
    """The file system of ``path`` and a maker of paths on it."""
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, lambda *parts: jvm.org.apache.hadoop.fs.Path("/".join([path.rstrip("/"), *parts]))


def _last_commit(spark: SparkSession, path: str) -> tuple[int, dict]:
    """Number and content of the newest manifest, ``(0, {})`` where there is none."""
    fs, at = _files(spark, path)
    if not fs.exists(at(_MANIFESTS)):
        return 0, {}
    numbers = [int(f.getPath().getName()) for f in fs.listStatus(at(_MANIFESTS)) if f.getPath().getName().isdigit()]
    if not numbers:
        return 0, {}
    stream = fs.open(at(_MANIFESTS, str(max(numbers))))
    try:
        return max(numbers), json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _commit(spark: SparkSession, path: str, number: int, content: dict) -> None:
    """Put manifest ``number`` in place by one rename; fails where another writer has been faster."""
    fs, at = _files(spark, path)
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    fs.mkdirs(at(_MANIFESTS))
    draft, final = at(_MANIFESTS, f"draft-{uuid.uuid4().hex}"), at(_MANIFESTS, str(number))
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    none = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context.rename(draft, final, none)


def _write_version(metrics: DataFrame, path: str, fmt: str) -> str:
    version = f"v-{uuid.uuid4().hex}"
    metrics.select("model", "task", "metric", "class_id", "value").write.partitionBy("model").format(fmt).save(
        f"{path.rstrip('/')}/{version}")
    return version


def _models_in(spark: SparkSession, path: str, version: str, fmt: str) -> list[str]:
    """The models of a version, one row each."""
    read = spark.read.schema(METRICS_SCHEMA).format(fmt).load(f"{path.rstrip('/')}/{version}")
    return [r["model"] for r in read.select("model").distinct().collect()]


def write_metrics(metrics: DataFrame, path: str, fmt: str = "json") -> None:
    """Long metrics table, one folder per model, in place of what the store held.

    The rows go into a folder of their own; readers see them when the manifest that names it is
    in place.  A writer that fails before leaves the store as it was.
    """
    spark = metrics.sparkSession
    number, _ = _last_commit(spark, path)
    version = _write_version(metrics, path, fmt)
    _commit(spark, path, number + 1, {"models": {m: version for m in _models_in(spark, path, version, fmt)}})


def read_metrics(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """The rows that the newest manifest names."""
    number, content = _last_commit(spark, path)
    if not number:
        raise ValueError(f"no metrics store at {path}")
    versions: dict[str, list[str]] = {}
    for model, version in content["models"].items():
        versions.setdefault(version, []).append(model)
    out = spark.createDataFrame([], METRICS_SCHEMA)
    for version, models in sorted(versions.items()):
        rows = spark.read.schema(METRICS_SCHEMA).format(fmt).load(f"{path.rstrip('/')}/{version}")
        out = out.unionByName(rows.where(F.col("model").isin(models)))
    return out.select("model", "task", "metric", "class_id", "value")


def upsert_metrics(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Replace every stored row of the models present in ``new``; keep the rest."""
    models = new.select("model").distinct()
    return stored.join(models, "model", "left_anti").unionByName(new)


def upsert_stored_metrics(spark: SparkSession, path: str, new: DataFrame, fmt: str = "parquet",
                          most_versions: int = 32) -> None:
    """The same in the store itself.

    The new rows are a version of their own, and the next manifest names it for their models; the
    other models keep theirs.  With more than ``most_versions`` in use all rows are written into one.
    """
    number, content = _last_commit(spark, path)
    version = _write_version(new, path, fmt)
    models = content.get("models", {}) | {m: version for m in _models_in(spark, path, version, fmt)}
    _commit(spark, path, number + 1, {"models": models})
    if len(set(models.values())) > most_versions:
        write_metrics(read_metrics(spark, path, fmt), path, fmt)
