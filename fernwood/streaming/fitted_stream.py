"""Apply fitted, row-local transforms to a stream.

Fitted scaling, clipping, log1p and one-hot are narrow projections with
literals, so the same functions run on a streaming DataFrame.  The stream is
read from Parquet files, transformed, and written with a checkpoint in the
shared folder; ``availableNow`` processes what is there and stops.

Ordinal encoding is not row-local: values not seen before get ids appended to the
vocabulary.  :func:`encode_stream` keeps a snapshot of the vocabulary per micro-batch, so a batch
that is run again after a failure starts from the same one and writes the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fernwood.operators.encode import Vocabulary, ordinal_transform
from fernwood.session import scratch_path


def transform_stream(spark: SparkSession, folder: str, schema: StructType, glob: str,
                     transform: Callable[[DataFrame], DataFrame], max_files: int = 1000) -> DataFrame:
    """Run ``transform`` over the files of ``folder`` matching ``glob`` as a stream; return the output."""
    src = (spark.readStream.schema(schema).option("pathGlobFilter", glob)
           .option("maxFilesPerTrigger", max_files).parquet(folder))
    out_path = scratch_path(spark, "stream-out")
    q = (transform(src).writeStream.format("parquet")
         .option("checkpointLocation", scratch_path(spark, "stream-ckpt"))
         .outputMode("append").trigger(availableNow=True).start(out_path))
    q.awaitTermination()
    return spark.read.parquet(out_path)


def encode_stream(spark: SparkSession, folder: str, schema: StructType, glob: str, vocab: Vocabulary, cols: Sequence[str],
                  prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
                  finish: Callable[[DataFrame], DataFrame] = lambda df: df, max_files: int = 1000) -> tuple[DataFrame, Vocabulary]:
    """Ordinal ids for the columns ``cols`` of a stream; unseen values are appended batch by batch.

    ``prepare`` shapes a micro-batch before, ``finish`` applies whatever is row-local after it
    (one-hot, clipping, log1p, ``model.transform``).  Returns the output and the vocabulary that
    the last batch left: the same as encoding the batches one after the other.
    """
    out_path, vocab_path = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-vocabulary")

    def snapshot(number: int) -> Vocabulary:
        """What batch ``number`` left; the fitted vocabulary before the first."""
        if number < 0:
            return vocab
        table = spark.read.parquet(f"{vocab_path}/{number}")
        sizes = {r["feature"]: r["n"] for r in table.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
        return Vocabulary(table, {c: sizes.get(c, 0) for c in vocab.sizes})

    last = [-1]

    def batch(df: DataFrame, number: int) -> None:
        rows = prepare(df).persist()
        try:
            encoded, grown = ordinal_transform(rows, snapshot(number - 1), cols)
            grown.table.write.mode("overwrite").parquet(f"{vocab_path}/{number}")
            finish(encoded).write.mode("overwrite").parquet(f"{out_path}/batch={number}")
        finally:
            rows.unpersist()
        last[0] = number

    q = (spark.readStream.schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", max_files).parquet(folder)
         .writeStream.foreachBatch(batch).option("checkpointLocation", scratch_path(spark, "stream-ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if last[0] < 0:  # no file, no batch
        return finish(ordinal_transform(prepare(spark.createDataFrame([], schema)), vocab, cols)[0]), vocab
    return spark.read.parquet(out_path).drop("batch"), snapshot(last[0])
