"""Exact duplicates by progressive refinement, in DataFrame operations only.

Texts are equal when identical after lower-casing A-Z.

1. length: rows are counted by the byte length of their text; a length that occurs once
   cannot hold a duplicate;
2. prefix: the rows left are counted by (length, hash of the first characters);
3. full hash: only rows whose (length, prefix hash) occurs again have their whole text
   hashed (SHA-256), and equal hashes form the groups.

The first scan writes a narrow table (id, length, prefix hash).  Steps 1 and 2 work on
that table.  Step 3 must find its rows in the texts without shuffling them: the surviving
(length, prefix hash) pairs are set in a bit map of bounded size, which is broadcast and
tested per row before hashing.  A false hit of the map costs one hash and changes nothing,
since the groups are formed by the full hash.

No step collects a group: all groups are pre-aggregated per (key, salt), so a text that
makes up a third of all rows is spread over many tasks, on both sides of every join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fernwood.llm.common import SALTS, lower_ascii, maybe_among, salt_of, salted_groups, written

PREFIX_CHARS = 64


def _shape(text: Column) -> tuple[Column, Column]:
    """Byte length, and hash of the first characters, of a text (null: empty)."""
    head = lower_ascii(F.substring(text, 1, PREFIX_CHARS))
    return F.octet_length(text).cast("long"), F.xxhash64(head)


def _repeated(rows: DataFrame, keys: list[str], spread: str) -> DataFrame:
    """The rows whose ``keys`` occur more than once."""
    groups = salted_groups(rows, keys, F.col(spread), {"_n": (F.count(F.lit(1)), "sum")})
    return (rows.withColumn("_salt", salt_of(F.col(spread)))
            .join(groups.filter("_n > 1").drop("_n"), [*keys, "_salt"], "left_semi").drop("_salt"))


def candidate_rows(docs: DataFrame, text: Column, id_col: str) -> DataFrame:
    """Steps 1 and 2: (id, length, prefix hash) of the rows that may have an equal."""
    length, prefix = _shape(text)
    narrow = written(docs.select(F.col(id_col).alias("_id"), length.alias("_len"), prefix.alias("_prefix"))
                     .withColumn("_at", F.monotonically_increasing_id()), "shapes")
    by_length = _repeated(narrow, ["_len"], "_at")
    return written(_repeated(by_length, ["_len", "_prefix"], "_at").drop("_at"), "candidates")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     digest_all: bool = False) -> DataFrame:
    """One row per input row: ``id_col, keep_id, group_size, kept, text_sha256``.

    Of equal texts the row with the largest id stays.  ``text_sha256`` is the digest of the
    normalised text; it is null for rows that drop out before step 3, unless ``digest_all``
    asks for every row's digest as an output.  Null texts count as empty; rows with a null id
    take part and are kept only if no equal row has an id.  Repeated rows that share the
    largest id are the same document, and all of them are marked as kept.  An empty table
    gives an empty result; other columns are ignored, whatever their names.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    candidates = candidate_rows(docs, text, id_col)

    pairs = candidates.select("_len", "_prefix").distinct()
    length, prefix = _shape(text)
    rows = docs.select(F.col(id_col).alias("_id"), length.alias("_len"), prefix.alias("_prefix"), text.alias("_text"))
    rows, hit = maybe_among(rows, pairs, ["_len", "_prefix"], "_hit"), F.col("_hit")
    digest = F.sha2(lower_ascii(F.col("_text")), 256)
    rows = rows.select("_id", hit, (digest if digest_all else F.when(hit, digest)).alias("text_sha256"))
    rows = written(rows, "digests")

    groups = salted_groups(rows.filter("_hit"), ["text_sha256"], F.col("_id"),
                           {"keep_id": (F.max("_id"), "max"), "group_size": (F.count(F.lit(1)), "sum")})
    rows = rows.withColumns({"_salt": salt_of("_id", salts=SALTS),
                             "_key": F.when(F.col("_hit"), F.col("text_sha256"))})
    groups = groups.withColumnRenamed("text_sha256", "_key")
    out = rows.join(groups, ["_key", "_salt"], "left")
    return out.select(
        F.col("_id").alias(id_col), F.coalesce("keep_id", "_id").alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("_id").eqNullSafe(F.coalesce("keep_id", "_id")).alias("kept"), "text_sha256")
