"""One thin query per operator over the driver tables, with production parameters.

``queries()`` and ``oracle_sql()`` are read by ``__spark_entry__.py``.  Every query reads
its whole table and whole texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fernwood.sources.tables import table

TOKENIZERS = "/opt/tokenizers"

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(fn):
        _QUERIES[fn.__name__] = fn
        if sql:
            _SQL[fn.__name__] = sql
        return fn
    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return _QUERIES | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


@_query()
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and unigram tokens of every document."""
    from fernwood.llm.token_count import token_counts

    return token_counts(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/piece_bpe_32k.model")


_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@_query(f"""
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256({_FOLDED}) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY {_FOLDED})
""")
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts (A-Z folded); of each the largest doc_id stays."""
    from fernwood.llm.exact_dedup import exact_duplicates

    return exact_duplicates(table(spark, sf_dir, "documents"), digest_all=True).withColumn(
        "group_size", F.col("group_size").cast("long"))


@_query()
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in documents: verified, substitution-tolerant overlaps."""
    from fernwood.llm.decontaminate import contaminated_passages

    return contaminated_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query()
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, with its source's words and target."""
    from fernwood.llm.mixing import mixed_amounts

    return mixed_amounts(table(spark, sf_dir, "documents"))


@_query()
def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as packed rows of token ids."""
    from fernwood.llm.packing import packed_rows

    return packed_rows(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.tiktoken")


@_query()
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: counts and digest of the base spans, and all spans."""
    from fernwood.llm.secrets import secret_spans, span_digest

    return span_digest(secret_spans(table(spark, sf_dir, "documents")), ("assign", "access", "hex"))


@_query()
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the rows that are not held out."""
    from fernwood.llm.byte_cnn import quality_scores

    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: the rules that the task fixes
URL_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
             ("allow", "org", "/fr/"))


@_query()
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's url: by rule, else by segmented words and naive Bayes."""
    from fernwood.llm.url_filter import url_verdicts

    return url_verdicts(table(spark, sf_dir, "pages"), URL_RULES)


@_query()
def op6_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose 2-word shingle sets are linked at a Jaccard of 0.8 or more."""
    from fernwood.llm.near_dup import near_duplicate_groups

    return near_duplicate_groups(table(spark, sf_dir, "documents"), size=2)


@_query()
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and digest of the base spans, and all spans."""
    from fernwood.llm.pii import personal_data, span_digest

    return span_digest(personal_data(table(spark, sf_dir, "documents")))


@_query()
def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two vocabularies in every document."""
    from fernwood.llm.token_align import alignment_summary

    return alignment_summary(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json",
                             f"{TOKENIZERS}/piece_bpe_32k.model")


@_query()
def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and verdict of the boosted trees for every document."""
    from fernwood.llm.quality_trees import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query()
def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and the cheapest repair of every conversation after fixed damage."""
    from fernwood.llm.turn_repair import damaged, repair_report

    conversations = table(spark, sf_dir, "conversations")
    return repair_report(conversations, damaged(conversations))
