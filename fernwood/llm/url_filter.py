"""URL verdicts: rules first, then word segmentation and multinomial naive Bayes.

1. A url is cut into host (A-Z folded) and path; the rules of the caller are tried, the
   longest that fits decides.
2. Unigram model: how often each word (run of letters of any script, lower-cased) occurs in
   the text of all pages.
3. Names: the letter runs of hosts and paths, percent-decoded and lower-cased (digit runs
   become ``0``).  Every distinct name is split by unigram Viterbi: of all ways to cut it, the
   one with the highest product of word probabilities; a run of ``n`` letters that is no known
   word has the probability ``1 / (N * 10^(n-1))`` with ``N`` the number of words counted.
   Words of any length count: those of more than ``anchor`` letters are found by their first
   ``anchor`` letters and then compared whole.
4. Naive Bayes: pages decided by a rule are the labelled ones.  A host counts once for each of
   its words, shared between the verdicts as its labelled pages with the word are, so that a
   large host is one witness and not thousands.  The caller's seed words are pseudo-counts:
   ``seed_weight`` each, or more where needed to be ``seed_share`` of all that is counted for
   their verdict, so that their odds do not fade as the table grows; every word has one more.
   Words that the rules themselves name, and one or two letters a-z (mostly language codes),
   are no evidence.  A page that no rule decides is blocked when the sum of its words' log
   odds is above ``margin``.

Names and words are joined as rows, so neither the unigram model nor the classifier has to
fit in a task; frequent names and words are spread over sub-keys.  Only the sums of counts
come to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fernwood.llm.common import lower_ascii, salted_lookup, written

#: (verdict, host, path prefix)
Rule = tuple[str, str, str]
BLOCK_SEEDS = ("adult", "ads", "bet", "bets", "casino", "cheap", "farm", "gambling", "loan", "malware", "phishing",
               "pills", "poker", "porn", "slots", "spam", "track", "viagra", "warez", "win", "xxx")
ALLOW_SEEDS = ("article", "blog", "docs", "edu", "forum", "help", "journal", "library", "mail", "museum", "news",
               "paper", "recipe", "school", "science", "university", "weather", "wiki", "www")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits (of equal length: the first), else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, on, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == on) | host.endswith("." + on)) & path.startswith(prefix)
        name = F.when(fits, F.lit(on + prefix)).otherwise(name)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


#: a letter run; marks belong to the letter before them
_LETTERS = r"\p{L}[\p{L}\p{M}]*+"


def names_of(text: Column) -> Column:
    """The lower-case letter runs of a host or path in order; a digit run is ``0``.

    Percent signs are decoded; a text where they are malformed is read as it stands.
    """
    plain = F.lower(F.coalesce(F.try_url_decode(text), text))
    return F.regexp_extract_all(F.regexp_replace(plain, "[0-9]+", "0"), F.lit(_LETTERS + "|0"), 0)


def unigram_counts(texts: DataFrame, text_col: str) -> DataFrame:
    """``(word, n)``: how often each word of two letters and more occurs outside of tags."""
    plain = F.regexp_replace(F.lower(F.coalesce(F.col(text_col), F.lit(""))), "<[^>]*+>", " ")
    words = F.explode(F.regexp_extract_all(plain, F.lit(_LETTERS), 0)).alias("word")
    return (texts.select(words).filter(F.length("word") >= 2)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def best_split(name: str, edges: list[tuple[int, int, int]], total: float) -> list[str]:
    """Unigram Viterbi of one name; ``edges`` are (start, length, count) of its known words."""
    known: dict[int, list[tuple[int, float]]] = {}
    for start, length, n in edges:
        known.setdefault(start + length, []).append((start, math.log(n / total)))
    score, back = [0.0], [0]
    run, begun = -math.inf, 0  # best score that ends inside an unknown run, and where that run began
    for end in range(1, len(name) + 1):
        run -= math.log(10)
        if (fresh := score[end - 1] - math.log(total)) > run:
            run, begun = fresh, end - 1
        best, at = run, begun
        for start, p in known.get(end, ()):
            if score[start] + p >= best:
                best, at = score[start] + p, start
        score.append(best)
        back.append(at)
    out, end = [], len(name)
    while end > 0:
        out.append(name[back[end]:end])
        end = back[end]
    return out[::-1]


def segmented_names(names: DataFrame, words: DataFrame, total: float, anchor: int) -> DataFrame:
    """``(name, words)`` for every distinct name."""
    starts = names.filter("name != '0'").select("name", F.explode(F.sequence(F.lit(1), F.length("name"))).alias("_at"))
    rest = F.length("name") - F.col("_at") + 1
    subs = starts.filter(rest >= 2).select("name", "_at", F.explode(F.sequence(
        F.lit(2), F.least(F.lit(anchor), rest))).alias("_n")).withColumn(
        "word", F.col("name").substr(F.col("_at"), F.col("_n")))
    short = salted_lookup(subs, words.filter(F.length("word") <= anchor), "word", F.struct("name", "_at"))
    heads = starts.filter(rest > anchor).withColumn("_head", F.col("name").substr(F.col("_at"), F.lit(anchor)))
    long = words.filter(F.length("word") > anchor).withColumn("_head", F.substring("word", 1, anchor))
    far = salted_lookup(heads, long, "_head", F.struct("name", "_at")).withColumn("_n", F.length("word")).filter(
        F.col("name").substr(F.col("_at"), F.col("_n")) == F.col("word"))
    known = short.select("name", "_at", "_n", "n").unionByName(far.select("name", "_at", "_n", "n"))
    edges = known.groupBy("name").agg(F.collect_list(F.struct(
        (F.col("_at") - 1).alias("s"), F.col("_n").alias("l"), F.col("n").alias("c"))).alias("edges"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            split = [best_split(name, [(e["s"], e["l"], e["c"]) for e in found or ()], total) if name != "0" else ["0"]
                     for name, found in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(split, pa.list_(pa.string()))],
                                             names=["name", "words"])

    return names.join(edges, "name", "left").select("name", "edges").mapInArrow(
        run, "name string, words array<string>")


def url_verdicts(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html", margin: float = 2.0, seed_weight: float = 20.0, seed_share: float = 0.5,
                 anchor: int = 20, block_seeds: Sequence[str] = BLOCK_SEEDS, allow_seeds: Sequence[str] = ALLOW_SEEDS) -> DataFrame:
    """One row per page: ``id_col, host, path, rule, verdict, score, words``.

    ``score`` is the classifier's log odds for block, ``words`` the segmented names of host
    and path.  A page without host and path has no words, the score 0 and, as no rule can fit
    it, the verdict allow.  Null ids and repeated rows are judged like any row; an empty table
    gives an empty result.
    """
    spark = pages.sparkSession
    host, path = url_parts(F.col(url_col))
    parsed = pages.select(F.col(id_col).alias("_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    urls = written(parsed.groupBy("host", "path").agg(F.count(F.lit(1)).alias("_pages")).withColumns(
        {"rule": rule, "_label": verdict, "_url": F.xxhash64("host", "path"),
         "_names": F.concat(names_of(F.col("host")), names_of(F.col("path")))}), "urls")

    seeds = spark.createDataFrame([(w, 1, 0) for w in block_seeds] + [(w, 0, 1) for w in allow_seeds],
                                  "word string, _b int, _a int")
    words = unigram_counts(pages, html_col).unionByName(
        seeds.select("word", F.lit(int(seed_weight)).cast("long").alias("n")))
    words = written(words.groupBy("word").agg(F.sum("n").alias("n")), "unigrams")
    total = float(words.agg(F.coalesce(F.sum("n"), F.lit(1))).first()[0])

    names = urls.select(F.posexplode("_names").alias("_pos", "name"), "_url", "host", "path", "_label", "_pages")
    split = written(segmented_names(names.select("name").distinct(), words, total, anchor), "names")
    tokens = written(salted_lookup(names, split, "name", F.struct("_url", "_pos")).select(
        "host", "path", "_label", "_pages", "_pos", "words"), "tokens")

    named = sorted({w for _, on, prefix in rules for w in (on + prefix).replace("/", ".").split(".") if w} | {"0"})
    flat = tokens.select("host", "path", "_label", "_pages", F.explode("words").alias("word")).filter(
        ~F.col("word").isin(named) & ~F.col("word").rlike(r"\A[a-z]{1,2}\z"))
    # millionths: whole numbers add up alike in any order
    block = F.sum(F.when(F.col("_label") == "block", F.col("_pages")).otherwise(0))
    shares = flat.filter(F.col("_label").isNotNull()).groupBy("word", "host").agg(
        F.round(block / F.sum("_pages") * 1_000_000).cast("long").alias("_share"))
    counted = written(shares.groupBy("word").agg(
        (F.sum("_share") / 1_000_000).alias("b"), (F.sum(1_000_000 - F.col("_share")) / 1_000_000).alias("a")), "counted")
    real_b, real_a = counted.agg(F.coalesce(F.sum("b"), F.lit(0.0)), F.coalesce(F.sum("a"), F.lit(0.0))).first()
    weigh_b, weigh_a = (max(seed_weight, seed_share / (1 - seed_share) * real / max(1, len(words_of)))
                        for real, words_of in ((real_b, block_seeds), (real_a, allow_seeds)))
    seeded = seeds.select("word", (F.col("_b") * weigh_b).alias("b"), (F.col("_a") * weigh_a).alias("a"))
    counts = written(counted.unionByName(seeded).groupBy("word").agg(F.sum("b").alias("b"), F.sum("a").alias("a")),
                     "classes")
    all_b, all_a, kinds = counts.agg(F.sum("b"), F.sum("a"), F.count(F.lit(1))).first()
    odds = counts.select("word", (F.log((F.col("b") + 1) / (all_b + kinds))
                                  - F.log((F.col("a") + 1) / (all_a + kinds))).alias("odds"))
    scored = salted_lookup(flat.select("host", "path", "word"), odds, "word", F.struct("host", "path")).groupBy(
        "host", "path").agg(F.sum("odds").alias("score"))
    text = tokens.groupBy("host", "path").agg(F.array_sort(F.collect_list(F.struct("_pos", "words"))).alias("_w")).select(
        "host", "path", F.flatten(F.transform("_w", lambda w: w["words"])).alias("words"))
    judged = urls.join(scored, ["host", "path"], "left").join(text, ["host", "path"], "left").select(
        "_url", "host", "path", "rule", F.coalesce("score", F.lit(0.0)).alias("score"),
        F.coalesce("words", F.array().cast("array<string>")).alias("words"), "_label")
    judged = judged.withColumn("verdict", F.coalesce("_label", F.when(F.col("score") > margin, "block").otherwise(
        "allow")))
    judged = written(judged.withColumn("_key", F.struct("host", "path")).drop("_label", "_url"), "judged")
    out = salted_lookup(parsed.withColumn("_key", F.struct("host", "path")).drop("host", "path"), judged, "_key",
                        F.col("_id"))
    return out.select(F.col("_id").alias(id_col), "host", "path", "rule", "verdict", "score", "words")
