"""Personal data by fixed patterns and bootstrapped contexts, in DataFrame operations only.

Base spans, leftmost and not overlapping per kind (code points, end exclusive): email, ip
(four numbers of at most 255), card (12 to 19 digits that pass Luhn), phone (``+``, 9 to 15
digits).  The base spans are the seeds of the method:

1. Occurrences: base spans and candidates, each with its lexical patterns: the two words before
   it, and the words around it.  Contexts are whole words, however long, and end at the match
   of the same kind before or behind.  A run of words with a digit or ``@`` has as candidates
   its first word and its beginnings up to each blank, as long as they hold at most 19 digits
   (no kind has more) and no ``@``; those that overlap a base span are left out.
2. The pattern-instance graph has an edge for every distinct (pattern, instance).  Seeds have
   the score 1 for their kind.  In each round a pattern's confidence for a kind is the sum of
   its instances' scores over their number plus one (candidates of the same run count once, with
   the best score); patterns with at least ``support`` scored instances and a confidence of at least ``confidence`` are trusted.  An instance's score is
   the chance that at least one of its trusted patterns is right, ``1 - prod(1 - confidence)``.
3. After the last round, candidates in a trusted pattern whose score reaches ``least_score``
   are reported with the pattern's kind, if their shape allows it (an ``@``, or the kind's
   number of digits); of a run the candidate of the best score, of equal ones the longest.

The regular expressions never go back over a character twice: a match can only begin where a
run of its characters begins or where the match before it ended, and repeats are possessive.
Texts stay where they are; only occurrences with short contexts are shuffled, and hot
patterns and instances are spread over sub-keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fernwood.llm.common import lower_ascii, salted_lookup, written

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "A-Za-z0-9._%+-"
#: the base patterns; ``\G`` is the end of the match before
PATTERNS = (
    rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?+[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
#: runs of words that hold a digit or an @
CANDIDATE = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+(?:\x20[^\s0-9@]*+[0-9@]\S*+)*+"
#: the beginning of a run that may hold its candidates: every word but the first has a digit
_HEAD = r"\A\S++(?:\x20\S++){0,18}+"
_MOST_DIGITS = 19
#: the last two words of a gap, or its only one; a match can only begin where a word does
_LAST_WORDS = r"(?<!\S)(?:\S++\s++)?\S++\s*+\z"
#: a text without the sign holds no span of the kind
_SIGNS = ("@", "[0-9]\\.[0-9]", "[0-9](?:[\\x20-]?[0-9]){11}", "+")
_PART = "0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(
        i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def valid(kind: Column, match: Column) -> Column:
    """Whether a match of a base pattern counts."""
    n = F.length(_digits(match))
    return (F.when(kind == 0, True)
            .when(kind == 1, match.rlike(rf"\A{_PART}(?:\.{_PART}){{3}}\z"))
            .when(kind == 2, F.when(n.between(12, 19), _luhn(_digits(match))).otherwise(False))
            .when(kind == 3, n.between(9, 15)).otherwise(False))


def _found(text: Column, pattern: str, kind: int, sign: Column) -> Column:
    """All matches of a pattern with the lengths and ends of the text between them."""
    matches = F.regexp_extract_all(text, F.lit(pattern), 0)
    gaps, n = F.split(text, pattern, -1), F.size(matches)
    zipped = F.arrays_zip(matches.alias("m"), F.slice(gaps, 1, n).alias("l"), F.slice(gaps, 2, n).alias("r"))
    rows = F.transform(zipped, lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("pos"), F.length(x["l"]).alias("gap"), x["m"].alias("match"),
        F.regexp_extract(x["l"], _LAST_WORDS, 0).alias("left"),
        F.regexp_extract(x["r"], r"\A\s*+\S++", 0).alias("right")))
    return F.when(sign, rows).otherwise(F.array().cast(
        "array<struct<kind:int,pos:int,gap:int,match:string,left:string,right:string>>"))


def without_overlaps(rows: DataFrame) -> DataFrame:
    """``rows`` without the candidates (kind 4) that overlap a base span of their text.

    Two running bounds over a text's rows instead of a join, so it stays linear in the spans.
    """
    base, text = F.col("kind") < 4, Window.partitionBy("_id", "_h")
    # peers share a start: the default range frame holds them
    before = F.max(F.when(base, F.col("end"))).over(text.orderBy("start"))
    behind = F.min(F.when(base, F.col("start"))).over(text.orderBy(F.desc("start")))
    rows = rows.withColumns({"_before": before, "_behind": behind})
    hit = (F.col("_before") > F.col("start")) | (F.col("_behind") < F.col("end"))
    return rows.filter(base | ~F.coalesce(hit, F.lit(False))).drop("_before", "_behind")


def run_candidates(rows: DataFrame) -> DataFrame:
    """``rows`` with the candidates of every run (kind 4) in place of the run.

    Adds ``run``, a hash of the whole match.  Inner candidates have no context behind them.
    """
    words = F.split(F.regexp_extract("match", _HEAD, 0), " ")
    heads = F.transform(F.sequence(F.lit(1), F.size(words)), lambda n: F.array_join(F.slice(words, F.lit(1), n), " "))
    heads = F.filter(heads, lambda head, i: (i == 0) | (
        ~F.contains(head, F.lit("@")) & (F.length(_digits(head)) <= _MOST_DIGITS)))
    rows = rows.withColumn("run", F.xxhash64(lower_ascii(F.col("match")))).withColumn(
        "piece", F.explode(F.when(F.col("kind") == 4, heads).otherwise(F.array("match"))))
    whole = F.col("piece") == F.col("match")
    return rows.withColumns({
        "right": F.when(whole, F.col("right")).otherwise(F.lit("")),
        "end": F.col("start") + F.length("piece"),
        "match": F.col("piece")}).drop("piece")


def occurrences(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(_id, _h, kind, match, left, right, start, end, run)``; kind 4 is a candidate; written.

    ``_h`` is a hash of the text: equal rows give the same occurrences, which are kept once.
    Candidates that overlap a base span of their text are left out.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    signs = [F.contains(text, F.lit(_SIGNS[0])), text.rlike(_SIGNS[1]), text.rlike(_SIGNS[2]),
             F.contains(text, F.lit(_SIGNS[3])), F.lit(True)]
    arrays = [_found(text, p, k, s) for k, (p, s) in enumerate(zip((*PATTERNS, CANDIDATE), signs, strict=True))]
    rows = docs.filter(text.rlike("[0-9@]")).select(
        F.col(id_col).alias("_id"), F.xxhash64(text).alias("_h"), F.explode(F.concat(*arrays)).alias("x")).select(
        "_id", "_h", "x.*")
    rows = written(rows, "matches").dropDuplicates(["_id", "_h", "kind", "pos"])
    before = Window.partitionBy("_id", "_h", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("match")).over(before).cast("long")
    rows = rows.withColumn("end", end).withColumn("start", F.col("end") - F.length("match"))
    keep = (F.col("kind") == 4) | valid(F.col("kind"), F.col("match"))
    return written(without_overlaps(run_candidates(rows.filter(keep).drop("gap", "pos"))), "occurrences")


def _word(words: Column, at: int) -> Column:
    """A word of a context, letters only; empty where there is none."""
    return F.regexp_replace(F.lower(F.coalesce(F.get(words, F.lit(at)) if at >= 0 else F.get(
        words, F.size(words) + at), F.lit(""))), r"[^\p{L}]", "")


def context_patterns(rows: DataFrame) -> DataFrame:
    """One row per occurrence and lexical pattern (``pattern``), with its ``instance``."""
    left = F.split(F.regexp_replace("left", r"\A\s+|\s+\z", ""), r"\s+")
    right = F.split(F.regexp_replace("right", r"\A\s+", ""), r"\s+")
    two, one, after = _word(left, -2), _word(left, -1), _word(right, 0)
    patterns = F.array(
        F.when((two != "") & (one != ""), F.concat(two, F.lit(" "), one, F.lit(" *"))),
        F.when((one != "") & (after != ""), F.concat(one, F.lit(" * "), after)))
    return rows.withColumn("instance", lower_ascii(F.col("match"))).withColumn(
        "pattern", F.explode(F.array_compact(patterns))).drop("left", "right")


def allowed_kinds(match: Column) -> Column:
    """Numbers of the kinds that a candidate's shape allows."""
    n = F.length(_digits(match))
    base = reduce(lambda a, b: a | b, [match.rlike(p.replace(r"\G|", "")) for p in (PATTERNS[0], PATTERNS[1])])
    shapes = [F.contains(match, F.lit("@")), match.rlike(r"[0-9]+[.:][0-9]+[.:][0-9]"), n.between(12, 19),
              n.between(7, 15)]
    return F.when(base, F.array().cast("array<int>")).otherwise(
        F.array_compact(F.array(*[F.when(s, F.lit(k)) for k, s in enumerate(shapes)])))


def trusted_patterns(edges: DataFrame, rounds: int, support: int, confidence: float) -> tuple[DataFrame, DataFrame] | None:
    """Trusted ``(pattern, kind, conf)`` and ``(instance, kind, score)``; None if there are none.

    ``edges`` has ``(pattern, instance, kind, seed, run)``, one row per pattern, instance and kind;
    a candidate has a row for every kind its shape allows.  A pattern counts runs, so a
    confidence stays below 1.
    """
    size = edges.groupBy("pattern").agg(F.count_distinct("run").alias("size"))
    seeded = edges.filter("seed").groupBy("pattern").agg(F.count(F.lit(1)).alias("s")).filter(
        F.col("s") >= support).join(size, "pattern").select("pattern", "size")
    edges = written(salted_lookup(edges, seeded, "pattern", F.col("instance")), "edges")
    if edges.isEmpty():
        return None
    edges = edges.withColumn("_key", F.struct("instance", "kind"))
    scores = written(edges.filter("seed").select("instance", "kind", F.lit(1.0).alias("score")).distinct(), "scores")
    trusted = None
    for _ in range(rounds):
        known = salted_lookup(edges, scores.select(F.struct("instance", "kind").alias("_key"), "score"), "_key",
                              F.col("pattern"))
        runs = known.groupBy("pattern", "kind", "run").agg(F.max("score").alias("score"), F.first("size").alias("size"))
        trusted = runs.groupBy("pattern", "kind").agg(
            F.sum("score").alias("pos"), F.count(F.lit(1)).alias("n"), F.first("size").alias("size")).withColumn(
            "conf", F.col("pos") / (F.col("size") + 1)).filter(
            (F.col("n") >= support) & (F.col("conf") >= confidence)).select("pattern", "kind", "conf")
        trusted = written(trusted, "trusted")
        hits = salted_lookup(
            edges.select("instance", "seed", F.struct("pattern", "kind").alias("_p")),
            trusted.select(F.struct("pattern", "kind").alias("_p"), "conf"), "_p", F.col("instance"))
        learned = hits.groupBy("instance", F.col("_p.kind").alias("kind")).agg(
            (1 - F.exp(F.sum(F.log(1 - F.col("conf"))))).alias("score"))
        seeds = edges.filter("seed").select("instance", "kind", F.lit(1.0).alias("score")).distinct()
        scores = written(learned.unionByName(seeds).groupBy("instance", "kind").agg(F.max("score").alias("score")),
                         "scores")
    return trusted, scores


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 3, support: int = 3,
                  confidence: float = 0.6, least_score: float = 0.7) -> DataFrame:
    """One row per input row: ``id_col`` and ``spans array<struct<start, kind, end, base, score>>``.

    Spans are sorted by start, then kind (the number of the kind in ``KINDS``); base spans
    have the score 1.  Null and empty texts have none; equal rows get equal spans; an empty
    table gives an empty result; other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = occurrences(docs, id_col, text_col)
    base = rows.filter("kind < 4").select("_id", "_h", F.struct(
        "start", "kind", "end", F.lit(True).alias("base"), F.lit(1.0).alias("score")).alias("span"))

    patterns = written(context_patterns(rows), "patterns")
    wide = patterns.withColumn("kinds", F.when(F.col("kind") < 4, F.array("kind")).otherwise(
        allowed_kinds(F.col("match"))))
    edges = wide.select("pattern", "instance", "run", (F.col("kind") < 4).alias("seed"), F.explode("kinds").alias("kind"))
    edges = written(edges.groupBy("pattern", "instance", "kind").agg(
        F.max("seed").alias("seed"), F.min("run").alias("run")), "graph")
    model = trusted_patterns(edges, rounds, support, confidence)
    spans = base
    if model is not None:
        trusted, scores = model
        cases = wide.filter("kind = 4").select("_id", "_h", "start", "end", "instance", "pattern",
                                               F.explode("kinds").alias("kind"))
        cases = salted_lookup(cases.withColumn("_p", F.struct("pattern", "kind")),
                              trusted.select(F.struct("pattern", "kind").alias("_p")), "_p", F.struct("_id", "start"))
        cases = salted_lookup(cases.withColumn("_key", F.struct("instance", "kind")),
                              scores.select(F.struct("instance", "kind").alias("_key"), "score"), "_key",
                              F.struct("_id", "start")).filter(F.col("score") >= least_score)
        best = cases.groupBy("_id", "_h", "start").agg(
            F.max(F.struct("score", "end", (-F.col("kind")).alias("minus"))).alias("b"))
        spans = base.unionByName(best.select("_id", "_h", F.struct(
            "start", (-F.col("b.minus")).alias("kind"), "b.end", F.lit(False).alias("base"), "b.score").alias("span")))
    spans = spans.groupBy(F.col("_id").alias("_sid"), F.col("_h").alias("_sh")).agg(
        F.array_sort(F.collect_list("span")).alias("spans"))
    keys = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_h"))
    joined = keys.join(spans, F.col("_id").eqNullSafe(F.col("_sid")) & (F.col("_h") == F.col("_sh")), "left")
    none = F.array().cast(spans.schema["spans"].dataType)
    return joined.select(F.col("_id").alias(id_col), F.coalesce("spans", none).alias("spans"))


def span_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, SHA-256 of the base spans, and all spans, as text."""
    names = F.array(*[F.lit(k) for k in KINDS])

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of(kind):
        return lambda s: s["base"] & (s["kind"] == kind)

    counts = [F.size(F.filter("spans", of(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select(id_col, *counts, F.sha2(joined(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
