"""Small frames and plain Python versions that the operators are held against."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"w{i}" for i in range(20000))
#: nulls, empty and very long texts, ties and repeated rows
TEXTS = [(1, None), (2, ""), (3, " \t\n"), (4, "word"), (4, "word"), (5, "Word"), (None, "word"), (None, None),
         (6, "x" * 30000), (7, LONG), (8, LONG + " end"), (9, "one two three four five six seven"),
         (9, "another text with the id of the row before it"), (10, "日本語 text 😀 mixed")]
#: columns that operators use inside
CLASHES = ("_id", "_row", "_h", "n", "node", "label", "value", "size", "target", "taken", "score", "_score", "spans",
           "kept", "_kept", "_copy", "_taken", "_hit", "_salt", "word", "host", "path", "component_id")


def edge_docs(spark, rows=TEXTS):
    """``doc_id, text, lang, source, n_chars`` and clashing extra columns."""
    df = spark.createDataFrame([(i, t, "en", None if (i or 0) % 3 == 0 else f"s{(i or 0) % 3}", len(t or ""))
                                for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", *[f"'x' AS {c}" for c in CLASHES])


def empty_docs(spark):
    return edge_docs(spark).filter("false")


def shingle_set(text, size):
    words = WORD.findall((text or "").translate(FOLD))
    if len(words) < size:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def groups_by_brute_force(sets, percent=80):
    """Smallest reachable position of every set, comparing all pairs."""
    smallest = list(range(len(sets)))

    def find(x):
        while smallest[x] != x:
            x = smallest[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and min(len(sets[i]), len(sets[j])) * 100 >= percent * max(len(sets[i]), len(sets[j])):
                common = len(sets[i] & sets[j])
                if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                    a, b = find(i), find(j)
                    smallest[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))]
