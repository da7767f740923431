"""Token alignment, quality rules and conversation repair."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL
from helpers import TEXTS, WORD, edge_docs, empty_docs

from fernwood.llm import quality_trees, queries, token_align, turn_repair
from fernwood.sources.tables import table

BYTE_LEVEL, PIECES = f"{queries.TOKENIZERS}/byte_bpe_50k.json", f"{queries.TOKENIZERS}/piece_bpe_32k.model"


# ------------------------------------------------------------------ 11 token alignment

def letters_of_bytes():
    found, extra = {}, 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            found[chr(b)] = b
        else:
            found[chr(256 + extra)] = b
            extra += 1
    return found


@pytest.fixture(scope="module")
def plain_encoders():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(BYTE_LEVEL)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECES), letters_of_bytes()


def plain_groups(text, plain_encoders):
    """Token ids of both and the group of each, from the set of common ends."""
    a, b, letters = plain_encoders
    if not text:
        return []
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    size_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
    pieces = [b.id_to_piece(i) for i in ids_b]
    size_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, pieces)]
    whole = (" " + text).encode()
    if b"".join(size_a) != whole or b"".join(size_b) != whole:
        return []
    ends_a = list(itertools.accumulate(map(len, size_a)))
    ends_b = list(itertools.accumulate(map(len, size_b)))
    common = sorted(set(ends_a) & set(ends_b))
    groups, at_a, at_b = [], 0, 0
    for end in common:
        i, j = ends_a.index(end, at_a) + 1, ends_b.index(end, at_b) + 1
        groups.append((ids_a[at_a:i], ids_b[at_b:j]))
        at_a, at_b = i, j
    return groups


def check_alignment(rows, docs, plain_encoders):
    groups = {t: plain_groups(t, plain_encoders) for t in {t for _, t in docs}}
    count, best = Counter(), Counter()
    for _, text in docs:
        count.update((a[-1], b[-1]) for a, b in groups[text])
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    want = []
    for i, text in docs:
        g = groups[text]
        links = [(a[-1], b[-1]) for a, b in g]
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        want.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(links),
                     sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links),
                     hashlib.sha256(written.encode()).hexdigest() if g else ""))
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert sorted((tuple(r[n] for n in names) for r in rows), key=str) == sorted(want, key=str)


def test_alignment_equals_common_ends(spark, plain_encoders):
    docs = table(spark, SF_SMALL, "documents")
    rows = queries.op11_token_align(spark, SF_SMALL).collect()
    check_alignment(rows, [(r.doc_id, r.text) for r in docs.collect()], plain_encoders)
    assert sum(r.n_links for r in rows) > 1000 and any(r.n_best < r.n_links for r in rows)


def test_alignment_of_odd_texts(spark, plain_encoders):
    odd = ["<|endoftext|> and <s> </s> <unk>", "a  b\t\tc\n\n d ", "▁x", "éﬁ①", "a\x00b", " lead", "日本語のテキスト 😀👍🏽",
           "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "0123456789" * 7, "don't we'll", "<0x41>", " 　 x", "\r\n\r\n"]
    rows = [*TEXTS, *[(100 + i, t) for i, t in enumerate(odd)]]
    got = token_align.alignment_summary(edge_docs(spark, rows), BYTE_LEVEL, PIECES).collect()
    check_alignment(got, rows, plain_encoders)
    assert token_align.alignment_summary(empty_docs(spark), BYTE_LEVEL, PIECES).count() == 0


def test_long_runs_of_white_space_are_cut_as_the_pattern_does(plain_encoders):
    made = token_align.Encoders(open(BYTE_LEVEL, "rb").read(), open(PIECES, "rb").read())
    for space in (" ", "\n", "\t "):
        for text in ("x" + space * 21000 + "word a", "x " + space * 21000, space * 21000 + "é"):
            assert made.encode_a(text) == plain_encoders[0].encode(text, add_special_tokens=False).ids
    assert len(made.encode_a("x" + " " * 3_000_000 + "y")) > 2


def test_intervals_divide_into_all_common_ends():
    rng = np.random.default_rng(5)
    for _ in range(300):
        ends_a, ends_b, docs_a, docs_b, base, want = [], [], [0], [0], 0, []
        for _ in range(rng.integers(1, 4)):
            size = int(rng.integers(0, 60))
            a = sorted({*rng.integers(1, size + 1, rng.integers(0, 40)).tolist(), size} - {0}) if size else []
            b = sorted({*rng.integers(1, size + 1, rng.integers(0, 40)).tolist(), size} - {0}) if size else []
            want += [(docs_a[-1] + a.index(e) + 1, docs_b[-1] + b.index(e) + 1) for e in a if e in b]
            ends_a += [base + e for e in a]
            ends_b += [base + e for e in b]
            docs_a.append(len(ends_a))
            docs_b.append(len(ends_b))
            base += size
        got = token_align.shared_cuts(*[np.array(x, np.int64) for x in (ends_a, ends_b, docs_a, docs_b)])
        assert list(zip(*[g.tolist() for g in got])) == want


def test_aligned_tokens_give_both_sequences_and_their_groups(spark, plain_encoders):
    rows = token_align.aligned_tokens(edge_docs(spark), BYTE_LEVEL, PIECES).collect()
    want = sorted((str(i), str(plain_groups(t, plain_encoders))) for i, t in TEXTS)
    got = []
    for r in rows:
        ends_a, ends_b = [0, *r.a_ends], [0, *r.b_ends]
        got.append((str(r.doc_id), str([(r.a_ids[ends_a[k]:ends_a[k + 1]], r.b_ids[ends_b[k]:ends_b[k + 1]])
                                        for k in range(len(r.a_ends))])))
    assert sorted(got) == want


def test_linked_pairs_stay_under_their_bound(spark):
    made = token_align.Encoders(open(BYTE_LEVEL, "rb").read(), open(PIECES, "rb").read())
    bound = token_align.most_pairs(made.bytes_a, made.bytes_b)
    assert bound < sum(map(len, made.bytes_a)) + 2 * sum(map(len, made.bytes_b)) + 60000
    linked = token_align.linked_documents(table(spark, SF_SMALL, "documents"), BYTE_LEVEL, PIECES)
    pairs = [r.pair for r in token_align.pair_counts(linked).collect()]
    assert 0 < len(pairs) < bound
    for p in pairs:
        a, b = made.bytes_a[p >> 32], made.bytes_b[p & 0xFFFFFFFF]
        assert a.endswith(b) or b.endswith(a)


# ------------------------------------------------------------------ 12 quality rules

def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def check_rules(rows, docs):
    want = sorted(((i, *plain_counts(t)) for i, t in docs), key=str)
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted((tuple(r[n] for n in names) for r in rows), key=str) == want
    for r in rows:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed and r.score >= 0.3)


def test_rule_counts_equal_plain_ones(spark):
    docs = table(spark, SF_CHECK, "documents")
    rows = queries.op12_quality_rules(spark, SF_CHECK).collect()
    check_rules(rows, [(r.doc_id, r.text) for r in docs.collect()])
    assert sum(r.n_dup_lines for r in rows) and sum(r.n_repeat_words for r in rows)


def test_rules_on_odd_rows(spark):
    block = "one two three four five six seven eight nine"
    odd = [block + "\n" + block, block + " " + block + " x", "a\n\na\n \n \na\r\na\r", "# * $ % & | < > é#é", "w " * 400, "a b c d e f g h " * 2,
           "x" * 3_000_000, "x" * 3_000_000 + "\n" + "x" * 3_000_000, "\n".join(["same line"] * 5), "A a\na A\nA a"]
    rows = [*TEXTS, *[(100 + i, t) for i, t in enumerate(odd)]]
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (100, None), (101, 2)], "doc_id long, quality int")
    check_rules(quality_trees.quality_rules(edge_docs(spark, rows), labels).collect(), rows)
    both = spark.createDataFrame([(i, i % 2) for i in range(1, 110)], "doc_id long, quality int")
    check_rules(quality_trees.quality_rules(edge_docs(spark, rows), both).collect(), rows)
    assert quality_trees.quality_rules(empty_docs(spark), both).count() == 0
    assert quality_trees.quality_rules(edge_docs(spark), both.limit(0)).filter("score <> 0.5").count() == 0


def test_rules_learn_quality_for_held_out_rows(spark):
    labels = table(spark, SF_CHECK, "labels")
    rows = queries.op12_quality_rules(spark, SF_CHECK).join(labels, "doc_id").filter(
        quality_trees.held_out(F.col("doc_id")) & ~F.col("base_failed")).collect()
    right = sum(r.kept == (r.quality == 1) for r in rows)
    assert len(rows) > 40 and right >= 0.95 * len(rows)
    good = [r for r in rows if r.quality == 1]
    assert sum(r.kept for r in good) >= 0.97 * len(good)


def test_chosen_statistics_never_raise_the_score():
    rng = np.random.default_rng(3)
    x = rng.random((3000, 4))
    y = ((x[:, 0] + 0.4 * np.sin(9 * x[:, 1])) % 1 > 0.4).astype(float)  # a function of x: can be learned
    trees = quality_trees.fit_trees(x, y, falling=(0, 2), n_trees=60)
    base = rng.random((200, 4))
    for f in (0, 2):
        grid = np.repeat(base, 50, axis=0)
        grid[:, f] = np.tile(np.linspace(-0.5, 1.5, 50), 200)
        score = trees.score(grid).reshape(200, 50)
        assert (np.diff(score, axis=1) <= 1e-12).all()
    free = quality_trees.fit_trees(x, y, falling=(), n_trees=60)
    grid = np.repeat(base, 50, axis=0)
    grid[:, 0] = np.tile(np.linspace(-0.5, 1.5, 50), 200)
    assert (np.diff(free.score(grid).reshape(200, 50), axis=1) > 1e-3).any()
    assert ((free.score(x) > 0.5) == y).mean() > 0.9


def test_flat_trees_equal_a_walk_from_node_to_node():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 3))
    trees = quality_trees.fit_trees(x, (x[:, 0] * x[:, 1] > 0).astype(float), (), n_trees=20, depth=3)
    for row, margin in zip(x[:100], trees.margin(x[:100])):
        total = trees.bias
        for node in trees.roots:
            while trees.left[node] != node:
                node = trees.left[node] if row[trees.feature[node]] <= trees.threshold[node] else trees.right[node]
            total += trees.value[node]
        assert margin == pytest.approx(total)


def test_statistics_in_chunks_equal_those_of_one_piece(monkeypatch):
    rng = random.Random(2)
    texts = pa.array([" ".join(rng.choice(["ab", "é", "x" * 900, "\n"]) for _ in range(rng.randint(0, 300))) for _ in range(40)])
    whole = quality_trees.statistics(texts)
    monkeypatch.setattr(quality_trees, "_CHUNK", 97)
    parts = quality_trees.statistics(texts)
    assert (whole[0] == parts[0]).all() and np.allclose(whole[1], parts[1])


# ------------------------------------------------------------------ 13 conversation repair

LEGAL = re.compile(r"(s?(ua)+)?\Z")
BLANK = re.compile(r"[\x20\x09-\x0D]*\Z")


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if draw == 1:
            text = ""
        if draw == 2:
            text = re.sub("[.!?]", "", text)
        if draw == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1)
    return out


def plain_faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        if BLANK.match(text):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            last = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)[-1]
            out.append(None if last in ".!?" else "truncated")
        seen.add((role, text))
    return out


def plain_repair(rows, faults):
    """Shortest way over (rows read, role initials so far collapsed to a state), by (cost, audit)."""
    import heapq
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    heap, done = [(0, "", 0, "", ())], {}
    while heap:
        cost, audit, at, state, lines = heapq.heappop(heap)
        if (at, state) in done:
            continue
        done[at, state] = True
        if at == len(rows) and state in ("", "a"):
            return cost, audit, list(lines)
        for role in ("user", "assistant"):
            if (state, role[0]) in step:
                heapq.heappush(heap, (cost + 5, audit + "I", at, step[state, role[0]], (*lines, role + ":")))
        if at < len(rows):
            _, _, role, text = rows[at]
            heapq.heappush(heap, (cost + 2, audit + "D", at + 1, state, lines))
            if faults[at] not in ("blank", "duplicate"):
                extra = 5 * (faults[at] == "truncated")
                if (state, role[:1]) in step:
                    heapq.heappush(heap, (cost + extra, audit + "K", at + 1, step[state, role[0]], (*lines, f"{role}:{text}")))
                for to in ("user", "assistant"):
                    if (state, to[0]) in step:
                        heapq.heappush(heap, (cost + extra + 1, audit + "R", at + 1, step[state, to[0]], (*lines, f"{to}:{text}")))
    raise AssertionError("no repair")


def plain_report(original):
    found = {}
    for conv in {r[0] for r in original}:
        rows = [r for r in plain_damage(original) if r[0] == conv]
        rows.sort(key=lambda r: (r[1] is not None, r[1] or 0))
        faults = plain_faults(rows)
        turns = [r[1] for r in rows if r[1] is not None]
        initials = [r[2][:1] for r in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, lines = plain_repair(rows, faults)
        found[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(k) for k in (
            "blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return found


def report_of(rows):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r.conv_id: tuple(r[n] for n in names) for r in rows}


def test_repair_equals_a_plain_search(spark):
    rows = [tuple(r) for r in table(spark, SF_CHECK, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op13_turn_repair(spark, SF_CHECK).collect()
    assert report_of(got) == plain_report(rows) and len(got) == len({r[0] for r in rows})


def random_conversations(seed, n, longest, turns=None):
    rng = random.Random(seed)
    texts = ["Hi.", "Yes!", "cut", "", " ", "Why?", "a b c.", None, "\t\n", "Fine. \n", "no end "]
    out = []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            if rng.random() < 0.9:
                out.append((conv, turn, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "uncle"]),
                            rng.choice(texts) if rng.random() < 0.5 else f"text {rng.randint(0, 40)}" + rng.choice([".", "?", ""])))
    return out


def test_repair_of_random_and_long_conversations(spark, monkeypatch):
    rows = random_conversations(1, 60, 12) + [(1000 + c, t, r, x) for c, t, r, x in random_conversations(2, 2, 700)]
    rows += [(None, 0, "user", "Hello."), (None, None, None, None), (None, 5, "assistant", "Ok."), (2000, None, "user", "Only."),
             (2001, -3, "user", "A."), (2001, 4, "assistant", "B.")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("pos", F.lit("x"))
    want = plain_report(rows)
    assert report_of(turn_repair.repair_report(frame, turn_repair.damaged(frame)).collect()) == want
    # blocks of a few rows that combine three at a time over several levels
    monkeypatch.setattr(turn_repair, "BLOCK", 5)
    monkeypatch.setattr(turn_repair, "FAN", 3)
    assert report_of(turn_repair.repair_report(frame, turn_repair.damaged(frame)).collect()) == want


def test_repair_of_odd_tables(spark):
    schema = "conv_id string, turn int, role string, text string"
    empty = spark.createDataFrame([], schema)
    assert turn_repair.repair_report(empty, turn_repair.damaged(empty)).count() == 0
    # rows that agree in every column are repeats of the first
    twice = spark.createDataFrame([("c", 1, "user", "Hi."), ("c", 1, "user", "Hi."), ("c", 2, "assistant", "Yes.")], schema)
    got = report_of(turn_repair.repair_report(twice, twice).collect())
    assert got["c"][1:7] == (0, 1, 0, 1, 2, "KDK")
    assert got["c"][7] == hashlib.sha256(b"user:Hi.\nassistant:Yes.").hexdigest()
    # every row of a conversation gone
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:1".encode()) % 20 == 0)
    one = spark.createDataFrame([(str(gone), 1, "user", "Hi.")], schema)
    assert report_of(turn_repair.repair_report(one, turn_repair.damaged(one)).collect()) == {
        str(gone): (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_blocks_equal_all_edit_sequences():
    """All edits of short codes, enumerated, with up to two inserted rows at every place."""
    rng = random.Random(7)
    for _ in range(25):
        code = "".join(rng.choice("uaUAsSx-_") for _ in range(rng.randint(0, 4)))
        best = None
        choices = [["D"] if c == "x" else ["D", "K", "Ru", "Ra"] for c in code]
        fills = ["", "u", "a", "ua", "au"]
        for edits in itertools.product(*choices):
            for ins in itertools.product(fills, repeat=len(code) + 1):
                roles, audit, cost = "", "", 0
                for i, fill in enumerate(ins):
                    roles, audit, cost = roles + fill, audit + "I" * len(fill), cost + 5 * len(fill)
                    if i < len(code):
                        e, c = edits[i], code[i]
                        audit += e[0]
                        cost += {"D": 2, "K": 0, "R": 1}[e[0]] + 5 * (e != "D" and (c.isupper() or c == "_"))
                        roles += "" if e == "D" else c.lower().replace("_", "-") if e == "K" else e[1]
                if LEGAL.match(roles) and (best is None or (cost, audit) < best):
                    best = (cost, audit)
        got = turn_repair.parse_block(code, 0)
        assert min(got[e] for e in turn_repair.ENDS if e in got) == best


def test_repaired_rows_are_legal(spark):
    frame = spark.createDataFrame(random_conversations(9, 30, 15), "conv_id long, turn long, role string, text string")
    checked = turn_repair.checked_rows(frame)
    _, blocks, parts = turn_repair.parsed(checked)
    rows = turn_repair.repaired_rows(frame, checked, turn_repair.kept_edits(blocks, parts)).dropDuplicates(["_c", "pos", "seq"])
    found = {}
    for r in rows.orderBy("_c", "pos", "seq").collect():
        found[r["_c"]] = found.get(r["_c"], "") + r["role"][0]
    assert found and all(LEGAL.match(x) for x in found.values())
