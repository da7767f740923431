"""Token counts, packing, exact and near duplicates, decontamination, quality."""

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers import FOLD, LONG, TEXTS, WORD, edge_docs, empty_docs, groups_by_brute_force, shingle_set

from fernwood.llm import byte_cnn, common, decontaminate, exact_dedup, near_dup, packing, queries, token_count
from fernwood.sources.tables import table

MODEL = f"{queries.TOKENIZERS}/piece_bpe_32k.model"
RANKS = f"{queries.TOKENIZERS}/byte_bpe_50k.tiktoken"


def rows_of(df, *names):
    return sorted(((tuple(r[n] for n in names)) for r in df.collect()), key=lambda r: tuple((x is None, x) for x in r))


# ------------------------------------------------------------------ helpers

def test_word_hashes_tell_words_apart_and_ignore_neighbours():
    texts = ["One two one", None, "", "\x0b", "two", "ONE éé\x00 é", "x" * 5000 + " one"]
    data, offsets = common.text_bytes(pa.array(texts))
    hashes, at = common.word_hashes(data, offsets, block=64)
    words = [WORD.findall((t or "").translate(FOLD)) for t in texts]
    assert np.diff(at).tolist() == [len(w) for w in words]
    flat = [w for ws in words for w in ws]
    assert len(set(flat)) == len(set(hashes.tolist()))
    assert all((a == b) == (x == y) for a, x in zip(flat, hashes) for b, y in zip(flat, hashes))


def test_maybe_among_never_misses(spark):
    rows = spark.range(5000).withColumn("k", F.col("id") % 1000)
    keys = rows.filter("k < 10").select("k").distinct()
    got = common.maybe_among(rows, keys, ["k"], "hit").filter("hit")
    assert got.filter("k < 10").count() == 50 and got.count() < 500
    assert common.maybe_among(rows, keys.limit(0), ["k"], "hit").filter("hit").count() == 0


# ------------------------------------------------------------------ 1 token counts

def plain_count(word, pieces):
    """Unigram segmentation by trying every piece at every place."""
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        found = (best[end - 1][0] + token_count.BYTE_SCORE, best[end - 1][1] - 1)
        for start in range(max(0, end - 50), end):
            if word[start:end] in pieces:
                found = max(found, (best[start][0] + pieces[word[start:end]], best[start][1] - 1))
        best.append(found)
    return -best[-1][1]


def test_token_counts_equal_plain_segmentation(spark):
    pieces = token_count.load_pieces(MODEL)
    docs = table(spark, SF_SMALL, "documents").orderBy("doc_id").limit(25).unionByName(
        edge_docs(spark, [r for r in TEXTS if r[0] not in (7, 8)]).select(
            "doc_id", "text", "lang", "source", "n_chars"))
    memo = {}

    def want(text):
        words = WORD.findall(text or "")
        for w in words:
            memo.setdefault(w, plain_count(("▁" + w).encode(), pieces))
        return len(words), sum(memo[w] for w in words)

    expected = sorted((r.doc_id if r.doc_id is not None else -1, *want(r.text)) for r in docs.collect())
    got = token_count.token_counts(docs, MODEL, group_bytes=4000).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.n_tokens) for r in got) == expected


def test_token_counts_of_edge_rows(spark):
    got = token_count.token_counts(edge_docs(spark), MODEL)
    assert got.count() == len(TEXTS)
    assert {r.n_tokens for r in got.filter("doc_id in (1, 2, 3)").collect()} == {0}
    assert token_count.token_counts(empty_docs(spark), MODEL).count() == 0


# ------------------------------------------------------------------ 7 packing

def test_best_fit_decreasing_equals_a_plain_search():
    rng = random.Random(2)
    for _ in range(50):
        capacity = rng.randint(1, 40)
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 80))]
        free = []
        for n in sorted(lengths, reverse=True):
            fits = [s for s in free if s >= n]
            if fits:
                free.remove(min(fits))
                free.append(min(fits) - n)
            else:
                free.append(capacity - n)
        rows = packing.best_fit_decreasing(lengths, capacity)
        assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
        assert sorted(capacity - sum(lengths[i] for i in r) for r in rows) == sorted(free)


def unpack(rows, row_tokens):
    """Ids per document, checked against cumulative lengths and position resets."""
    parts = {}
    for r in rows:
        ids = packing.matrix([r.input_ids], row_tokens)[0]
        positions = packing.matrix([r.position_ids], row_tokens)[0]
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= row_tokens
        for a, b, doc, start in zip(r.cu_seqlens[:-1], r.cu_seqlens[1:], r.doc_ids, r.doc_starts, strict=True):
            assert positions[a:b].tolist() == list(range(b - a))
            parts.setdefault((doc, start), []).append(ids[a:b].tolist())
    return parts


def test_packing_round_trip(spark, tmp_path):
    docs = table(spark, SF_SMALL, "documents")
    packed = packing.packed_rows(docs, RANKS, row_tokens=512, window_tokens=20000)
    packing.write_packed(packed, str(tmp_path / "packed"))
    rows = packing.read_packed(spark, str(tmp_path / "packed")).collect()
    assert len({r.pack_id for r in rows}) == len(rows)
    parts = unpack(rows, 512)
    assert all(len(v) == 1 for v in parts.values())
    decode = packing.encoder(open(RANKS, "rb").read()).decode
    for r in docs.collect():
        ids = [t for (d, _), v in sorted(parts.items()) if d == r.doc_id for t in v[0]]
        assert ids[-1] == 50256 and decode(ids[:-1]) == r.text
    assert sum(r.n_tokens for r in rows) > 0.97 * 512 * (len(rows) - 8)


def test_packing_edge_rows(spark):
    rows = packing.packed_rows(edge_docs(spark), RANKS, row_tokens=256).collect()
    parts = unpack(rows, 256)
    assert parts[(1, 0)] == [[50256]] and parts[(2, 0)] == [[50256]] and len(parts[(4, 0)]) == 2
    decode = packing.encoder(open(RANKS, "rb").read()).decode
    ids = [t for (d, _), v in sorted(parts.items(), key=lambda p: (p[0][0] or 0, p[0][1])) if d == 7 for t in v[0]]
    assert decode(ids[:-1]) == LONG
    assert packing.packed_rows(empty_docs(spark), RANKS).count() == 0


def test_packing_keeps_ids_of_other_types_and_long_white_space(spark, tmp_path):
    texts = {"a-1": "x" + " " * 300000 + "y\n", "b": None, None: "no id"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    packing.write_packed(packing.packed_rows(docs, RANKS, row_tokens=4096), str(tmp_path / "packed"))
    parts = unpack(packing.read_packed(spark, str(tmp_path / "packed"), "string").collect(), 4096)
    decode = packing.encoder(open(RANKS, "rb").read()).decode
    for name, text in texts.items():
        ids = [t for (d, _), v in sorted(parts.items(), key=lambda p: p[0][1]) if d == name for t in v[0]]
        assert decode(ids[:-1]) == (text or "")


def test_long_runs_of_white_space_are_encoded_alike():
    made = packing.encoder(open(RANKS, "rb").read())
    for text in ("a" + " " * 20000 + "b", "\n" * 15000 + "x  y", " " * 12000, "q" + "\t " * 9000 + "\u00e9",
                 " " * 12000 + "\n1", "\u3000" * 11000 + ".", "\x1c" * 12000 + " b"):
        assert packing.encoded(made, text) == made.encode_ordinary(text)


# ------------------------------------------------------------------ 4 exact duplicates

def test_exact_duplicates_of_edge_rows(spark):
    rows = TEXTS + [(20 + i, "same Text, many times") for i in range(700)] + [(900, "same text, many timeS")]
    got = exact_dedup.exact_duplicates(edge_docs(spark, rows), digest_all=True).collect()
    assert len(got) == len(rows)
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(FOLD), []).append(i)
    want = sorted((i is None, i or 0, max((x for x in groups[(t or "").translate(FOLD)] if x is not None), default=-1),
                   len(groups[(t or "").translate(FOLD)])) for i, t in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, -1 if r.keep_id is None else r.keep_id, r.group_size)
                  for r in got) == want
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)
    bare = exact_dedup.exact_duplicates(edge_docs(spark, rows)).collect()
    assert {r.doc_id for r in bare if r.text_sha256 is None} >= {6, 7, 8, 10}
    assert exact_dedup.exact_duplicates(empty_docs(spark)).count() == 0


# ------------------------------------------------------------------ 6 near duplicates

@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_equal_brute_force(spark, size):
    docs = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").orderBy("doc_id").collect()]
    rng = random.Random(size)
    base = [f"t{i}" for i in range(120)]
    for i in range(60):  # a family of near copies, some of them only linked through others
        words = list(base)
        for _ in range(rng.randint(0, 14)):
            words[rng.randrange(len(words))] = f"z{rng.randrange(1000)}"
        docs.append((10000 + i, " ".join(words)))
    sets = [shingle_set(t, size) for _, t in docs]
    want = [(i, len(s), docs[root][0]) for (i, _), s, root in zip(docs, sets, groups_by_brute_force(sets))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for k, rounds in ((64, 4), (16, 1)):
        got = near_dup.near_duplicate_groups(frame, size=size, k=k, rounds=rounds)
        assert rows_of(got, "doc_id", "n_shingles", "component_id") == sorted(want)


def test_near_duplicates_of_sets_that_nearly_fill_a_sketch(spark):
    for k in (16, 64, 256):
        n = np.arange(1, k + 1)
        assert (near_dup.retained_overlap(n, k, 80) <= -(-80 * n // 100)).all()
    # a text and its first words, 0.8 of them: the words that only the longer one has are the rarest
    docs, pairs = [], [(n, -(-80 * n // 100)) for n in range(48, 66)]
    for i, (n, m) in enumerate(pairs):
        words = [f"f{i}w{j}" for j in range(n)]
        docs += [(100 * i, " ".join(words)), (100 * i + 1, " ".join(words[:m]))]
        for j in range(4):  # the shared words are frequent elsewhere
            docs.append((100 * i + 10 + j, " ".join(words[j * m // 4:(j + 1) * m // 4]) + " "
                         + " ".join(f"o{i}x{j}y{z}" for z in range(60))))
    got = near_dup.near_duplicate_groups(spark.createDataFrame(docs, "doc_id long, text string"), size=1)
    found = {r.doc_id: r.component_id for r in got.collect()}
    assert all(found[100 * i + 1] == 100 * i for i in range(len(pairs)))
    assert sum(a != b for a, b in found.items()) == len(pairs)


def test_pairs_of_a_family_are_compared_in_blocks(spark, monkeypatch):
    # near copies of one text, most of them just below the threshold: nearly all pairs have to be compared
    rng = random.Random(3)
    base, docs = [f"t{i}" for i in range(140)], []
    for i in range(130):
        words = list(base)
        for at in rng.sample(range(140), rng.choice((3, 9, 10, 11, 12))):
            words[at] = f"z{i}x{at}"
        docs.append((i, " ".join(words)))
    sets = [shingle_set(t, 2) for _, t in docs]
    want = sorted((i, docs[root][0]) for (i, _), root in zip(docs, groups_by_brute_force(sets)))
    assert 20 < len({root for _, root in want}) < 120
    frame, compared = spark.createDataFrame(docs, "doc_id long, text string"), []
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    monkeypatch.setattr(near_dup, "verified", lambda pairs, *rest, real=near_dup.verified: (
        compared.append(pairs.count()), real(pairs, *rest))[1])
    got = near_dup.near_duplicate_groups(frame, size=2)
    assert rows_of(got, "doc_id", "component_id") == want
    assert sum(compared) <= len(docs)  # the pairs that are rows; without blocks some thousand
    got = near_dup.near_duplicate_groups(frame, size=2, rounds=1, pivoted=40)
    assert rows_of(got, "doc_id", "component_id") == want


def test_links_of_two_blocks():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 60).astype(np.uint64)
    sets = [np.unique(np.concatenate((rng.choice(base, 52, replace=False), rng.integers(0, 2**63, 2).astype(np.uint64))))
            for _ in range(40)] + [base[:1], base[1:2]]
    labels = np.arange(42) // 2

    def linked(i, j):
        common = len(np.intersect1d(sets[i], sets[j]))
        return labels[i] != labels[j] and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common)

    for second in (np.zeros(42, bool), np.arange(42) % 2 == 1):
        parts = [{i} for i in range(42)]
        for i in range(42):
            for j in range(i):
                if (second[i] != second[j] or not second.any()) and linked(i, j):
                    one, two = (next(p for p in parts if x in p) for x in (i, j))
                    if one is not two:
                        parts.remove(two)
                        one |= two
        x, root = near_dup.linked_in_block(sets, labels, second, 80, columns=7)
        want = {(i, min(p)) for p in parts for i in p if i != min(p)}
        assert 3 < len(want) and set(zip(x.tolist(), root.tolist(), strict=True)) == want


def test_band_keys_are_shared_as_often_as_sets_are_similar():
    depth, bands = near_dup.bands_for(80)
    assert (1 - 0.8 ** depth) ** bands < 1e-8 and near_dup.bands_for(1)[0] == 1 and near_dup.bands_for(100)[1] == 1
    factors = near_dup.mix64(np.arange(1, depth * bands + 1, dtype=np.uint64)) | np.uint64(1)
    rng, same = np.random.default_rng(2), []
    for n in (5, 10, 150, 3000):  # the smaller set is 0.8 of the larger one
        for _ in range(400 if n < 3000 else 20):
            v = rng.integers(0, 2**64, n, dtype=np.uint64)
            low = np.stack([near_dup.min_hashes(v, factors), near_dup.min_hashes(v[:n * 4 // 5], factors)])
            one, two = near_dup.band_keys(low, depth)
            same.append((one == two).sum())
    assert min(same) > 0 and abs(np.mean(same) / bands - 0.8 ** depth) < 0.02


def test_near_duplicates_of_edge_rows(spark):
    got = near_dup.near_duplicate_groups(edge_docs(spark), size=2)
    rows = rows_of(got, "doc_id", "n_shingles", "component_id", "kept")
    assert len(rows) == len(TEXTS)
    assert (1, 0, 1, True) in rows and (3, 0, 3, True) in rows and (8, 20000, 7, False) in rows
    assert rows.count((4, 1, 4, True)) == 2 and (5, 1, 4, False) in rows and (None, 1, 4, False) in rows
    assert near_dup.near_duplicate_groups(empty_docs(spark)).count() == 0
    kept = near_dup.deduplicated(edge_docs(spark), size=2)
    assert kept.columns == edge_docs(spark).columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 7, 9, 9, 10]
    assert near_dup.deduplicated(empty_docs(spark)).count() == 0


# ------------------------------------------------------------------ 5 decontamination

def test_decontamination_finds_substituted_passages(spark):
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(5000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(14, 50)))) for i in range(40)]
    docs, planted = [], set()
    for d in range(120):
        words = rng.choices(vocabulary, k=rng.randint(0, 400))
        if d % 2:
            item, text = items[d % 40]
            passage = text.split()
            for at in range(3, len(passage) - 1, 9):  # one word in nine replaced
                passage[at] = "other"
            cut = rng.randint(0, len(words))
            words[cut:cut] = [w.upper() + "," for w in passage]
            planted.add((d, item))
        docs.append((d, " ".join(words)))
    got = decontaminate.contaminated_passages(spark.createDataFrame(docs, "doc_id long, text string"),
                                              spark.createDataFrame(items, "item_id long, text string"))
    rows = got.collect()
    assert {(r.doc_id, r.item_id) for r in rows} == planted
    by_doc, by_item = dict(docs), dict(items)
    for r in rows:  # every reported overlap holds word by word
        doc = [w.strip(",").lower() for w in by_doc[r.doc_id].split()][r.start_word:r.end_word]
        item = by_item[r.item_id].split()[r.item_start_word:r.item_start_word + len(doc)]
        same = sum(a == b for a, b in zip(doc, item, strict=True))
        assert same == r.same_words >= 0.8 * len(doc) and len(doc) >= 13
    blocks = decontaminate.contaminated_passages(spark.createDataFrame(docs, "doc_id long, text string"),
                                                 spark.createDataFrame(items, "item_id long, text string"), block_words=200)
    assert rows_of(blocks, "doc_id", "item_id", "start_word") == rows_of(got, "doc_id", "item_id", "start_word")


def test_decontamination_of_edge_rows(spark):
    items = spark.createDataFrame([(0, None), (1, ""), (2, "too short"), (3, " ".join(f"w{i}" for i in range(100, 130)))],
                                  "item_id long, text string")
    got = decontaminate.contaminated_passages(edge_docs(spark), items)
    assert rows_of(got, "doc_id", "item_id", "start_word", "end_word") == [(7, 3, 100, 130), (8, 3, 100, 130)]
    clean = decontaminate.decontaminated(edge_docs(spark), items)
    assert clean.columns == edge_docs(spark).columns and clean.count() == len(TEXTS) - 2
    assert decontaminate.contaminated_passages(edge_docs(spark), items.filter("false")).count() == 0
    assert decontaminate.contaminated_passages(empty_docs(spark), items).count() == 0


def found_items(items, text):
    index = decontaminate.SeedIndex(list(range(len(items))), items)
    data, offsets = common.text_bytes(pa.array([text]))
    words, at = common.word_hashes(data, offsets, common.NOT_ALNUM)
    left, right = index.hits(words, at, lambda: decontaminate.sentence_bounds(data, offsets))
    return {x[:3] for x in decontaminate.overlaps(index, words, 0, len(words), left, right, 13, 0.8)}


@pytest.mark.parametrize("n", range(8, 16))
def test_inner_replacements_in_short_items_are_found(n):
    item = [f"i{k}" for k in range(n)]
    for places in itertools.combinations(range(1, n - 1), n // 5):
        text = " ".join(["before", *("other" if k in places else w for k, w in enumerate(item)), "behind"])
        assert found_items([" ".join(item)], text)


def test_items_of_few_words_match_whole_texts_and_sentences():
    items = ["what is love", "word"]
    assert found_items(items, "what is love") == {(0, 0, 3)}
    assert found_items(items, "he asked. what is love? nobody knew\nword") == {(0, 2, 5), (1, 7, 8)}
    assert found_items(items, "nobody knew what is love or a word at all") == set()
    assert found_items(items, "what is. love") == {(0, 0, 3)}
    assert found_items(items, "what was love. a word") == set()


# ------------------------------------------------------------------ 9 quality

def test_gradients_equal_differences():
    texts, y = ["Some text here, with words.", "LOUD!! LOUD!!", "a | b | c | d", ""], np.array([1, 0, 0, 1], np.float32)
    data, offsets = common.text_bytes(pa.array(texts))
    net = byte_cnn.new_filters(4, 3)
    net.shape_bias += 0.05  # away from the kink of chunks without bytes
    net.rhythm_bias -= 0.05
    batch = byte_cnn.Packed(data, offsets)
    for array, grad in zip(net.arrays(), byte_cnn.gradients(net, batch, y), strict=True):
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        loss = []
        for step in (1e-3, -1e-3):
            array[at] += step
            p = byte_cnn.sigmoid(batch.forward(net)[0].astype(float))
            loss.append(-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)))
            array[at] -= step
        assert (loss[0] - loss[1]) / 2e-3 == pytest.approx(float(grad[at]), rel=0.1, abs=2e-3)


def test_quality_on_held_out_rows(spark):
    got = byte_cnn.quality_scores(table(spark, "/root/testdata/sf0.01", "documents"),
                                  table(spark, "/root/testdata/sf0.01", "labels"), max_rows=300)
    marks = {r.doc_id: r.quality for r in table(spark, "/root/testdata/sf0.01", "labels").collect()}
    rows = got.collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r.predicted, marks[r.doc_id]) for r in rows if r.held_out and r.doc_id in marks]
    assert np.mean([p == y for p, y in held]) > 0.93


def test_scores_do_not_depend_on_neighbours():
    net = byte_cnn.new_filters()
    texts = ["Some text.", None, "", "y" * 3000, "LOUD!! " * 30, "Some text."]
    together = byte_cnn.predict(net, pa.array(texts))
    alone = [byte_cnn.predict(net, pa.array([t], pa.string()))[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-6) and together[0] == pytest.approx(together[-1], abs=1e-6)


def test_long_texts_score_alike_in_pieces():
    net, rng = byte_cnn.new_filters(), random.Random(6)
    for n in (33, 64, 65, 1000, 4097):
        text = pa.array(["".join(rng.choices("ab c\u00e9\n", k=n))])
        whole = byte_cnn.predict(net, text)[0]
        for piece in (32, 64, 100, 4096):
            assert byte_cnn.predict(net, text, piece)[0] == pytest.approx(whole, abs=1e-6)


def test_quality_of_edge_rows(spark):
    labels = spark.createDataFrame([(4, 1, 0), (6, 0, 0), (7, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = byte_cnn.quality_scores(edge_docs(spark), labels).collect()
    assert len(got) == len(TEXTS) and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in byte_cnn.quality_scores(edge_docs(spark), labels.filter("false")).collect()} == {0.5}
    assert byte_cnn.quality_scores(empty_docs(spark), labels).count() == 0
    assert byte_cnn.accepted(edge_docs(spark), labels).columns == edge_docs(spark).columns


def test_registered_sql_agrees(spark):
    from oracle_check import digest, duck

    con = duck(SF_SMALL)
    for name, sql in queries.oracle_sql().items():
        df = queries.queries()[name](spark, SF_SMALL)
        rel = con.sql(sql)
        assert sorted(df.columns) == sorted(rel.columns)
        assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(rel.columns, rel.fetchall())[0]
