"""The ten operators against brute force, round trips and edge cases."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from kindling.llm import (alignment, byte_bpe, chat, language_id, line_dedup, near_dup, packing, quality, topk_search, toxicity, warc)
from kindling.llm.common import BY_NON_LETTER, beginnings, shingles, word_hashes
from kindling.llm.components import connected_components
from tests.conftest import rows

WORD = re.compile("[^\x20\t-\r]+")
DOCS = "doc_id long, text string, lang string"
SF = "/root/testdata/sf0.001"

EDGE = [(None, "no id\nshared line of text", "en"), (1, None, "en"), (2, "", None), (3, " \t\n\x0b ", "en"), (4, "shared line of text\nown", "en"),
        (4, "shared line of text\nown", "en"), (5, "Shared Line OF text \nSHARED LINE OF TEXT\n", "fr"), (6, "a", "fr"), (7, "é " * 3000 + "x" * 5000, "fr")]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, DOCS).withColumn("n_lines", F.lit(7)).withColumn("runs", F.lit("r")).withColumn("row", F.lit(0)).withColumn("component", F.lit("c"))


def test_word_hashes_tell_words_apart():
    text = "The the  a\tb\nthe é a".encode()
    got = word_hashes(text)
    assert len(got) == 7 and got[1] == got[4] and got[2] == got[6] and len(set(got.tolist())) == 5
    long = b" ".join(b"w%d" % (i % 1000) for i in range(300_000))  # several blocks
    assert len(set(word_hashes(long).tolist())) == 1000 and len(word_hashes(long)) == 300_000
    assert len(word_hashes(b"x" * (3 << 20))) == 1
    assert len(word_hashes(b"idiot***scum", BY_NON_LETTER)) == 2


def brute_counts(t):
    t = t or ""
    w = WORD.findall(t)
    three = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {j for i in range(len(w) - 2) if three[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def test_quality_counts_match_brute_force(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + [x[1] for x in EDGE] + ["a b c a b c", "x x x x", "a\na\n\n\na"]
    assert [quality.text_counts(None if t is None else t.encode())[:5] for t in texts] == [brute_counts(t) for t in texts]


def test_quality_list_learns_planted_thresholds():
    rng = np.random.default_rng(1)
    x = {"a": rng.random(4000), "b": rng.random(4000), "noise": rng.random(4000)}
    bad = (x["a"] > 0.8) & (x["b"] <= 0.5) | (x["b"] > 0.95)
    rules = quality.learn_list(x, bad)
    found = np.any([quality._covers(r, x) for r in rules], axis=0)
    assert (found == bad).mean() > 0.98 and all(len(r) <= 4 for r in rules)
    assert quality.learn_list(x, np.zeros(4000, bool)) == []


def test_quality_judges_edge_cases(spark, edge):
    labels = spark.createDataFrame([(1, 0), (1, 1), (None, 0), (9, None)], "doc_id long, quality int")
    got = quality.judge(spark, edge, labels).select("row.doc_id", "row.row", "n_words", "base_failed", "kept")
    assert got.count() == len(EDGE) and {r.kept for r in got.collect() if r.doc_id in (1, 2, 3)} == {False}
    assert quality.quality_filter(spark, edge, labels).columns == edge.columns
    assert quality.quality_filter(spark, edge.limit(0), labels.limit(0)).count() == 0


def test_language_id_held_out(spark):
    got = language_id.op2_language_id(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    pairs = [(r.lang, r.lang_pred) for r in got.join(truth, "doc_id").where("held_out").collect()]
    assert len(pairs) > 100 and language_id.accuracy(pairs) > 0.97
    assert {bool(r.held_out) for r in got.collect()} == {True, False}
    assert all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) == r.held_out for r in got.collect())


def test_language_mixture_and_edges(spark, edge):
    train = spark.createDataFrame([("the cat and the dog sat on the mat with this thing " * 20, "en"), ("le chat et le chien sont sur la table avec une chose " * 20, "fr"), (None, "xx"), ("zzz", None)], "text string, lang string")
    docs = spark.createDataFrame([(1, "the dog and the cat sat with this mat " * 30 + "la table et le chien sont avec une chose " * 30), (2, "123 ..."), (3, None), (4, "the dog")], "doc_id long, text string")
    got = {r.row.doc_id: r for r in language_id.identify(spark, docs, train).collect()}
    assert "en=" in got[1].mixture and "fr=" in got[1].mixture and 0.3 < got[1].score < 0.7
    assert got[2].lang_pred == got[3].lang_pred == "und" and got[4].lang_pred == "en" and got[4].score == 1.0
    assert {r.lang_pred for r in language_id.identify(spark, edge, train.limit(0)).collect()} == {"und"}
    assert language_id.identify(spark, edge.limit(0), train).count() == 0
    long = "word and " * 200_000
    a, n = language_id.grams(long)
    b, m = language_id.grams("word and ")
    assert a.tolist() == b.tolist() and n.tolist() == (m * 200_000).tolist()


def brute_lines(docs):
    held = collections.defaultdict(set)
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\f\r"))
    rank = lambda d: (d is None, d or 0)
    for d, t in docs:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 10:
                held[key(x)].add(d)
    gone = lambda d, x: len(held.get(key(x), ())) > 1 and min(held[key(x)], key=rank) != d
    return [(d, "\n".join(x for x in (t or "").split("\n") if not gone(d, x)), sum(gone(d, x) for x in (t or "").split("\n"))) for d, t in docs]


def test_line_dedup_matches_brute_force(spark, edge):
    rng = random.Random(3)
    pool = [f"line number {i} of the pool" for i in range(12)] + ["short", "", "  LINE number 3 of the pool\t", "Éa long line here"]
    docs = EDGE + [(i % 90, "\n".join(rng.choice(pool) for _ in range(rng.randrange(9))), "en") for i in range(100, 400)]
    frame = spark.createDataFrame(docs, DOCS).withColumn("n_lines", F.lit(7)).withColumn("id", F.lit(1)).withColumn("lines", F.lit("x"))
    got = line_dedup.drop_lines(spark, frame)
    want = brute_lines([d[:2] for d in docs])
    key = lambda t: tuple((x is None, x or "") if isinstance(x, str) or x is None else (False, x) for x in t)
    assert sorted(((r.doc_id, r.text or "", r.n_dropped) for r in got.collect()), key=lambda t: (t[0] is None, t[0] or 0, t[1], t[2])) == \
        sorted(want, key=lambda t: (t[0] is None, t[0] or 0, t[1], t[2])) and key
    assert line_dedup.drop_lines(spark, frame.limit(0)).count() == 0


def test_top_k_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    vectors = {i: rng.normal(size=6).tolist() for i in range(0, 300, 3)} | {1: [0.5] * 6, 2: [0.5] * 6, 4: [0.5] * 6, 5: [0.0] * 6, 7: [0.1, 0.2]}
    more = [(8, None), (11, [1.0, None]), (13, [float("nan")]), (14, [float("inf")]), (None, [1.0]), (1, [0.5] * 6), (50, []), (100, [1e30, -1e30])]
    frame = spark.createDataFrame(list(vectors.items()) + more, "vec_id long, embedding array<float>").withColumn("rank", F.lit(0))
    quantise = lambda v: [math.floor(256 * float(np.float32(x))) for x in v]
    vectors |= {350: [1e4, 9000.0], 16: [1e4, 8192.0], 17: [9000.0, 1e4], 19: [-1e4, 2.5e6]}
    frame = frame.unionByName(spark.createDataFrame([(i, vectors[i]) for i in (350, 16, 17, 19)], "vec_id long, embedding array<float>").withColumn("rank", F.lit(0)))
    known = [(i, quantise(v)) for i, v in vectors.items()] + [(1, quantise([0.5] * 6)), (50, []), (100, quantise([1e30, -1e30]))]
    want = []
    for q, own in known:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(own, v, strict=False)), i) for i, v in known if i != q)[:5]
            want += [(q, r + 1, i, max(-2**63, min(2**63 - 1, -s))) for r, (s, i) in enumerate(best)]
    assert rows(topk_search.exact_top_k(spark, frame, lambda i: i % 50 == 0)) == sorted(want)
    assert topk_search.exact_top_k(spark, frame.limit(0), lambda i: i % 50 == 0).count() == 0
    two = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert rows(topk_search.exact_top_k(spark, two, lambda i: i % 50 == 0)) == [(0, 1, 1, 256 * 512)]


def test_every_row_of_a_repeated_id_is_a_candidate(spark):
    given = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [0.0, 1.0]), (2, [3.0, 1.0]), (2, [3.0, 1.0]), (2, [1.0, 9.0]), (3, [2.0, 2.0]), (4, [-1.0, 0.0])]
    frame = spark.createDataFrame(given * 2 + [(7, [0.5, 0.5])] * 40, "vec_id long, embedding array<double>")
    got = rows(topk_search.exact_top_k(spark, frame, lambda i: i == 0, k=7))
    one = 256 * 256
    first = [(2, 3), (2, 3), (2, 3), (2, 3), (3, 2), (3, 2), (2, 1)]  # of [1, 0]: ties by id
    second = [(2, 9), (2, 9), (3, 2), (3, 2), (2, 1), (2, 1), (2, 1)]
    assert got == sorted((0, r + 1, i, s * one) for found in (first, second) for r, (i, s) in enumerate(found))


def test_scores_beyond_a_long_keep_their_order(spark):
    big = [1e30, 2e30, 3e30]
    given = [(0, [1e30, 0.0])] + [(i + 1, [x, 1.0]) for i, x in enumerate(big)] + [(i + 4, [-x, 1.0]) for i, x in enumerate(big)] + [(7, [1.0]), (8, [])]
    frame = spark.createDataFrame(given + [(3, [3e30, 1.0])], "vec_id long, embedding array<double>")
    got = rows(topk_search.exact_top_k(spark, frame, lambda i: i == 0, k=9), "rank", "id", "score")
    most, least = 2**63 - 1, -2**63
    assert got == [(1, 3, most), (2, 3, most), (3, 2, most), (4, 1, most), (5, 7, most), (6, 8, 0), (7, 4, least), (8, 5, least), (9, 6, least)]


def test_large_components_score_exactly(spark):
    frame = spark.createDataFrame([(0, [1e4, 9000.0]), (1, [9000.0, 1e4]), (2, [1e4, 8192.0])], "vec_id long, embedding array<double>")
    got = rows(topk_search.exact_top_k(spark, frame, lambda i: i == 0))
    want = [256 * 256 * (10**4 * 9000 + 9000 * 10**4), 256 * 256 * (10**8 + 9000 * 8192)]
    assert got == [(0, 1, 1, want[0]), (0, 2, 2, want[1])]


def brute_components(docs, n):
    sets = []
    for _, t in docs:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    parent = {d: d for d, _ in docs}
    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for (a, s), (b, t) in itertools.combinations(zip([d for d, _ in docs], sets, strict=True), 2):
        if s and t and 100 * len(s & t) >= 80 * len(s | t):
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return sorted((d, len(s), find(d)) for (d, _), s in zip(docs, sets, strict=True))


@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates_match_brute_force(spark, n):
    rng = random.Random(n)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    docs, i = [], 0
    passage = [word() for _ in range(60)]
    for g in range(12):
        base = [word() for _ in range(rng.randrange(20, 120))] + (passage if g % 3 == 0 else [])
        for _ in range(rng.choice([1, 2, 3, 40])):
            copy = list(base)
            for _ in range(rng.randrange(0, 9)):
                copy[rng.randrange(len(copy))] = word()
            docs.append((i, " ".join(copy)))
            i += 1
    docs += [(i, None), (i + 1, ""), (i + 2, "one"), (i + 3, "ONE"), (i + 4, " "), (i + 5, docs[0][1].upper())]
    rng.shuffle(docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("group", F.lit("x")).withColumn("node", F.lit(1))
    got = near_dup.near_duplicates(spark, frame, n_words=n)
    assert rows(got, "doc_id", "n_shingles", "component_id") == brute_components(docs, n)


def test_near_duplicates_edge_cases(spark, edge):
    got = near_dup.near_duplicates(spark, edge)
    assert got.count() == len(EDGE)
    assert {r.doc_id: r.component_id for r in got.collect()} == {d[0]: d[0] for d in EDGE}
    kept = near_dup.one_of_each(spark, edge)
    assert kept.columns == edge.columns and kept.count() == len(EDGE) - 1  # the repeated row goes
    assert near_dup.near_duplicates(spark, edge.limit(0)).count() == 0
    same_id = spark.createDataFrame([(1, "a b c d e f"), (1, "u v w x y z"), (2, "u v w x y z"), (3, "a b c d e f")], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_dup.near_duplicates(spark, same_id).collect()}[2] == 1


def test_one_of_each_drops_rows_by_their_own_text(spark):
    a, b, c, d, e = ("a b c d e f g", "h i j k l m n", "o p q r s t u", "v w x y z 1 2", "3 4 5 6 7 8 9")
    docs = [(None, a), (None, a.upper()), (None, b), (None, c), (None, c), (None, ""), (1, a), (2, d), (3, d), (3, e), (4, ""), (4, "x y")]
    kept = near_dup.one_of_each(spark, spark.createDataFrame(docs, "doc_id long, text string").withColumn("gone", F.lit(1)))
    assert rows(kept, "doc_id", "text") == sorted([(1, a), (2, d), (3, e), (4, ""), (4, "x y"), (None, ""), (None, b), (None, c)], key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def test_near_duplicates_are_linked_by_text_alone(spark):
    a, b = "a b c d e f g", "h i j k l m n"
    docs = spark.createDataFrame([(0, a), (1, a), (1, b), (2, b)], "doc_id long, text string")
    assert rows(near_dup.near_duplicates(spark, docs), "doc_id", "component_id") == [(0, 0), (1, 0), (1, 1), (2, 1)]


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (103, 101), (200, 200)]
    got = rows(connected_components(spark, spark.createDataFrame(links, "a long, b long")))
    assert got == sorted([(i, 0) for i in range(61)] + [(i, 100) for i in (100, 101, 103)])


def test_signatures_estimate_similarity():
    a = shingles(" ".join(f"w{i}" for i in range(1000)).encode(), 2)
    b = shingles(" ".join(f"w{i}" for i in range(111, 1111)).encode(), 2)
    real = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((near_dup.signature(a) == near_dup.signature(b)).mean() - real) < 0.15


def test_minimum_bin_slack_fills_bins():
    rng = random.Random(2)
    for capacity in (10, 64, 300):
        counts = collections.Counter(rng.randrange(1, capacity + 1) for _ in range(500))
        bins = packing.minimum_bin_slack(dict(counts), capacity)
        used = collections.Counter()
        for times, combination in bins:
            assert sum(length * n for length, n in combination) <= capacity
            for length, n in combination:
                used[length] += times * n
        total = sum(length * n for length, n in counts.items())
        assert used == counts and sum(t for t, _ in bins) <= 1.05 * total / capacity + 2
    for _ in range(50):  # the fullest bin with the longest item, against all subsets
        items = [rng.randrange(1, 40) for _ in range(9)]
        best = max(s for r in range(9) for c in itertools.combinations(sorted(items)[:-1], r) if (s := sum(c) + max(items)) <= 60)
        assert sum(length * n for length, n in packing.fullest(dict(collections.Counter(items)), 60)) == best


def test_packing_matches_the_tokenizer(spark, edge):
    path = P.path(packing.TOKENIZER)
    odd = ["H̱ ẖ İstanbul don't we'll 12ab 3.14 a—b foo—, ½ <|endoftext|> \x1c áb", "İ! ß?! l'eau,"]
    docs = edge.select("doc_id", "text").unionByName(spark.createDataFrame([(20 + i, t) for i, t in enumerate(odd)], "doc_id long, text string"))
    got = packing.pack_documents(spark, docs, path, capacity=100).collect()
    encode = packing._tokenizer(path).encode
    want = collections.Counter()
    for r in docs.collect():
        ids = [*encode(r.text or "", add_special_tokens=False).ids, 0]
        for at in range(0, len(ids), 100):
            want[r.doc_id, at // 100, at, len(ids[at:at + 100]), zlib.crc32(np.array(ids[at:at + 100], "<u4").tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by_sequence = collections.defaultdict(list)
    for r in got:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        places.sort()
        assert [o for o, _ in places] == [sum(x for _, x in places[:i]) for i in range(len(places))] and sum(x for _, x in places) <= 100
    assert packing.pack_documents(spark, edge.limit(0), path).count() == 0


def test_packing_encodes_a_word_once_for_many_texts(monkeypatch):
    path = P.path(packing.TOKENIZER)
    tokenizer, chunks, asked = packing._tokenizer(path), packing._Chunks(path), []

    def encode(texts, add_special_tokens):
        asked.append(" ".join(texts).split())
        return tokenizer.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    chunks.encode = encode
    texts = ["Harbour harbour, HARBOUR.", None, "(harbour) harbour's \u00c9tude \u00e9tude!", "", "harbour <|endoftext|> <|ENDOFTEXT|>", "Stra\u00dfe I\u0307 9 x" + "y" * 100]

    def ids(texts):
        return [np.frombuffer(x, "<u4").tolist() for x in chunks.ids([t and t.encode() for t in texts])]

    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert ids(texts) == want
    assert sum(words.count("harbour") for words in asked) == 1 and len(asked) <= 2
    monkeypatch.setattr(packing, "REMEMBERED", 3)  # forgotten in between, and texts one by one
    monkeypatch.setattr(packing, "LEARNED", 1)
    assert ids(texts[::-1]) == want[::-1] and ids(texts) == want


def test_packing_lower_cases_capitals_beside_other_letters():
    path = P.path(packing.TOKENIZER)
    tokenizer, chunks, looked_up = packing._tokenizer(path), packing._Chunks(path), []
    look_up = chunks.look_up
    chunks.look_up = lambda found: looked_up.extend(found) or look_up(found)
    marks = [c + chr(m) + " " + c + chr(m) + chr(0x323) for c in "ABEHIJKTWYZ" for m in range(0x300, 0x345)]
    texts = ["Harbour HARBOUR \u00e9t\u00e9", "\u00c9t\u00e9 harbour \u6c34 \u0130 \u1e9e \u212a \u03a3\u03a3", "J\u030c Harbour h\u0331 H\u0331", " ".join(marks), *marks[:40],
             "\u00e9 <|EndOfText|> <|endoftext|>", "A\u1ab0 A\u20dd A\ufe20 A\u05b0 A\u3099 K\u0900 E\u0483"]
    got = [np.frombuffer(x, "<u4").tolist() for x in chunks.ids([t.encode() for t in texts])]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert looked_up.count(b"harbour") == 1 and b"HARBOUR" not in looked_up


def test_alignment_remembers_pieces_that_are_asked_for(monkeypatch):
    by = alignment.Tokenizers(P.path(alignment.TOKENIZER_A), P.path(alignment.TOKENIZER_B))
    texts = [f"harbour {i} town{i}" for i in range(60)]
    want = by.encode(texts)
    for side in (by.a, by.b):
        side.known, asked, encode = {}, [], side.encode
        side.encode = lambda pieces, asked=asked, encode=encode: asked.extend(pieces) or encode(pieces)
        monkeypatch.setattr(alignment, "REMEMBERED", 24)  # forgotten in between
        got = [side([" " + t])[0] for t in texts]
        assert asked.count(" harbour") == 1 and len(side.known) + len(side.before) <= 24 + 8
        assert got == [x[side is by.b].astype(np.int32).tobytes() for x in want]


def test_pair_keys_are_distinct_and_short():
    signatures = np.array([[0, 2**32 - 1] * 32, [1, 0] * 32], np.uint32)
    tokens = near_dup._tokens(signatures)
    assert len(np.unique(tokens)) == tokens.size and (tokens >> np.uint64(40) == 0).all()


def test_packing_looks_up_a_blocks_words_by_hash(monkeypatch):
    path = P.path(packing.TOKENIZER)
    tokenizer, chunks, looked_up = packing._tokenizer(path), packing._Chunks(path), []
    look_up = chunks.look_up
    chunks.look_up = lambda found: looked_up.extend(found) or look_up(found)
    texts = ["one two one, two! one's", "TWO one. İ. क़! H̱, ΛΟΓΟΣ a\x1c!", None, "  ", "one " * 500 + "two,;"]

    def ids(texts):
        return [np.frombuffer(x, "<u4").tolist() for x in chunks.ids([t and t.encode() for t in texts])]

    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert ids(texts) == want
    assert looked_up.count(b"one") == looked_up.count(b"two") == 1 and b"one," not in looked_up and b"two!" not in looked_up
    monkeypatch.setattr(packing, "mix", lambda h: h * np.uint64(0))  # chunks of one hash are told apart
    assert ids(texts) == want


def test_packing_keeps_special_tokens(spark):
    from tokenizers import Tokenizer

    path = P.path(packing.TOKENIZER)
    texts = ["a <|endoftext|> b", "<|startoftext|>Foo<|endoftext|>bar.", "x,<|endoftext|>", "<|endoftext|>" * 3 + " <|ENDOFTEXT|> <|endoftext |>", "it's<|endoftext|>'s 12<|startoftext|>3!?"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    fresh = Tokenizer.from_file(path)
    want = {i: [*fresh.encode(x, add_special_tokens=False).ids, 0] for i, x in enumerate(texts)}
    assert want[0] == [320, 49407, 321, 0]
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in packing.token_pieces(docs, path).collect()} == want


def test_ordinal_regression_orders_grades():
    rng = np.random.default_rng(4)
    n, columns = 3000, 6
    x = (rng.random((n, columns)) < 0.3) * 1.0
    score = x @ np.array([2.0, 1.5, -1.0, 0, 0, 0]) + rng.logistic(size=n)
    grades = np.digitize(score, [0.5, 2.0, 3.0])
    r, c = np.nonzero(x)
    weights, cuts = toxicity.fit_ordinal(r, c, x[r, c], grades, columns)
    order = np.argsort(c, kind="stable")
    loss = toxicity._Loss(r[order], np.bincount(c, minlength=columns), x[r, c][order], grades)
    theta = np.concatenate((weights, cuts[:1], np.log(np.diff(cuts))))
    value, gradient = loss(theta)
    assert np.linalg.norm(gradient) <= 0.0101 * max(1, np.linalg.norm(theta))  # the fit has converged
    for at in (0, columns // 2, columns, columns + 1):  # and the gradient is the loss's
        step = 1e-5 * (np.arange(len(theta)) == at)
        assert abs((loss(theta + step)[0] - loss(theta - step)[0]) / 2e-5 - gradient[at]) < 1e-3 * max(1, abs(value))
    assert (np.diff(cuts) > 0).all() and np.abs(weights - [2.0, 1.5, -1.0, 0, 0, 0]).max() < 0.35 and np.abs(cuts - [0.5, 2.0, 3.0]).max() < 0.35


def test_toxicity_catches_and_spares(spark, edge):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.fit(spark, docs, labels.where("doc_id % 4 <> 0"))
    again = docs.unionByName(spark.createDataFrame([(1, "another text of that id")] * 3000, "doc_id long, text string").select(
        *(F.col(c) if c in ("doc_id", "text") else F.lit(None).cast(t).alias(c) for c, t in docs.dtypes)))
    assert len(toxicity.fit(spark, again, labels.where("doc_id % 4 <> 0")).weights) <= 1.1 * len(model.weights)  # one row an id is fitted
    held = toxicity.severity(spark, docs, model).select("row.doc_id", "severity", F.col("toxic").alias("said")).join(labels.where("doc_id % 4 = 0"), "doc_id").collect()
    assert not [r for r in held if r.said and not r.toxic] and all(0 <= r.severity <= 2 for r in held)
    assert sum(r.said for r in held if r.toxic) >= 0.6 * sum(1 for r in held if r.toxic)
    assert toxicity.toxicity_filter(spark, edge, labels.limit(0)).columns == edge.columns
    none = spark.createDataFrame([(4, None), (5, 1), (5, 0), (None, 1)], "doc_id long, toxic int")
    assert toxicity.toxicity_filter(spark, edge, none).count() == len(EDGE)
    assert toxicity.severity(spark, edge.limit(0), model).count() == 0


def test_beginnings_of_words():
    text = "réeuxment réeuxan ré abc abcd " * 70_000  # several blocks
    three, five = beginnings(text.encode(), (3, 5))
    words = word_hashes("rée abc réeux".encode())
    assert three.tolist() == [words[0], words[0], words[1]] * 70_000 and five.tolist() == [words[2]] * 2 * 70_000


def test_toxicity_is_caught_in_every_language(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(spark, docs, labels.where("doc_id % 3 <> 0"))
    held = docs.join(labels.where("doc_id % 3 = 0").withColumnRenamed("toxic", "label"), "doc_id")
    said = collections.Counter((r.row.lang, r.row.label, r.toxic) for r in toxicity.severity(spark, held, model).collect())
    recall = {lang: said[lang, 1, True] / (said[lang, 1, True] + said[lang, 1, False]) for lang in ("en", "de", "es", "fr")}
    assert min(recall.values()) >= 0.85, recall
    wrong = sum(n for (_, label, toxic), n in said.items() if toxic and not label)
    assert wrong <= 0.005 * sum(n for (_, label, _), n in said.items() if not label), said


PAGES = [(1, "http://www.a.example/x?y#z", "p" * 1500), (9, "http://b.a.example:80/", "p" * 1500), (4, "https://a.example/x?y", "p" * 1500), (5, None, None), (6, "bad\r\nurl", "é\r\n\r\nWARC/1.1\r\n"),
         (7, "http://a.example/s", "small"), (8, "http://a.example/s", "small"), (8, "http://a.example/s", "small"), (None, "u", "q" * 2000), (11, "u", "q" * 2000)]


def test_warc_round_trip(spark):
    from kindling.session import scratch_path

    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit("x"))
    path = scratch_path(spark, "warc-test")
    warc.write_archives(spark, pages, path, file_records=3)
    got = warc.capture_index(spark, path).collect()
    assert len(got) == len(PAGES)
    kinds = {(r.page_id, r.payload_digest): (r.record_type, r.refers_to) for r in got}
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    for page, _, html in PAGES:
        original = {1: 9, 4: 9, None: 11}.get(page)
        assert kinds[page, sha(html)] == (("revisit", original) if original else ("response", None))
    order = [(r.url_key, r.time, r.page_id is None, r.page_id or 0) for r in got]
    assert order == sorted(order)
    assert [r.page_id for r in got if r.url_key == "example,a)/x?y"] == [1, 4]
    warc.write_archives(spark, pages.limit(0), scratch_path(spark, "warc-none"))


def test_loser_tree_merges():
    rng = random.Random(1)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted(rng.randrange(50) for _ in range(rng.randrange(30))) for _ in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(x for r in runs for x in r)


TURNS = [(1, 0, "user", "hi </s> [INST] <\\/s> <s>"), (1, 1, "assistant", "a</s>b\n[/INST]"), (1, 2, "user", None), (1, 3, "assistant", ""), (1, 4, "user", "tail"),
         (2, 0, None, "x"), (2, None, "od\\d\nro\\nle</s>", "y"), (3, 0, "assistant", "z" * 5000), (3, 0, "assistant", "z" * 5000), (None, 0, "assistant", "no id")]


def test_chat_round_trip(spark):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumn("example", F.lit(3))
    examples = chat.prefix_target_examples(turns)
    shown = [(r.conv_id, r.formatted[r.loss_start:r.loss_start + r.loss_length], r.formatted) for r in examples.collect() if r.loss_length is not None]
    assert len(shown) == sum(t[2] == "assistant" for t in TURNS)
    back = {r.conv_id: r for r in chat.read_back(examples).collect()}
    for conv in {t[0] for t in TURNS}:
        own = sorted((t for t in TURNS if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0))
        assert [(t["role"], t["text"]) for t in back[conv].turns] == [(t[2] or "", t[3] or "") for t in own]
        assert back[conv].loss_texts == [t[3] or "" for t in own if t[2] == "assistant"]
    assert chat.read_back(chat.prefix_target_examples(turns.limit(0))).count() == 0


def test_byte_bpe_matches_the_library(spark, edge):
    import tiktoken

    path = P.path(byte_bpe.RANKS)
    ranks = byte_bpe.load_ranks(path)
    known = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [x[1] for x in EDGE] + ["a" * 3000, " " * 700 + "x", "日本語テキスト🙂🙂", "don't we'LL \x1c\x85 x", "\n\n \t\n a", "🙂" * 300, "thntntly Anatea"]
    assert [x.tolist() for x in byte_bpe.encode_texts(texts, path)] == [known.encode_ordinary(t or "") for t in texts]
    pieces = [p for t in texts for p in P and byte_bpe._splitter(P.PATTERN)(t or "")]
    assert all(byte_bpe.merge(p.encode(), ranks) == known.encode_ordinary(p) for p in set(pieces))
    coded = byte_bpe.decode(byte_bpe.encode(edge, path), path).select("row.doc_id", "decoded").collect()
    assert collections.Counter((r.doc_id, bytes(r.decoded)) for r in coded) == collections.Counter((d[0], (d[1] or "").encode()) for d in EDGE)
    assert byte_bpe.encode(edge.limit(0), path).count() == 0
