"""Token counts, cross-tokenizer alignment and importance resampling against libraries, brute force, SQL and edge cases."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kindling.llm import alignment, importance, token_counts
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, row string, n_words int, key string"
LONG = "é word " * 3000 + "x" * 5000 + "漢字" * 500
TEXTS = [None, "", " \t\n\x0b ", "a", "The cat's  sat\n\n on 12 mats!", "a <|endoftext|> b", "x▁y", "two  spaces ", "naïve 😀👩‍👧 한국어 \x1c\x85　 end", LONG]
EDGE = [(i, t, "r", i, "k") for i, t in enumerate(TEXTS)] + [(None, "no id here", "r", 0, "k"), (4, TEXTS[4], "r", 0, "k"), (4, TEXTS[4], "r", 0, "k")]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, DOCS)


def mixed(n, seed=3):
    rng = random.Random(seed)
    wide = [chr(c) for c in range(128)] + list("éßñ  áüœæ漢字かな한국어абвг   ​᠎\x85　 ٣४五😀👩‍🎓́▁ǅʰªº²½Ⅷ﻿")
    return ["".join(rng.choice(wide if i % 3 else wide[:128]) for _ in range(rng.choice([3, 10, 40]))) for i in range(n)]


# Token counts

def library_counts(texts):
    return [len(e.ids) for e in Tokenizer.from_file(P.path(token_counts.TOKENIZER)).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_token_counts_equal_the_library():
    texts = mixed(6000) + ["a" * 1000, "ab" * 3000, "<|endoftext|>", "<|endoftext|><|endoftext|>x <|endoftext|", *TEXTS]
    assert token_counts.count_texts(texts, P.path(token_counts.TOKENIZER)) == library_counts(texts)


def one_at_a_time(symbols, ranks):
    """The definition: again and again the leftmost of the pairs of least rank merges."""
    while found := [(ranks[p], i) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)) if p in ranks]:
        _, i = min(found)
        symbols = symbols[:i] + [symbols[i] + symbols[i + 1]] + symbols[i + 2:]
    return len(symbols)


@pytest.mark.parametrize("ordered", [True, False])
def test_ragged_merging_equals_one_merge_at_a_time(ordered):
    rng = random.Random(5)
    for _ in range(30):
        known, merges = list("abc"), []
        while len(merges) < 12:
            a, b = rng.choice(known), rng.choice(known)
            if a + b not in known:
                known.append(a + b)
                merges.append((a, b))
        if not ordered:
            rng.shuffle(merges)
        rules = token_counts.Merges({t: i for i, t in enumerate(known)}, merges)
        assert rules.ordered or not ordered
        words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 30))) for _ in range(60)] + ["aaaaaaa", "a"]
        got = token_counts.surviving(np.frombuffer("".join(words).encode(), np.uint8), np.array(list(map(len, words))), rules)
        ranks = {p: r for r, p in enumerate(merges)}
        assert got.tolist() == [one_at_a_time(list(w), ranks) for w in words]


def test_token_counts_of_edge_rows(spark, edge):
    got = rows(token_counts.count_tokens(edge, P.path(token_counts.TOKENIZER)).select("row.doc_id", "row.row", "n_bytes", "n_tokens"))
    want = [(i, "r", len((t or "").encode()), n) for (i, t, *_), n in zip(EDGE, library_counts([e[1] for e in EDGE]), strict=True)]
    assert got == sorted(want, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))
    assert token_counts.count_tokens(edge.limit(0), P.path(token_counts.TOKENIZER)).count() == 0


def test_token_counts_query_equals_the_library(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = [(d.doc_id, len((d.text or "").encode()), n, n > 512) for d, n in zip(docs, library_counts([d.text for d in docs]), strict=True)]
    assert rows(token_counts.op13_token_counts(spark, SF)) == sorted(want)


# Importance resampling

def brute_resample(docs, target, buckets, max_words, percent, min_words, seed):
    def features(t):
        t = "".join(c.lower() if c.isascii() else c for c in t or "")
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", t)
        return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets for k in range(1, max_words + 1) for i in range(len(w) - k + 1)]

    found = [features(t) for _, t in docs]
    s, t = collections.Counter(b for _, f in found for b in f), collections.Counter(b for x in target for b in features(x)[1])
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    out = []
    for (i, _), (n, f) in zip(docs, found, strict=True):
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in f)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    fit = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, -r[2]))
    for place, r in enumerate(fit[:len(fit) * percent // 100], 1):
        r[5] = place
    return sorted(map(tuple, out), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[5] is None, r[5] or 0))


@pytest.mark.parametrize("max_words", [1, 3])
def test_resampling_matches_brute_force(spark, edge, max_words):
    target = spark.createDataFrame([("The cat sat on mats",), (None,), ("naïve word 12",)], "text string")
    got = importance.resample(spark, edge, target, percent=60, min_words=1, buckets=100, max_words=max_words, seed=7)
    want = brute_resample([e[:2] for e in EDGE], ["The cat sat on mats", None, "naïve word 12"], 100, max_words, 60, 1, 7)
    assert sorted(map(tuple, got.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[5] is None, r[5] or 0)) == want
    assert importance.resample(spark, edge.limit(0), target).count() == 0
    assert importance.resample(spark, edge, target.limit(0)).where("rank is not null").count() == 0


def test_bit_planes_give_exact_weights():
    rng = np.random.default_rng(2)
    gains = rng.integers(-20_000, 20_000, 777)
    counts = rng.integers(0, 9, (40, 777)) * (rng.random((40, 777)) < 0.2)
    counts[3, 5], counts[4] = 10**12, 0  # a very long text, and one without words
    assert importance.Gains(gains).weights(counts) == [int(sum(int(c) * int(g) for c, g in zip(row, gains, strict=True))) for row in counts]
    assert (np.unpackbits(importance.planes(counts[:1]).view(np.uint8), bitorder="little").reshape(-1, 832)[:, :777].T @ (1 << np.arange(importance.planes(counts[:1]).shape[1])) == counts[0]).all()


def test_resampling_query_matches_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(importance.OP11_SQL).fetchall()
    got = [tuple(r) for r in importance.op11_importance_resampling(spark, SF).collect()]
    assert sorted(got, key=lambda r: r[0]) == sorted(want, key=lambda r: r[0])
    assert any(r[4] for r in want)


# Alignment

@pytest.fixture(scope="module")
def paths():
    return P.path(alignment.TOKENIZER_A), P.path(alignment.TOKENIZER_B)


def brute_align(texts, paths):
    by = alignment.load(*paths)
    found = []
    for t in texts:
        a, b = by.encode([t or ""])[0]
        ends_a, ends_b = (np.cumsum([len(side.tokens[i]) for i in ids]).tolist() for side, ids in ((by.a, a), (by.b, b)))
        cuts = sorted(set(ends_a) & set(ends_b))
        parts = [tuple([i for i, e in zip(ids, ends, strict=True) if low < e <= cut] for ids, ends in ((a, ends_a), (b, ends_b)))
                 for low, cut in zip([0, *cuts], cuts, strict=False)]
        found.append((len(a), len(b), parts))
    links = [[(x, y) for a, b in parts for x in a for y in b] for *_, parts in found]
    count = collections.Counter(p for some in links for p in set(some))
    most = collections.Counter()
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    return [(a, b, len(parts), len(some), ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in parts),
             sum(count[p] == most[p[0]] for p in some), sum(count[p] for p in some)) for (a, b, parts), some in zip(found, links, strict=True)], count, most


def test_sparse_products_match_dense(monkeypatch):
    monkeypatch.setattr(alignment, "TERMS", 20)  # many blocks of rows
    rng = np.random.default_rng(4)
    for _ in range(20):
        a, b = (rng.integers(0, 4, shape) * (rng.random(shape) < 0.4) for shape in ((9, 7), (7, 11)))
        x, y = (alignment.Csr.of(*np.nonzero(m), m[np.nonzero(m)], *m.shape) for m in (a, b))
        dense = np.zeros((9, 11), int)
        for row, column, value in alignment.product(x, y):
            dense[row, column] += value
        assert (dense == a @ b).all()
        back = y.transposed()
        again = np.zeros((11, 7), int)
        again[back.rows, back.columns] = back.values
        assert (again == b.T).all()


def test_overlaps_are_shared_bytes():
    a, b = np.array([2, 3, 9, 10]), np.array([1, 3, 5, 10])
    assert list(zip(*map(np.ndarray.tolist, alignment.overlaps(a, b)), strict=True)) == [
        (0, 0, 1), (0, 1, 1), (1, 1, 1), (2, 2, 2), (2, 3, 4), (3, 3, 1)]
    assert [g.tolist() for g in alignment.groups(a, b)] == [[0, 0, 1, 1], [0, 0, 1, 1]]


def test_alignment_of_edge_rows_matches_brute_force(spark, edge, paths):
    documents, pairs = alignment.align(spark, edge, *paths)
    want, count, most = brute_align([e[1] for e in EDGE], paths)
    got = documents.select("row.doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((e[0], *w) for e, w in zip(EDGE, want, strict=True)), key=repr)
    assert want[0][:4] == want[1][:4] == want[6][:4] == (0, 0, 0, 0) and want[9][0] > 3000  # null, empty, not spelled back, long
    assert sorted(map(tuple, pairs.collect())) == sorted((a, b, n, n == most[a]) for (a, b), n in count.items())
    nothing, none = alignment.align(spark, edge.limit(0), *paths)
    assert nothing.count() == none.count() == 0


def test_ids_are_those_of_the_libraries_on_whole_texts(paths):
    from sentencepiece import SentencePieceProcessor

    a, b, by = Tokenizer.from_file(paths[0]), SentencePieceProcessor(model_file=paths[1]), alignment.load(*paths)
    a.encode_special_tokens = True
    texts = [t for t in mixed(4000, 9) + TEXTS + [" ".join(mixed(400, 11)), "   three  spaces   ", "<s> </s> <unk> <0x41>"] if t]
    spelled = 0
    for text, (x, y) in zip(texts, by.encode(texts), strict=True):
        whole = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        same = all(b"".join(side.tokens[i] for i in ids) == b" " + text.encode() for side, ids in zip((by.a, by.b), whole, strict=True))
        assert (x.tolist(), y.tolist()) == (whole if same else ([], []))
        spelled += same
    assert len(texts) // 2 < spelled < len(texts)


def test_alignment_looks_up_a_chunk_once_for_many_texts(paths, monkeypatch):
    by = alignment.Tokenizers(*paths)
    a, b = Tokenizer.from_file(paths[0]), by.b.encode
    looked_up, look_up = [], by.a.look_up
    by.a.look_up = lambda chunks: looked_up.extend(chunks) or look_up(chunks)
    texts = ["one two one", "two one two ", "", " ", "   ", "one\n two", "\n", " one\n  two\u00a0 one\u3000  two", "it's \u201cone\u201d two\u2003 \u0085 x\x1c y", "one's " * 300,
             "\u00e9t\u00e9 \u6c34\u3001 \u6c34 \u3042 two", "a\t b \r\n c\u1680  d\u2009 e"]
    want = []
    for text in texts:
        x, y = a.encode(" " + text).ids if text else [], b([" " + text]) if text else []
        spelled = all(b"".join(side.tokens[i] for i in ids) == (b" " + text.encode()) for side, ids in ((by.a, x), (by.b, y)))
        want.append((x, y) if text and spelled else ([], []))

    def ids():
        return [(x.tolist(), y.tolist()) for x, y in by.encode(texts)]

    assert ids() == want and sum(bool(x) for x, _ in want) > 5
    assert looked_up.count(b" one") == looked_up.count(b" two") == looked_up.count(b" one's") == 1
    monkeypatch.setattr(alignment, "TOGETHER", 7)  # chunks hashed and compared in many parts
    assert ids() == want
    monkeypatch.setattr(alignment, "mix", lambda h: h * np.uint64(0))  # chunks of one hash are told apart
    assert ids() == want


def test_a_stretch_without_common_ends_is_one_group(paths):
    by = alignment.load(*paths)
    texts = ["-" * 4999 + "=" * 3001, "plain text", "", "=" * 77]
    found = alignment.Aligned(by.encode(texts), by)
    want = brute_align(texts, paths)[0]
    assert found.written_out() == [w[4] for w in want] and found.n_links.tolist() == [w[3] for w in want]
    times = np.zeros(len(texts), int)
    for doc, _, _, n in found.pairs():
        np.add.at(times, doc, n)
    assert times.tolist() == [w[3] for w in want]


def test_alignment_query_matches_brute_force(spark, paths):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = [(d.doc_id, *w[:4], *w[5:], hashlib.sha256(w[4].encode()).hexdigest() if w[0] else "") for d, w in zip(docs, brute_align([d.text for d in docs], paths)[0], strict=True)]
    assert rows(alignment.op12_cross_tokenizer_alignment(spark, SF)) == sorted(want)


def test_byte_characters_are_all_bytes():
    of = token_counts.byte_characters()
    assert sorted(of.values()) == list(range(256)) and len(of) == 256 and of["Ġ"] == 32
