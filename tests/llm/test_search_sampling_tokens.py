"""Ranked search, importance resampling and longest-match BPE against brute force and on edge cases."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from conftest import SF_SMALL
from quarry.llm import catalog, importance, longest_match_bpe, signature_search

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
LONG = " ".join(f"w{k % 977}" for k in range(60000))
ODD = [(1, None), (2, ""), (3, " \n\t\n "), (4, "One two"), (5, LONG), (6, LONG), (6, LONG), (None, LONG), (7, "é" * 30),
       (8, "<|endoftext|> password = hunter22x"), (9, "\x1c\x85 a b 日本語 👍🏽 \r\n x  y ÀÉ K"), (10, "a" * 5000 + " " * 3000),
       (11, "x" * 200 + " " + "x" * 201), (None, None), (12, "one two " * 40)]
#: Further columns whose names the operators use themselves.
EXTRA = "doc_id long, text string, ids string, rank string, score string, block string, bucket string, n_words string"


def odd(spark):
    return spark.createDataFrame([(d, t, *["x"] * 6) for d, t in ODD], EXTRA)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- tokens --------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def want_tokens(library, rows):
    out = []
    for doc, text in rows:
        ids = library.encode_ordinary(text or "")
        out.append((doc, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def test_tokens_equal_the_library(spark, library):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert rows_of(catalog.QUERIES["op11_longest_match_bpe"](spark, SF_SMALL)) == want_tokens(
        library, [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert rows_of(longest_match_bpe.round_trip(odd(spark), RANKS, PATTERN)) == want_tokens(library, ODD)
    assert longest_match_bpe.round_trip(odd(spark).limit(0), RANKS, PATTERN).count() == 0
    ids = longest_match_bpe.encode(odd(spark), RANKS, PATTERN)
    assert rows_of(ids) == sorted(((d, library.encode_ordinary(t or "")) for d, t in ODD), key=repr)
    back = longest_match_bpe.decode(ids, RANKS, PATTERN)
    assert sorted(((r[0], bytes(r[1])) for r in back.collect()), key=repr) == sorted(((d, (t or "").encode()) for d, t in ODD), key=repr)


def test_slices_of_long_texts_change_nothing(library, monkeypatch):
    monkeypatch.setattr(longest_match_bpe, "SLICE", 5)
    own = longest_match_bpe.Encoder(RANKS, PATTERN)
    for _, text in ODD:
        assert list(own.encode(text or "")) == library.encode_ordinary(text or "")


def test_pieces_of_random_bytes_equal_merging(library):
    own = longest_match_bpe.Encoder(RANKS, PATTERN).ranks
    labels, rng = list(own.tokens), random.Random(5)
    for k in range(3000):
        raw = (b"".join(rng.choice(labels) for _ in range(rng.randint(1, 6))) if k % 2
               else bytes(rng.choice(b"ab \n1aeth\xc3\xa9") for _ in range(rng.randint(1, 60))))
        if raw not in own.tokens:
            assert own.encode(raw) == library._core_bpe.encode_single_piece(raw)


def test_small_vocabulary_equals_merging_in_rank_order():
    """Every string over a few letters, by merging the lowest rank first."""
    labels = [b"a", b"b", b"c", b"ab", b"bc", b"abc", b"ca", b"aa", b"aaa", b"bca", b"cab", b"zzz"]
    tokens = {t: k for k, t in enumerate(labels)}
    own = longest_match_bpe.Ranks(tokens)
    assert own.halves[tokens[b"zzz"]] is None
    rng = random.Random(1)
    for _ in range(2000):
        raw = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 12)))
        parts = [raw[k:k + 1] for k in range(len(raw))]
        while True:
            found = [(tokens[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in tokens]
            if not found:
                break
            _, k = min(found)
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        assert own.encode(raw) == [tokens[p] for p in parts], raw


# --- words ---------------------------------------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def test_words_are_the_same_by_bytes():
    for _, text in ODD:
        assert [w.decode() for w in importance.split(text)] == words(text)


# --- search --------------------------------------------------------------------------------------------------------

def brute_search(docs, items, k):
    docs = [(d, Counter(words(t))) for d, t in docs]
    docs = [(d, c, sum(c.values())) for d, c in docs if c]
    n_docs, n_terms = len(docs), sum(n for *_, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    own = {}
    for item, text in items:
        own.setdefault(item, set()).update(words(text))
    out = []
    for item, terms in own.items():
        found = []
        for d, c, n in docs:
            m = 100 - 50 + (50 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("k", [3, 50])
def test_search_equals_brute_force_with_ties_and_copies(spark, k):
    rng = random.Random(7)
    vocabulary = [f"t{n}" for n in range(300)] + ["é", "日本", "y" * 90, "y" * 91]
    docs = [(n, " ".join(rng.choices(vocabulary, [1 / (v + 1) for v in range(len(vocabulary))], k=rng.choice([1, 5, 40, 400]))))
            for n in range(400)]
    docs += [(n + 1000, docs[n % 3][1]) for n in range(150)] + ODD
    items = [(n, " ".join(rng.sample(vocabulary, 12))) for n in range(15)]
    items += [(20, None), (21, "nowhere"), (22, docs[0][1]), (23, "one"), (23, "two"), (24, LONG), (25, "y" * 91), (None, "t1 t2")]
    frame = spark.createDataFrame([(d, t, *["x"] * 6) for d, t in docs], EXTRA).repartition(5)
    assert rows_of(signature_search.search(frame, items_of(spark, items), k)) == brute_search(docs, items, k)


def test_search_in_several_blocks_of_items_and_on_empty_tables(spark, monkeypatch):
    docs = [(n, f"a{n % 7} b{n % 5} common") for n in range(60)]
    items = [(n, f"a{n % 7} b{n} common") for n in range(12)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    monkeypatch.setattr(signature_search, "BLOCK_TERMS", 8)
    assert rows_of(signature_search.search(frame, items_of(spark, items), 4)) == brute_search(docs, items, 4)
    assert signature_search.search(frame.limit(0), items_of(spark, items)).count() == 0
    assert signature_search.search(frame, items_of(spark, items).limit(0)).count() == 0


def test_bounds_are_never_below_scores_and_exclude_most(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    rows = [(r["item_id"], sorted(set(signature_search.terms(r["text"]))))
            for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    counts = {d: Counter(signature_search.terms(t)) for d, t in docs}
    df = Counter(t for c in counts.values() for t in c)
    n_docs, n_terms = sum(map(bool, counts.values())), sum(sum(c.values()) for c in counts.values())
    items = signature_search.Items(rows, df, n_docs, n_terms)
    scores, slack = 0, 0
    for group in signature_search._block(docs).to_pylist():
        bound = items.bounds(group)
        for place, doc in enumerate(group["doc_ids"]):
            for item in range(len(rows)):
                exact = items.score(counts[doc], sum(counts[doc].values()), item)
                assert bound[item, place] >= exact
                scores, slack = scores + exact, slack + bound[item, place] - exact
    assert slack < 0.2 * scores


# --- resampling ----------------------------------------------------------------------------------------------------

def brute_resample(docs, target, share=Fraction(5, 100), least=20):
    def buckets(text):
        w = words(text)
        return [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(buckets(text))
    for _, text in target:
        t.update(buckets(text))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10000) / ((s[b] + 1) * (t.total() + 10000)))) for b in range(10000)]
    rows = []
    for doc, text in docs:
        own = buckets(text)
        weight, score = sum(gain[b] for b in own), None
        if doc is not None:
            h = int(hashlib.sha256(f"42:{doc}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc, len(own), weight, score, len(words(text))))
    able = sorted((-r[3], r[0], k) for k, r in enumerate(rows) if r[3] is not None and r[4] >= least)
    rank = {k: n for n, (*_, k) in enumerate(able[:share.numerator * len(able) // share.denominator], 1)}
    return sorted(((*r[:4], rank.get(k)) for k, r in enumerate(rows)), key=repr)


def test_resampling_equals_brute_force_on_odd_rows(spark, monkeypatch):
    rng = random.Random(2)
    docs = [(n % 150, " ".join(f"v{rng.randint(0, 60)}" for _ in range(rng.randint(15, 40)))) for n in range(200)]
    docs += [(500, "same words here " * 10)] * 80 + ODD
    target = [(1, "v1 v2 v3 V4"), (2, None), (3, "same words here")]
    frame = spark.createDataFrame([(d, t, *["x"] * 6) for d, t in docs], EXTRA).repartition(4)
    for n in (1 << 18, 7):
        monkeypatch.setattr(importance, "SLICE", n)
        got = rows_of(importance.resample(frame, items_of(spark, target), Fraction(1, 2)))
        assert got == brute_resample(docs, target, Fraction(1, 2))
    assert importance.resample(frame.limit(0), items_of(spark, target)).count() == 0
    assert rows_of(importance.resample(frame, items_of(spark, target).limit(0))) == brute_resample(docs, [])
