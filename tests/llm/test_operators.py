"""The corpus operators against brute force, on the small tables and on edge cases."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF_SMALL
from quarry.llm import (bpe, catalog, factorisation_machine, jaccard_join, line_dedup, packing, secret_scan, url_filters,
                        vector_search, warc)

EMPTY_SHA = hashlib.sha256(b"").hexdigest()
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, spans string"
LONG = " ".join(f"w{k % 977}" for k in range(60000))
ODD = [(1, None), (2, ""), (3, " \n\t\n "), (4, "one two"), (5, LONG), (6, LONG), (6, LONG), (None, LONG), (7, "é" * 30),
       (8, "<|endoftext|> password = hunter22x\nA line of text here\n"), (9, "\x1c\x85 a b 日本語 👍🏽 \r\n x  y"),
       (10, "A line of TEXT here \nother words stay"), (None, None)]


def odd(spark):
    return spark.createDataFrame([(d, t, None, None, None, "x", "y") for d, t in ODD], DOCS)


def text_of(t):
    return t or ""


def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_sql_agreement(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = catalog.QUERIES[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    ours = sorted(repr(tuple(r[c] for c in cols)) for r in df.collect())
    rel = con.sql(catalog.ORACLE_SQL[name])
    at = {c: i for i, c in enumerate(rel.columns)}
    assert sorted(at) == cols
    assert ours == sorted(repr(tuple(r[at[c]] for c in cols)) for r in rel.fetchall())


def test_lists_are_evaluated_at_fetch_time(spark):
    changes = spark.createDataFrame([("l", "b.com", "add", 10), ("l", "b.com", "remove", 20), ("l", "b.com", "add", 20),
                                     ("l", "b.com", "add", 30), ("m", "x.b.com/p", "add", 0), ("l", None, "add", 0),
                                     ("l", "c.com", "add", None)],
                                    "list string, key string, action string, changed_at int")
    captures = spark.createDataFrame([(1, "http://x.b.com/q", 9), (2, "http://X.b.com:80/q", 10), (3, "http://b.com", 20),
                                      (4, "https://b.com/", 30), (5, "http://x.b.com/p/r", 5), (6, None, 5),
                                      (7, "http://b.com", None), (8, "http://b.com", 99), (8, "http://b.com", 99),
                                      (9, "http://ab.com", 99)], "page_id long, url string, fetched_at int")
    got = {r["page_id"]: (r["lists"], r["blocked"], r["n_captures"])
           for r in url_filters.url_filter(captures, changes).collect()}
    assert got == {1: ("", False, 1), 2: ("l", True, 1), 3: ("", False, 1), 4: ("l", True, 1), 5: ("m", True, 1),
                   6: ("", False, 1), 7: ("", False, 1), 8: ("l", True, 2), 9: ("", False, 1)}
    assert url_filters.url_filter(captures.limit(0), changes).count() == 0
    assert url_filters.url_filter(captures, changes.limit(0)).where("blocked").count() == 0


def test_search_equals_brute_force_with_ties_and_bad_vectors(spark):
    rng = random.Random(3)
    rows = [(i, [float(rng.randint(-2, 2)) / 8 for _ in range(6)], None) for i in range(300)]
    rows += [(400, None, 1), (401, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (402, [float("nan")] * 6, 1), (403, [float("inf")] * 6, 1),
             (500, [0.5, 0.5], 1), (501, [0.25, 0.5], 1), (None, [0.0] * 6, 1), (350, [1e6] * 6, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int").repartition(3)
    got = sorted(tuple(r) for r in vector_search.top_k(df, F.col("vec_id") % 50 == 0).collect())
    good = {i: np.floor(256 * np.array(v)).astype(np.int64) for i, v, _ in rows
            if i is not None and v is not None and None not in v and np.isfinite(v).all()}
    want = []
    for q in (i for i in good if i % 50 == 0):
        found = sorted((-int(good[q] @ v), i) for i, v in good.items() if i != q and len(v) == len(good[q]))[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(found)]
    assert got == sorted(want)
    assert vector_search.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_classifier_separates_held_out_labels_and_scores_everything(spark):
    d = SF_SMALL.replace("0.001", "0.01")
    out = catalog.op3_quality_classifier(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out")
    rows = out.select("quality", "score", "predicted").collect()
    good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.9
    assert np.mean([r["quality"] == r["predicted"] for r in rows]) > 0.85
    labels = spark.createDataFrame([(5, 1, 0), (6, 0, 0), (2, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = factorisation_machine.quality_classifier(odd(spark), labels).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert factorisation_machine.quality_classifier(odd(spark), labels.limit(0)).where("score <> 0.5").count() == 0
    assert factorisation_machine.quality_classifier(odd(spark).limit(0), labels).count() == 0


def test_machine_identity():
    rng = np.random.default_rng(0)
    w, v = rng.normal(size=factorisation_machine.WIDTH), rng.normal(size=(factorisation_machine.WIDTH, 3))
    index, x = np.array([1, 5, 9]), np.array([0.5, -1.0, 2.0])
    pairs = sum(v[index[a]] @ v[index[b]] * x[a] * x[b] for a in range(3) for b in range(a + 1, 3))
    assert np.isclose(factorisation_machine.Model(0.2, w, v).raw(index, x), 0.2 + w[index] @ x + pairs)


def test_warc_edges_and_damage(spark):
    long = "x" * 200
    rows = [(3, "http://a\r\nb", long), (2, None, long), (2, None, long), (None, "u", long), (5, "u", None), (6, "u", ""),
            (7, "u", "é" * 50), (8, "u", "é" * 50), (9, "u", "short"), (10, "u", "short"), (11, "u", "\r\n\r\n" * 40)]
    pages = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, digest string")
    got = warc.warc_round_trip(pages).collect()
    assert len(got) == len(rows)
    kinds = sorted((str(r["page_id"]), r["record_type"], r["refers_to"], r["payload_bytes"]) for r in got)
    assert kinds == sorted([("3", "revisit", 2, 200), ("2", "response", None, 200), ("2", "response", None, 200),
                            ("None", "revisit", 2, 200), ("5", "response", None, 0), ("6", "response", None, 0),
                            ("7", "response", None, 100), ("8", "revisit", 7, 100), ("9", "response", None, 5),
                            ("10", "response", None, 5), ("11", "response", None, 160)])
    assert {r["payload_digest"] for r in got} == {hashlib.sha256(text_of(h).encode()).hexdigest() for _, _, h in rows}
    assert warc.warc_round_trip(pages.limit(0)).count() == 0
    data = warc.record(1, "u", b"hello", hashlib.sha256(b"hello").hexdigest(), None)
    assert warc.parse(data)["payload"] == b"hello"
    for broken in (data.replace(b"hello", b"hellx"), data[:-1], b"GET / HTTP\r\n\r\n"):
        with pytest.raises(ValueError):
            warc.parse(broken)


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(1).integers(0, 2 ** 63, 20000, dtype=np.uint64))
    h = line_dedup.PerfectHash(keys)
    assert sorted(h(keys)) == list(range(len(keys)))
    shard = line_dedup.Shard.from_bytes(line_dedup.Shard(keys, keys + np.uint64(1), np.full(len(keys), 2), np.arange(len(keys))).to_bytes())
    found, first = shard.first_documents(keys, keys + np.uint64(1))
    assert found.all() and (first == np.arange(len(keys))).all()
    assert not shard.first_documents(keys, keys)[0].any()


def test_line_dedup_edges_in_many_shards(spark):
    keys = defaultdict(set)

    def key(line):
        k = line.strip(" \t\n\x0b\x0c\r")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in k)

    for d, t in ODD:
        for line in text_of(t).split("\n"):
            if d is not None and len(key(line)) >= 10:
                keys[key(line)].add(d)
    want = []
    for d, t in ODD:
        lines = text_of(t).split("\n")
        kept = [x for x in lines if d is None or len(keys.get(key(x), ())) < 2 or min(keys[key(x)]) == d]
        want.append((str(d), len(lines), len(lines) - len(kept), "\n".join(kept)))
    for shard_keys in (1, 1 << 19):
        out = line_dedup.drop_repeated_lines(odd(spark), shard_keys)
        assert set(odd(spark).columns) < set(out.columns)
        assert sorted((str(r["doc_id"]), r["n_lines"], r["n_dropped"], r["text"]) for r in out.collect()) == sorted(want)
    assert line_dedup.line_dedup(odd(spark).limit(0)).count() == 0


def brute_spans(text):
    kinds = [("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
              re.I | re.A, lambda m: len(m[2]) >= 6),
             ("access", r"AKIA[A-Z0-9]+", 0, lambda m: len(m[0]) >= 20), ("hex", r"[0-9a-f]+", 0, lambda m: len(m[0]) >= 24)]
    return sorted((m.start(), k, name, m.end()) for k, (name, p, f, ok) in enumerate(kinds)
                  for m in re.finditer(p, text, f) if ok(m))


def test_secret_scan_equals_plain_expressions(spark):
    extra = ["API-key apikey='abcdef' API_KEY: 123456 apıkey=999999 ſecret=abcdefg", "AKIAAKIA" + "Z" * 12 + " AKIA12",
             "é" * 5 + "f" * 23 + " " + "0" * 24, "token = ab token=abcdef", "ghp_" + "a" * 36, "pass", "pas", "sword = abcdef"]
    docs = documents(spark).select("doc_id", "text").union(
        spark.createDataFrame([(-k - 1, t) for k, t in enumerate([*extra, None, ""])], "doc_id long, text string"))
    texts = {r["doc_id"]: text_of(r["text"]) for r in docs.collect()}
    seen = 0
    for r in secret_scan.secret_scan(docs).collect():
        want = brute_spans(texts[r["doc_id"]])
        seen += len(want)
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(w[2] == k for w in want) for k in ("assign", "access", "hex")]
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, k, b in want).encode()).hexdigest()
        assert {f"{k}:{a}:{b}" for a, _, k, b in want} <= set(r["spans"].split(",")) | {""}
    assert seen > 5
    masked = {r["doc_id"]: r["text"] for r in secret_scan.redact(odd(spark)).collect()}
    assert masked[8] == "<|endoftext|> [ASSIGN]\nA line of text here\n" and masked[5] == LONG
    assert secret_scan.secret_scan(odd(spark).limit(0)).count() == 0


def test_trigram_queries():
    assert secret_scan.trigram_query("[0-9a-f]{24,}") == secret_scan.ANY
    assert secret_scan.trigram_query("AKIA[A-Z0-9]{16,}") == ("and", (("tri", "aki"), ("tri", "kia")))
    assert secret_scan.trigram_query("(abc|xyz)?q") == secret_scan.ANY
    assert secret_scan.trigram_query("(abc|xyz)[0-9]+") == ("or", (("tri", "abc"), ("tri", "xyz")))


def library():
    return Tokenizer.from_file(public_tokenizers.path(catalog.TOKENIZER))


def test_bpe_equals_the_library(spark):
    rng = random.Random(5)
    noise = ["".join(rng.choice("aaabthe  ingé\n\t\x1c 日0189'sS.,-_👍") for _ in range(300)) for _ in range(200)]
    runs = ["a" * 5000, " " * 3000, "=" * 999, "ab" * 700, "<|endoftext|>" * 3 + " <|endoftext|", "Åẞ\U0001f1e9"]
    docs = documents(spark).select("doc_id", "text").union(odd(spark).select("doc_id", "text")).union(
        spark.createDataFrame([(k, t) for k, t in enumerate(noise + runs)], "doc_id long, text string"))
    own = library()
    want = []
    for r in docs.collect():
        ids = own.encode(text_of(r["text"]), add_special_tokens=False).ids
        want.append((str(r["doc_id"]), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(own.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    got = bpe.tokenise(docs, public_tokenizers.path(catalog.TOKENIZER), public_tokenizers.PATTERN).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)


def check_pieces(rows, texts):
    """``texts``: list of texts by doc_id; each copy has the same ids."""
    own = library()
    ids = {d: own.encode(text_of(t[0]), add_special_tokens=False).ids + [0] for d, t in texts.items()}
    seen, sequences = defaultdict(int), defaultdict(list)
    for r in rows:
        piece = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(piece) == r["length"] > 0 and r["doc_tokens"] == len(ids[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(np.array(piece, "<u4").tobytes())
        for k in range(r["start"], r["start"] + r["length"]):
            seen[r["doc_id"], k] += 1
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert seen == {(d, k): len(texts[d]) for d in ids for k in range(len(ids[d]))}
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert sum(sum(n for _, n in p) < 1024 for p in sequences.values()) <= 1


def test_packing_keeps_each_id_once(spark):
    for docs in (documents(spark), odd(spark)):
        texts = defaultdict(list)
        for r in docs.collect():
            texts[r["doc_id"]].append(r["text"])
        if None in texts:  # two texts share the NULL id
            docs, texts = docs.where("doc_id is not null"), {d: t for d, t in texts.items() if d is not None}
        check_pieces(packing.pack(docs, public_tokenizers.path(catalog.TOKENIZER), public_tokenizers.PATTERN).collect(), texts)
    assert packing.pack(odd(spark), public_tokenizers.path(catalog.TOKENIZER), public_tokenizers.PATTERN).where("doc_id is null").count() > 0
    assert packing.pack(odd(spark).limit(0), public_tokenizers.path(catalog.TOKENIZER), public_tokenizers.PATTERN).count() == 0


def test_hilbert_neighbours_differ_by_one_step():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    key = packing.hilbert_key(grid, 3)
    assert sorted(key) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(1) == 1).all()


def brute_components(texts):
    sets = {}
    for d, t in texts:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text_of(t))
        w = re.findall(r"[^\x20\x09-\x0D]+", w)
        sets[d] = {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    having = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            having[g].append(d)
    for a, b in {(a, b) for m in having.values() for a in m for b in m if a < b}:
        i = len(sets[a] & sets[b])
        if 100 * i >= 80 * (len(sets[a]) + len(sets[b]) - i):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return sorted((d, len(sets[d]), root(d)) for d in sets)


def test_join_equals_brute_force(spark):
    rng = random.Random(9)
    base = [f"v{rng.randint(0, 5000)}" for _ in range(120)]
    near = []
    for k in range(60):  # a chain of edits: neighbours link, ends do not
        base[rng.randrange(120)] = f"e{k}"
        near.append(" ".join(base))
    texts = [(r["doc_id"], r["text"]) for r in documents(spark).collect()]
    texts += [(10000 + k, t) for k, t in enumerate(near)] + [(20000 + k, t) for k, t in
                                                             enumerate(["a b c", "A  b\nc", "a b", "", None, "q"])]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    got = sorted(tuple(r) for r in jaccard_join.near_duplicates(docs).collect())
    assert got == brute_components(texts)
    # Neither the number of pivots nor the division of heavy regions over tasks changes anything.
    for weight, pivots in ((None, 2), (400, 8), (3000, 3)):
        assert sorted(tuple(r) for r in jaccard_join.near_duplicates(docs, weight=weight, pivots=pivots).collect()) == got
    assert {r["doc_id"] for r in jaccard_join.near_duplicates(odd(spark)).collect()} == {d for d, _ in ODD if d is not None}
    assert jaccard_join.near_duplicates(odd(spark).limit(0)).count() == 0


def test_regions_join_exactly_and_cells_of_one_component_are_done():
    rng = random.Random(4)
    for trial in range(30):
        pool = rng.sample(range(1 << 40), 400)
        bases = [rng.sample(pool, rng.randint(5, 120)) for _ in range(rng.randint(1, 6))]
        sets = []
        for _ in range(rng.randint(2, 70)):
            base = list(rng.choice(bases))
            for _ in range(rng.randint(0, len(base) // 6)):
                base[rng.randrange(len(base))] = rng.choice(pool)
            sets.append(np.array(sorted(set(base)), np.uint64))
        links = jaccard_join.join_region(list(range(len(sets))), sets, pivots=rng.randint(1, 8))
        group = list(range(len(sets)))

        def merge(a, b):
            old, new = max(group[a], group[b]), min(group[a], group[b])
            group[:] = [new if g == old else g for g in group]

        for a, b in links:
            both = len(np.intersect1d(sets[a], sets[b]))
            assert 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both)
            merge(a, b)
        found, group[:] = list(group), list(range(len(sets)))
        for a in range(len(sets)):
            for b in range(a):
                both = len(np.intersect1d(sets[a], sets[b]))
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    merge(a, b)
        assert found == group
        assert len(links) == len(sets) - len(set(group))


def test_runs_are_cut_alike_in_any_batches():
    rng = random.Random(12)
    rows = sorted((rng.randint(0, 30), rng.randint(1, 60), k) for k in range(600))
    cols = {"g": [r[0] for r in rows], "id": [r[2] for r in rows], "q": [0] * 600, "n": [r[1] for r in rows],
            "most": [r[1] + rng.randint(-3, 4) for r in rows]}
    import pyarrow as pa
    whole = pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) for c, v in cols.items()})
    want, run, reach = {}, 0, None
    for k in range(600):
        if k == 0 or cols["g"][k] != cols["g"][k - 1] or cols["n"][k] > reach:
            run += 1
            reach = cols["most"][k] if k == 0 or cols["g"][k] != cols["g"][k - 1] else max(reach, cols["most"][k])
        else:
            reach = max(reach, cols["most"][k])
        want.setdefault(run, []).append(cols["id"][k])
    want = sorted(v for v in want.values() if len(v) > 1)
    for size in (1, 2, 7, 600):
        got = {}
        for batch in jaccard_join._cut_runs(whole.slice(at, size) for at in range(0, 600, size)):
            for r, i in zip(batch["r"].to_pylist(), batch["id"].to_pylist()):
                got.setdefault(r, []).append(i)
        assert sorted(got.values()) == want


def test_jaccard_region_whose_cells_overlap_takes_no_more_distances_than_pairs(monkeypatch):
    rng = np.random.default_rng(1)
    sets = [np.sort(rng.choice(40, rng.integers(18, 38), replace=False)).astype("<u8") for _ in range(200)]
    taken, measure = [], jaccard_join._Region.distances

    def counted(self, pivot, cell, codes, begin):
        taken.append(len(cell))
        assert sum(taken) <= 2 * len(sets) ** 2
        return measure(self, pivot, cell, codes, begin)

    monkeypatch.setattr(jaccard_join._Region, "distances", counted)
    plain = [set(s.tolist()) for s in sets]
    linked = [(a, b) for b in range(len(sets)) for a in range(b)
              if 100 * len(plain[a] & plain[b]) >= 80 * len(plain[a] | plain[b])]

    def parts(pairs):
        part = list(range(len(sets)))
        for a, b in pairs:
            part = [min(part[a], part[b]) if p in (part[a], part[b]) else p for p in part]
        return part

    assert parts(jaccard_join.join_region(list(range(len(sets))), sets)) == parts(linked)
    assert len(set(parts(linked))) > 100


def test_warc_pages_are_not_shuffled_where_few_payloads_repeat(spark, monkeypatch):
    plans, keep = [], warc.materialise

    def seen(df, name, **options):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return keep(df, name, **options)

    monkeypatch.setattr(warc, "materialise", seen)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "256k")
    try:
        pages = spark.createDataFrame([(i, "u", str(i % 299) * 1000) for i in range(300)], "page_id long, url string, html string")
        got = {r.page_id: r.refers_to for r in warc.warc_round_trip(pages).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == {i: None for i in range(299)} | {299: 0}
    plan = dict(plans)["warc-manifest"]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
