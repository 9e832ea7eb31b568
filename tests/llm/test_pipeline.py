"""The corpus pipeline and its stages on whole tables and on odd rows."""

import re

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SF_SMALL
from quarry.llm import factorisation_machine, url_filters

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score string, spans string, n_lines string, "
          "n_dropped string, component_id string, _meta string, ids string")
GOOD = " ".join(f"word{k}" for k in range(60))
OTHER = " ".join(f"thing{k * 7 % 61}" for k in range(60))


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", "web", len(t or ""), *"abcdefg") for d, t in rows], SCHEMA)


def texts(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def untouched(before, after):
    assert after.columns == before.columns and after.dtypes == before.dtypes
    assert after.select("score", "spans", "n_lines", "n_dropped", "component_id", "_meta", "ids").distinct().collect() in (
        [], [tuple("abcdefg")])


def test_near_copies_are_rows_not_ids(spark):
    rows = [(1, GOOD), (5, GOOD + " more"), (5, OTHER), (5, OTHER), (None, GOOD), (None, "alone in the world it is here"),
            (7, None), (8, ""), (9, "short"), (None, None)]
    docs = frame(spark, rows).repartition(4)
    out = corpus_pipeline.drop_near_copies(spark, docs, SF_SMALL)
    untouched(docs, out)
    assert texts(out) == sorted([(1, GOOD), (5, OTHER), (None, "alone in the world it is here"), (7, None), (8, ""), (9, "short"),
                                 (None, None)], key=repr)
    assert corpus_pipeline.drop_near_copies(spark, docs.limit(0), SF_SMALL).count() == 0
    only = frame(spark, [(None, GOOD), (None, GOOD)])
    assert texts(corpus_pipeline.drop_near_copies(spark, only, SF_SMALL)) == [(None, GOOD)]


def test_lines_and_secrets_change_text_and_length_only(spark):
    docs = frame(spark, [(1, "a line that is repeated\nown one"), (2, "A line that is repeated \nother"), (2, None),
                         (3, "password = hunter2222 end")])
    lines = corpus_pipeline.drop_lines(spark, docs, SF_SMALL)
    untouched(docs, lines)
    got = {(r["doc_id"], r["text"]): r["n_chars"] for r in lines.collect()}
    assert got == {(1, "a line that is repeated\nown one"): 31, (2, "other"): 5, (2, ""): 0, (3, "password = hunter2222 end"): 25}
    masked = corpus_pipeline.mask_secrets(spark, docs, SF_SMALL)
    untouched(docs, masked)
    row = masked.where("doc_id = 3").first()
    assert "hunter2222" not in row["text"] and row["n_chars"] == len(row["text"])
    for stage in (corpus_pipeline.drop_lines, corpus_pipeline.mask_secrets):
        assert stage(spark, docs.limit(0), SF_SMALL).count() == 0


def test_classifier_stage_keeps_what_reaches_the_threshold(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    odd = docs.withColumns({c: F.lit("abcdefg"[i]) for i, c in enumerate(
        ("score", "spans", "n_lines", "n_dropped", "component_id", "_meta", "ids"))})
    out = corpus_pipeline.classify(spark, odd, SF_SMALL)
    untouched(odd, out)
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    scores = factorisation_machine.quality_classifier(docs, labels)
    want = {r["doc_id"] for r in scores.where("predicted = 1").collect()}
    assert {r["doc_id"] for r in out.collect()} == want


def brute_components(rows):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return group


def test_whole_pipeline_stage_by_stage(spark):
    """Every stage's rows follow from its predecessor's; the pieces are the last texts' tokens."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_SMALL).cache()
        kept.append([(r["doc_id"], r["text"]) for r in docs.orderBy("doc_id").collect()])
    assert docs.columns == spark.read.parquet(f"{SF_SMALL}/documents.parquet").columns
    before, after = kept[1], {d for d, _ in kept[2]}
    group = brute_components(before)
    first = {}
    for (d, _), g in zip(before, group):
        first[g] = min(d, first.get(g, d))
    assert after == set(first.values())
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {d: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, t in kept[3]}
    pieces = corpus_pipeline.run(spark, SF_SMALL).collect()
    got = {}
    for p in pieces:
        got[p["doc_id"]] = got.get(p["doc_id"], 0) + p["length"]
    assert got == want and 0 < len(got) < 200
    assert max(p["sequence_id"] for p in pieces) == -(-sum(want.values()) // 1024) - 1


def test_hosts_are_those_that_a_browser_asks(spark):
    cases = {"http://user:pw@evil.com/x": ["evil.com", "evil.com/x"], "http://safe.org@evil.com/": ["evil.com"],
             "http://evil.com./": ["evil.com"], "http://[::1]:80/x": ["::1", "::1/x"], "//evil.com/x": ["evil.com", "evil.com/x"],
             "http://a.b.Evil.COM:81/p/q?r": ["a.b.evil.com", "b.evil.com", "evil.com", "a.b.evil.com/p"],
             "http://10.0.0.1/": ["10.0.0.1"], "ftp://x@y@h.org?a/b": ["h.org"], "mailto:a@b.com": [], "http:///x": [], "": [],
             "evil.com/x": [], "http://" + "a." * 5000 + "com#x/y": None}
    df = spark.createDataFrame([(u,) for u in cases], "url string")
    for r in df.select("url", url_filters.keys_of(F.col("url")).alias("keys")).collect():
        if cases[r["url"]] is None:
            assert len(r["keys"]) == 5000 and r["keys"][-1] == "a.com"
        else:
            assert r["keys"] == cases[r["url"]], r["url"]
