"""Quality rules against brute force, and both learners on held-out labels and odd rows."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL
from quarry.llm import factorisation_machine, quality_rules

LONG = " ".join(f"w{k % 977}" for k in range(30000))
ODD = [(1, None), (2, ""), (3, " \n\t\n "), (4, "one two"), (5, LONG), (6, LONG), (6, LONG), (None, LONG), (7, "é" * 30),
       (8, "a b c d e\na b c d e\n a b c d e \n\n\n"), (9, "\x1c\x85 a b 日本語 👍🏽 \r\n x  y # * $ % & | < >"), (None, None),
       (10, "same line\nsame line\nother\nsame line"), (11, "x " * 50), (12, "a b c d e f a b c d e f g h i j k l m n o p")]
#: Further columns whose names the operators use themselves.
EXTRA = "doc_id long, text string, stats string, score string, _meta string, n_words string"


def odd(spark):
    return spark.createDataFrame([(d, t, *["x"] * 4) for d, t in ODD], EXTRA)


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    met, covered = {}, set()
    for i, w in enumerate(windows):
        met.setdefault(w, []).append(i)
    for places in met.values():
        if len(places) > 1:
            covered.update(i + k for i in places for k in range(5))
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered),
            n < 10 or 100 * len(covered) > 20 * n)


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_counts_and_base_verdict_equal_brute_force(spark):
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text")
    for frame in (docs, odd(spark)):
        rows = [(r["doc_id"], r["text"]) for r in frame.collect()]
        got = quality_rules.quality_rules(frame, labels)
        assert sorted(map(repr, ((r["doc_id"], *(r[c] for c in COLUMNS)) for r in got.collect()))) == sorted(
            map(repr, ((d, *brute(t)) for d, t in rows)))
        assert got.where("base_failed and kept").count() == 0
    assert quality_rules.quality_rules(odd(spark).limit(0), labels).count() == 0


def test_verdict_is_the_learned_list_in_order(spark):
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    rows, bad = quality_rules.sample_statistics(docs, labels)
    rules = quality_rules.learn(rows, bad)
    assert 0 < len(rules)
    covered = np.zeros(len(bad), bool)
    for rule in rules:
        covered |= quality_rules._covers(rule, rows)
    # What the expressions reject of the sample is what the conditions cover.
    got = quality_rules.quality_rules(docs, labels).join(labels.dropDuplicates(["doc_id"]), "doc_id")
    by = {(r["quality"], r["kept"]): r["count"] for r in got.groupBy("quality", "kept").count().collect()}
    assert by.get((1, True), 0) > 0.9 * (by.get((1, True), 0) + by.get((1, False), 0))
    assert by.get((0, False), 0) > 0.8 * (by.get((0, True), 0) + by.get((0, False), 0))
    failed = got.where("base_failed").count()
    assert covered.sum() <= got.where("not kept").count() <= covered.sum() + failed


def test_without_both_classes_the_base_rule_decides(spark):
    docs = odd(spark)
    for labels in ([], [(5, 1), (6, 1)], [(5, 0), (4, 0)]):
        out = quality_rules.quality_rules(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
        assert out.where("kept = base_failed").count() == 0


def test_classifier_holds_on_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    scored = factorisation_machine.quality_classifier(docs, labels)
    held = scored.join(labels, "doc_id").where("held_out").select("score", "predicted", "quality").collect()
    good, bad = [r for r in held if r["quality"] == 1], [r for r in held if r["quality"] == 0]
    assert len(good) > 20 and len(bad) > 3
    wins = sum((g["score"] > b["score"]) + 0.5 * (g["score"] == b["score"]) for g in good for b in bad)
    assert wins / (len(good) * len(bad)) > 0.9
    assert sum(r["predicted"] == r["quality"] for r in held) > 0.9 * len(held)
    # Labels and other columns are no inputs of a score.
    other = docs.withColumns({"lang": F.lit("zz"), "source": F.lit("none"), "score": F.lit("x")})
    again = {r["doc_id"]: r["score"] for r in factorisation_machine.quality_classifier(other, labels).collect()}
    assert all(abs(again[r["doc_id"]] - r["score"]) < 1e-12 for r in scored.collect())


def test_linear_time_score_equals_all_pairs():
    rng = np.random.default_rng(2)
    docs = [(np.sort(rng.choice(50, 6, replace=False)).astype(np.int64), rng.random(6)) for _ in range(60)]
    y = np.array([random.Random(k).randint(0, 1) for k in range(60)], float)
    model = factorisation_machine.fit(docs, y)
    i, x = docs[0]
    pairs = sum(x[a] * x[b] * model.factors[i[a]] @ model.factors[i[b]] for a in range(6) for b in range(a))
    assert abs(model.raw(i, x) - (model.bias + model.linear[i] @ x + pairs)) < 1e-9


def test_scores_of_odd_rows(spark):
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = factorisation_machine.train(docs, labels)
    out = factorisation_machine.score(odd(spark).drop("score"), model).collect()
    assert len(out) == len(ODD) and all(0 <= r["score"] <= 1 for r in out)
    assert len({r["score"] for r in out if r["doc_id"] == 6}) == 1
    assert factorisation_machine.quality_classifier(odd(spark).limit(0), labels).count() == 0
