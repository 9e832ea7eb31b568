"""Quality rules: a decision list learned by sequential covering.

Text statistics are Spark expressions.  From a bounded sample of labelled rows
(``MAX_LABELLED``, a documented parameter) rules are grown and pruned one at a
time: a rule is a conjunction of thresholds that covers bad documents; what it
covers leaves the training rows and the next rule is grown.  The list is
emitted as one ordered ``CASE WHEN`` that Catalyst compiles; nothing on the
scoring path runs Python.

Edge cases: NULL or empty text has zero words and fails the base rule;
repeated rows are scored one by one; an empty table or a label table without
both classes gives an empty list (the base rule alone decides); a statistic
is never NULL.  Extra columns of the input are ignored by the query and kept
by :func:`with_statistics`.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.shared import SPACE, SPACE_CLASS, let, text_or_empty

#: At most so many labelled rows fit the list, taken in hash order of the id.
MAX_LABELLED = 6000
WINDOW = 5

#: What conditions of learned rules may test.
FEATURES = ("n_words", "word_length", "symbol_ratio", "dup_line_ratio", "repeat_ratio", "upper_ratio",
            "digit_ratio", "mark_ratio", "short_word_ratio", "variety", "line_words")


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE_CLASS + "+")).otherwise(
        F.array().cast("array<string>"))


def _repeated_words(words: Column) -> Column:
    """Words inside a 5-word window that occurs at least twice.

    Windows are hashed (64 bits); only a text with a repeated hash pays for
    the sort that finds where the repeats lie.
    """
    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(s: Column) -> Column:
            n = F.size(s)
            again = F.filter(
                F.transform(s, lambda x, k: F.when(
                    ((k > 0) & (s[F.greatest(k - 1, F.lit(0))]["h"] == x["h"]))
                    | ((k < n - 1) & (s[F.least(k + 1, n - 1)]["h"] == x["h"])), x["i"])),
                lambda i: i.isNotNull())
            return F.sort_array(again)

        def total(p: Column) -> Column:
            steps = F.transform(p, lambda i, k: F.when(
                k < F.size(p) - 1, F.least(F.lit(WINDOW), p[F.least(k + 1, F.size(p) - 1)] - i)
            ).otherwise(WINDOW))
            return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

        return let(let(pairs, positions), total)

    def by_hash(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW),
                             lambda i: F.xxhash64(*[w[i + j] for j in range(WINDOW)]))
        return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h))
                   .otherwise(0))

    return F.when(F.size(words) >= WINDOW, let(words, by_hash)).otherwise(0).cast("long")


def with_statistics(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` plus one struct column ``{prefix}stats`` of whole-text statistics."""
    t = text_or_empty(text)

    def left(column: Column, drop: str) -> Column:
        return F.length(F.regexp_replace(column, drop, "")).cast("long")

    def stats(t: Column) -> Column:
        def of_words(w: Column) -> Column:
            return F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                _repeated_words(w).alias("n_repeat_words"),
                F.size(F.array_distinct(w)).cast("long").alias("n_distinct_words"),
                F.size(F.filter(w, lambda x: F.length(x) <= 3)).cast("long").alias("n_short_words"))

        def of_lines(l: Column) -> Column:
            return F.struct(F.size(l).cast("long").alias("n_lines"),
                            (F.size(l) - F.size(F.array_distinct(l))).cast("long").alias("n_dup_lines"))

        lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACE))) > 0)
        return F.struct(
            let(_words(t), of_words).alias("w"), let(lines, of_lines).alias("l"),
            left(t, r"[^#*$%&|<>]+").alias("n_symbols"), left(t, r"[^A-Z]+").alias("n_upper"),
            left(t, r"[^0-9]+").alias("n_digits"), left(t, r"[^!?;:=_{}\[\]\\/~^+-]+").alias("n_marks"))

    return docs.withColumn(f"{prefix}stats", let(t, stats))


def flat_statistics(stats: Column) -> dict[str, Column]:
    """The contract's counts and the learnable features, from the struct."""
    w, l = stats["w"], stats["l"]
    n, chars = w["n_words"], w["word_chars"]

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(0.0).cast("double")

    return {
        "n_words": n, "word_chars": chars, "n_symbols": stats["n_symbols"],
        "n_dup_lines": l["n_dup_lines"], "n_repeat_words": w["n_repeat_words"],
        "word_length": ratio(chars, n), "symbol_ratio": ratio(stats["n_symbols"], n),
        "dup_line_ratio": ratio(l["n_dup_lines"], l["n_lines"]),
        "repeat_ratio": ratio(w["n_repeat_words"], n), "upper_ratio": ratio(stats["n_upper"], chars),
        "digit_ratio": ratio(stats["n_digits"], chars), "mark_ratio": ratio(stats["n_marks"], chars),
        "short_word_ratio": ratio(w["n_short_words"], n), # Distinct words on a log scale: unlike their share it hardly falls as a clean text grows.
        "variety": F.when(n > 1, F.log(w["n_distinct_words"]) / F.log(n)).otherwise(1.0).cast("double"),
        "line_words": ratio(n, l["n_lines"]),
    }


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 10) | (100 * n_repeat_words > 20 * n_words)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # feature > cut, else feature <= cut
    cut: float

    def holds(self, rows: np.ndarray) -> np.ndarray:
        x = rows[:, FEATURES.index(self.feature)]
        return x > self.cut if self.above else x <= self.cut

    def column(self, stats: dict[str, Column]) -> Column:
        c = stats[self.feature].cast("double")
        return c > F.lit(self.cut) if self.above else c <= F.lit(self.cut)


def _covers(rule: list[Condition], rows: np.ndarray) -> np.ndarray:
    hit = np.ones(len(rows), bool)
    for c in rule:
        hit &= c.holds(rows)
    return hit


def _grow(rows: np.ndarray, bad: np.ndarray, cuts: int, longest: int) -> list[Condition]:
    """Add the condition of the highest information gain until no good row is covered."""
    rule: list[Condition] = []
    inside = np.ones(len(rows), bool)
    while len(rule) < longest and (inside & ~bad).any():
        p0, n0 = (inside & bad).sum(), (inside & ~bad).sum()
        best, gain = None, 1e-9
        for k, name in enumerate(FEATURES):
            values = np.sort(rows[inside & bad, k])
            for cut in np.unique(values[np.linspace(0, len(values) - 1, cuts).astype(int)]):
                # Just beyond a bad row's value, on either side of it.
                for c in (Condition(name, True, float(np.nextafter(cut, -np.inf))),
                          Condition(name, False, float(cut))):
                    hit = c.holds(rows) & inside
                    p, n = (hit & bad).sum(), (hit & ~bad).sum()
                    if p and (g := p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))) > gain:
                        best, gain = c, g
        if best is None:
            break
        rule.append(best)
        inside &= best.holds(rows)
    return rule


def learn(rows: np.ndarray, bad: np.ndarray, precision: float = 0.97, cuts: int = 24,
          longest: int = 4, most_rules: int = 12, least_cover: int = 5) -> list[list[Condition]]:
    """Sequential covering: grow on two thirds of the rows, prune on the rest.

    A rule is kept if at least ``precision`` of the rows it covers are bad, on
    the growing and on the pruning rows alike; the first that is not ends the list.
    """
    rules: list[list[Condition]] = []
    grow = np.arange(len(rows)) % 3 != 0
    todo = np.ones(len(rows), bool)
    while len(rules) < most_rules and (bad & grow & todo).sum() >= least_cover:
        rule = _grow(rows[grow & todo], bad[grow & todo], cuts, longest)

        def worth(part: list[Condition]) -> float:
            hit = _covers(part, rows) & ~grow & todo
            p, n = (hit & bad).sum(), (hit & ~bad).sum()
            return (p - n) / (p + n) if p + n else -1.0

        if not rule:
            break
        # Ties go to the shorter rule.
        rule = max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (worth(r), -len(r)))
        sure = True
        for part in (grow, ~grow):
            hit = _covers(rule, rows) & part & todo
            p, n = (hit & bad).sum(), (hit & ~bad).sum()
            sure &= bool(p + n == 0 or p >= precision * (p + n))
        if not sure or (_covers(rule, rows) & todo & bad).sum() < least_cover:
            break
        rules.append(rule)
        todo &= ~_covers(rule, rows)
    return rules


def verdict(rules: list[list[Condition]], stats: dict[str, Column]) -> Column:
    """The list as ordered conditions: true keeps the document."""
    out = None
    for rule in rules:
        hit = rule[0].column(stats)
        for c in rule[1:]:
            hit = hit & c.column(stats)
        out = F.when(hit, F.lit(False)) if out is None else out.when(hit, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def sample_statistics(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> tuple[np.ndarray, np.ndarray]:
    """(features, bad) of at most ``most`` labelled documents, in hash order of the id.

    The chosen ids are at most ``most`` rows, so that side is broadcast.
    """
    chosen = (labels.select("doc_id", "quality").dropna().groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    found = with_statistics(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))
    s = flat_statistics(F.col("stats"))
    got = found.select("doc_id", "quality", *[s[f].cast("double").alias(f) for f in FEATURES]).collect()
    got.sort(key=lambda r: tuple(r))
    rows = np.array([[r[f] for f in FEATURES] for r in got], dtype=float).reshape(-1, len(FEATURES))
    return rows, np.array([r["quality"] == 0 for r in got], dtype=bool)


def apply_rules(docs: DataFrame, rules: list[list[Condition]]) -> DataFrame:
    """One row per document: id, counts, base verdict and final verdict."""
    s = flat_statistics(F.col("stats"))
    out = with_statistics(docs.select("doc_id", "text")).select(
        "doc_id", *[s[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                            "n_repeat_words")],
        verdict(rules, s).alias("_list"))
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & F.col("_list")).drop("_list")


def quality_rules(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    rows, bad = sample_statistics(docs, labels, most)
    return apply_rules(docs, learn(rows, bad) if bad.any() and not bad.all() else [])
