"""Secret scans through a trigram inverted index.

From each rule's regular expression a Boolean query over lower-case trigrams is
derived: literals in sequence need all their trigrams, alternatives need one
branch, optional parts need nothing.  Within each block of documents an index
maps the trigrams that some rule asks for to the documents that hold them;
postings are intersected and united by the query, and only the candidates are
verified with the expression.  A rule without mandatory trigrams (runs of hex
digits) scans all texts.

Edge cases: NULL text is empty and has no spans; spans are code points, end
exclusive; matches of one kind do not overlap, those of different kinds may;
spans of equal start are listed in rule order; repeated rows are scanned one by
one; empty tables give no rows; extra columns stay in :func:`scan` and
:func:`redact`.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import product
from re import _constants as C  # the parse tree of the standard library's expressions
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.textblocks import _FOLD, blocks

# A query is ("all",) for no demand, ("tri", text), ("and", parts) or ("or", parts).
ANY = ("all",)
MOST_STRINGS = 64


def _join(kind: str, parts: list) -> tuple:
    parts = list(dict.fromkeys(parts))
    if kind == "or" and ANY in parts:
        return ANY
    parts = [p for p in parts if p != ANY]
    return ANY if not parts else parts[0] if len(parts) == 1 else (kind, tuple(parts))


def _of_strings(strings: set[str]) -> tuple:
    """One of the strings must occur."""
    return _join("or", [_join("and", [("tri", s[i:i + 3]) for i in range(len(s) - 2)]) for s in sorted(strings)])


def _exact(op, arg) -> set[str] | None:
    """All strings a node matches, if they are few."""
    if op is C.LITERAL:
        return {chr(arg).lower()}
    if op is C.IN and all(o is C.LITERAL for o, _ in arg) and len(arg) <= 4:
        return {chr(a).lower() for _, a in arg}
    if op is C.SUBPATTERN:
        return _exact_all(arg[3])
    if op is C.BRANCH:
        found = [_exact_all(b) for b in arg[1]]
        return None if None in found else set().union(*found)
    if op is C.MAX_REPEAT and arg[1] <= 3:
        one = _exact_all(arg[2])
        return None if one is None else {"".join(p) for n in range(arg[0], arg[1] + 1) for p in product(one, repeat=n)}
    return None


def _exact_all(nodes) -> set[str] | None:
    out = {""}
    for op, arg in nodes:
        one = _exact(op, arg)
        if one is None or len(out) * len(one) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in one}
    return out


def _demand(nodes) -> tuple:
    demands, run = [], {""}
    for op, arg in nodes:
        one = _exact(op, arg)
        if one is not None and len(run) * len(one) <= MOST_STRINGS:
            run = {a + b for a in run for b in one}
            continue
        demands.append(_of_strings(run))
        run = one if one is not None else {""}
        if one is None:
            if op is C.SUBPATTERN:
                demands.append(_demand(arg[3]))
            elif op is C.BRANCH:
                demands.append(_join("or", [_demand(b) for b in arg[1]]))
            elif op is C.MAX_REPEAT and arg[0]:
                demands.append(_demand(arg[2]))
    return _join("and", [*demands, _of_strings(run)])


def trigram_query(pattern: str) -> tuple:
    """The Boolean trigram query that every lower-cased match of ``pattern`` fulfils."""
    return _demand(_parser.parse(pattern))


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    flags: int = re.ASCII
    holds: Callable[[re.Match], bool] = field(default=lambda m: True)


# The base kinds of the contract.  A run of at least so many
# characters is the same as a run that is dropped when it is shorter.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         re.ASCII | re.IGNORECASE, lambda m: m.end(2) - m.start(2) >= 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
# Public formats of keys beyond the base kinds.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
)
RULES = BASE + MORE


def _trigrams(query: tuple) -> set[str]:
    return {query[1]} if query[0] == "tri" else set().union(*map(_trigrams, query[1])) if len(query) > 1 else set()


class Index:
    """Postings of a block: trigram to the sorted documents that hold it."""

    def __init__(self, raw: np.ndarray, at: np.ndarray, wanted: set[str]):
        self.n = len(at) - 1
        codes = {int.from_bytes(t.encode(), "big"): t for t in wanted}
        ask = np.zeros(1 << 24, bool)
        ask[list(codes)] = True
        self.postings = {t: np.empty(0, np.int64) for t in wanted}
        if len(raw) < 3:
            return
        low = _FOLD[raw].astype(np.uint32)
        code = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:]
        places = np.flatnonzero(ask[code])
        doc = np.searchsorted(at, places, side="right") - 1
        inside = places + 3 <= at[doc + 1]
        pairs = np.unique(code[places[inside]].astype(np.int64) * self.n + doc[inside])
        found, doc = pairs // self.n, pairs % self.n
        for c, t in codes.items():
            self.postings[t] = doc[np.searchsorted(found, c):np.searchsorted(found, c + 1)]

    def candidates(self, query: tuple) -> np.ndarray:
        if query[0] == "all":
            return np.arange(self.n)
        if query[0] == "tri":
            return self.postings[query[1]]
        parts = [self.candidates(p) for p in query[1]]
        out = parts[0]
        for p in parts[1:]:
            out = np.intersect1d(out, p, True) if query[0] == "and" else np.union1d(out, p)
        return out


def find_spans(texts: list[str], raw: np.ndarray, at: np.ndarray, rules: tuple[Rule, ...]) -> list[list[tuple]]:
    """(start, rule number, end) of each text's matches, sorted."""
    queries = [trigram_query(r.pattern) for r in rules]
    index = Index(raw, at, set().union(*map(_trigrams, queries)))
    out: list[list[tuple]] = [[] for _ in texts]
    for k, rule in enumerate(rules):
        expression = re.compile(rule.pattern, rule.flags)
        for d in index.candidates(queries[k]).tolist():
            out[d] += [(m.start(), k, m.end()) for m in expression.finditer(texts[d]) if rule.holds(m)]
    for spans in out:
        spans.sort()
    return out


SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                 T.StructField("end", T.LongType())]))
_ARROW_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _scan(numbers: tuple[int, ...], masked: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = tuple(RULES[k] for k in numbers)
        for batch in batches:
            for first, last, raw, at in blocks(batch["text"]):
                part = batch.slice(first, last - first)
                texts = [t or "" for t in part["text"].to_pylist()]
                spans = find_spans(texts, raw, at, rules)
                columns = dict(zip(part.schema.names, part.columns))
                if masked:
                    columns["text"] = pa.array([_mask(t, s, rules) for t, s in zip(texts, spans)], pa.string())
                columns["spans"] = pa.array([[{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in s]
                                             for s in spans], _ARROW_SPAN)
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def _mask(text: str, spans: list[tuple], rules: tuple[Rule, ...]) -> str:
    """Each run of overlapping spans becomes the name of its first kind."""
    out, done, k = [], 0, 0
    while k < len(spans):
        start, rule, end = spans[k]
        while k + 1 < len(spans) and spans[k + 1][0] < end:
            k += 1
            end = max(end, spans[k][2])
        out += [text[done:start], f"[{rules[rule].kind.upper()}]"]
        done, k = end, k + 1
    return "".join([*out, text[done:]])


def _apply(docs: DataFrame, rules: tuple[Rule, ...], masked: bool) -> DataFrame:
    plain = docs.drop("spans").withColumn("text", F.col("text").cast("string"))
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in plain.schema.fields), T.StructField("spans", SPAN)])
    return plain.mapInArrow(_scan(tuple(RULES.index(r) for r in rules), masked), schema)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``spans``: array of (kind, start, end)."""
    return _apply(docs, rules, False)


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with secrets replaced in ``text``, and the ``spans`` of the original."""
    return _apply(docs, rules, True)


def secret_scan(docs: DataFrame) -> DataFrame:
    """The contract's counts and digests of :func:`scan`."""
    s = F.col("spans")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    base = F.filter(s, lambda x: x["kind"].isin(*[r.kind for r in BASE]))

    def count(kind):
        return F.size(F.filter(s, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(r.kind) for r in BASE]
    return scan(docs.select("doc_id", "text")).select(
        "doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(s).alias("spans"))
