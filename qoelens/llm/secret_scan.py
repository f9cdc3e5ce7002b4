"""Secret scan over a trigram inverted index.

Every rule is a regular expression. What three-letter sequences a match must
contain is derived from the expression as an AND/OR query. Texts are indexed in
slices, next to their data: for each trigram of any query, the texts that
contain it. A rule's query is answered by intersecting and uniting these
postings, and only the candidates are searched. A rule without mandatory
trigrams searches every text. Trigrams fold A-Z, so either case is found.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from re import _constants as SRE
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textbytes as B

#: Strings that a stretch of an expression may stand for, at most.
MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret; a match counts when ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The base rules.
BASE_RULES = (
    Rule(
        "assign",
        r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}"),  # of all runs [0-9a-f]+, those of 16 or more
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[rs]k_(?:live|test)_[0-9A-Za-z]{16,}"),
    Rule("npm", r"npm_[A-Za-z0-9]{36}"),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]*"),
    Rule("bearer", r"(?ai:bearer)\x20+[A-Za-z0-9._~+/-]{20,}=*"),
    Rule("login_url", r"[a-z][a-z0-9+]{1,15}://[^\s/:@]{1,64}:[^\s/:@]{1,64}@"),
)
RULES = BASE_RULES + MORE_RULES

#: A query: True (anything), a trigram, or ("and" | "or", queries).
Query = bool | str | tuple


def _join(how: str, queries: list[Query]) -> Query:
    kept = list(dict.fromkeys(q for q in queries if how == "or" or q is not True))
    if how == "or" and any(q is True for q in kept) or not kept:
        return True
    return kept[0] if len(kept) == 1 else (how, tuple(kept))


def _of_strings(strings: set[str]) -> Query:
    """One of the strings occurs."""
    each = [_join("and", [s[i:i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)]
    return _join("or", each) if each else True


def _item(op, arg) -> tuple[set[str] | None, Query]:
    """(all strings the item can be, or None; what any match of it must contain)."""
    if op is SRE.LITERAL:
        return {chr(arg).lower()}, True
    if op is SRE.IN and len(arg) <= 8 and all(kind is SRE.LITERAL for kind, _ in arg):
        return {chr(code).lower() for _, code in arg}, True
    if op in (SRE.AT, SRE.ASSERT, SRE.ASSERT_NOT):
        return {""}, True
    if op is SRE.SUBPATTERN:
        return _sequence(arg[3])
    if op is SRE.BRANCH:
        parts = [_sequence(part) for part in arg[1]]
        if all(strings is not None for strings, _ in parts):
            return set().union(*(strings for strings, _ in parts)), True
        return None, _join("or", [query if strings is None else _of_strings(strings) for strings, query in parts])
    if op in (SRE.MAX_REPEAT, SRE.MIN_REPEAT, SRE.POSSESSIVE_REPEAT):
        least, most, inner = arg
        strings, query = _sequence(inner)
        if strings is not None and least == 0 and most == 1:
            return strings | {""}, True
        if strings is not None and least == most and len(strings) ** least <= MOST_STRINGS:
            return reduce(lambda have, _: {a + b for a in have for b in strings}, range(least), {""}), True
        return None, True if least == 0 else query if strings is None else _of_strings(strings)
    return None, True


def _sequence(items) -> tuple[set[str] | None, Query]:
    run, queries, whole = {""}, [], True
    for op, arg in items:
        strings, query = _item(op, arg)
        if strings is not None and len(run) * len(strings) <= MOST_STRINGS:
            run = {a + b for a in run for b in strings}
            continue
        queries += [_of_strings(run), query if strings is None else True]
        run, whole = ({""} if strings is None else strings), False
    return (run, True) if whole else (None, _join("and", [*queries, _of_strings(run)]))


def trigram_query(pattern: str) -> Query:
    """The AND/OR of (lower-cased) trigrams that every match of ``pattern`` contains."""
    strings, query = _sequence(parser.parse(pattern))
    return query if strings is None else _of_strings(strings)


def _trigrams(query: Query) -> set[str]:
    if isinstance(query, str):
        return {query}
    return set() if query is True else set().union(*map(_trigrams, query[1]))


class _Index:
    """Postings of one slice for the trigrams of all queries."""

    def __init__(self, vocabulary: dict[str, int], table: np.ndarray, data: np.ndarray, offsets: np.ndarray):
        self.vocabulary, self.rows = vocabulary, len(offsets) - 1
        low = B.LOWER[data].astype(np.int32)
        found = table[low[:-2] << 16 | low[1:-1] << 8 | low[2:]] if len(low) > 2 else np.empty(0, np.uint8)
        at = np.flatnonzero(found)
        row = np.searchsorted(offsets, at, side="right") - 1
        # Both ends must lie in the same text.
        inside = at + 3 <= offsets[row + 1]
        pairs = np.unique(found[at[inside]].astype(np.int64) * self.rows + row[inside])
        self.posting_rows = pairs % self.rows
        self.bounds = np.searchsorted(pairs, np.arange(len(vocabulary) + 2) * self.rows)

    def candidates(self, query: Query) -> np.ndarray:
        """Texts that satisfy the query, ascending."""
        if query is True:
            return np.arange(self.rows)
        if isinstance(query, str):
            number = self.vocabulary[query]
            return self.posting_rows[self.bounds[number]:self.bounds[number + 1]]
        parts = [self.candidates(q) for q in query[1]]
        if query[0] == "or":
            return reduce(np.union1d, parts)
        return reduce(lambda a, b: np.intersect1d(a, b, assume_unique=True), sorted(parts, key=len))


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())])


def _scanner(rules: tuple[Rule, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = [trigram_query(rule.pattern) for rule in rules]
        compiled = [re.compile(rule.pattern) for rule in rules]
        vocabulary = {t: i for i, t in enumerate(sorted(set().union(*map(_trigrams, queries))), 1)}
        table = np.zeros(1 << 24, dtype=np.uint8 if len(vocabulary) < 256 else np.uint16)
        for trigram, number in vocabulary.items():
            if trigram.isascii():
                a, b, c = trigram.encode()
                table[a << 16 | b << 8 | c] = number
        for batch, data, offsets in B.slices(batches):
            index = _Index(vocabulary, table, data, offsets)
            texts: dict[int, str] = {}
            spans: list[list[tuple[int, int, int]]] = [[] for _ in range(index.rows)]
            for number, (rule, query, pattern) in enumerate(zip(rules, queries, compiled)):
                for row in index.candidates(query).tolist():
                    if row not in texts:
                        texts[row] = data[offsets[row]:offsets[row + 1]].tobytes().decode()
                    for match in pattern.finditer(texts[row]):
                        a, b = match.span(rule.group)
                        if b - a >= rule.least:
                            spans[row].append((match.start(), number, match.end()))
            out = [[{"kind": rules[n].kind, "start": a, "stop": b} for a, n, b in sorted(found)] for found in spans]
            yield pa.record_batch([batch.column("doc_id"), pa.array(out, pa.list_(_SPAN))], names=["doc_id", "spans"])

    return run


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, spans) per row of ``docs`` (doc_id, text): kind, start and stop of
    every secret, in code points, the stop exclusive, by start and then in the
    order of the rules. Matches of a rule do not overlap; those of different rules may.

    NULL and empty texts have no spans; rows that repeat are scanned alike; an
    empty table gives no rows.
    """
    return docs.select("doc_id", "text").mapInArrow(
        _scanner(rules), "doc_id bigint, spans array<struct<kind string, start int, stop int>>"
    )


def _told(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, a hash of the base spans and all spans as text."""
    base = [rule.kind for rule in BASE_RULES]

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", *(number(kind).alias(f"n_{kind}") for kind in base),
        F.sha2(_told(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        _told(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: ~s["kind"].isin(base))).cast("long").alias("n_more"),
    )
