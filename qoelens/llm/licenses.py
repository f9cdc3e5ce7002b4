"""License scan by ordered signature rules, in DataFrame functions only.

A text is lower-cased and becomes its words, one blank between; every rule is a
regular expression over that. Rules are gated by a keyword that any match
contains, so a text pays only for the rules it may match. Detections are
intervals of words. Where they overlap, order decides: a detection is dropped
when another one contains it - a longer one, or one of the same words by an
earlier rule. What is left gives the labels.

The base phrases are counted apart from the rules, wherever they stand.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.skew import materialise

# The base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Everything between words.
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Rule:
    """``pattern`` over words with a blank before each; ``keyword`` is in every match."""

    label: str
    keyword: str
    pattern: str


#: Licenses that come in versions: label, names (expressions over words), versions.
VERSIONED = [
    ("agpl", ["gnu affero general public license", "affero general public license", "agpl"], "1.0 3.0"),
    ("lgpl", ["gnu (?:lesser|library) general public license", "(?:lesser|library) general public license", "lgpl"], "2.0 2.1 3.0"),
    ("gpl", ["gnu general public license", "general public license", "gnu gpl", "gpl"], "1.0 2.0 3.0"),
    ("fdl", ["gnu free documentation license", "gfdl"], "1.1 1.2 1.3"),
    ("apache", ["apache software license", "apache license", "apache"], "1.0 1.1 2.0"),
    ("mpl", ["mozilla public license", "mpl"], "1.0 1.1 2.0"),
    ("epl", ["eclipse public license", "epl"], "1.0 2.0"),
    ("cddl", ["common development and distribution license", "cddl"], "1.0 1.1"),
    ("eupl", ["european union public licen[cs]e", "eupl"], "1.0 1.1 1.2"),
    ("osl", ["open software license", "osl"], "1.0 1.1 2.0 2.1 3.0"),
    ("afl", ["academic free license", "afl"], "1.1 1.2 2.0 2.1 3.0"),
    ("artistic", ["artistic license"], "1.0 2.0"),
    ("ofl", ["sil open font license", "open font license", "ofl"], "1.0 1.1"),
    ("lppl", ["latex project public license", "lppl"], "1.0 1.1 1.2 1.3"),
    ("psf", ["python software foundation license", "psf license"], "2.0"),
    ("php", ["php license"], "3.0 3.01"),
    ("zpl", ["zope public license"], "1.1 2.0 2.1"),
    ("apsl", ["apple public source license"], "1.0 1.1 1.2 2.0"),
    ("bsl", ["boost software license"], "1.0"),
    ("odbl", ["open database license", "odbl"], "1.0"),
    ("ms-pl", ["microsoft public license"], "1.0"),
    ("cecill", ["cecill"], "1.0 1.1 2.0 2.1"),
    ("upl", ["universal permissive license"], "1.0"),
]

#: Creative Commons conditions: label, short form, long form.
CONDITIONS = [
    ("by-nc-nd", "by nc nd", "attribution non ?commercial no ?deriv(?:atives|s)"),
    ("by-nc-sa", "by nc sa", "attribution non ?commercial share ?alike"),
    ("by-nc", "by nc", "attribution non ?commercial"),
    ("by-nd", "by nd", "attribution no ?deriv(?:atives|s)"),
    ("by-sa", "by sa", "attribution share ?alike"),
    ("by", "by", "attribution"),
]
CC_VERSIONS = "1.0 2.0 2.5 3.0 4.0"

#: Single rules: label, keyword, expression.
TEXTS = [
    ("mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "mit license", "mit license"),
    ("mit", "licensed under mit", "licensed under mit"),
    ("bsd", "redistribution and use", "redistribution and use in source and binary forms"),
    ("bsd-3-clause", "neither the name", "neither the name of (?:\\S+ ){1,12}nor the names of"),
    ("bsd-2-clause", "bsd", "(?:bsd 2 clause|2 clause bsd|simplified bsd)(?: license)?"),
    ("bsd-3-clause", "bsd", "(?:bsd 3 clause|3 clause bsd|(?:new|modified|revised) bsd)(?: license)?"),
    ("bsd-4-clause", "bsd", "(?:bsd 4 clause|4 clause bsd|original bsd)(?: license)?"),
    ("bsd", "bsd", "bsd(?: style)? license"),
    ("isc", "isc license", "isc license"),
    ("isc", "permission to use copy modify", "permission to use copy modify and or distribute this software for any purpose"),
    ("zlib", "zlib", "zlib(?: libpng)? license"),
    ("unlicense", "unencumbered", "free and unencumbered software released into the public domain"),
    ("unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("cc0", "cc0", "cc0(?: 1 0)?(?: universal)?"),
    ("public-domain", "public domain", "(?:in|into|to) the public domain"),
    ("public-domain", "public domain mark", "public domain mark"),
    ("proprietary", "proprietary", "(?:confidential and proprietary|proprietary and confidential)"),
    ("proprietary", "may be reproduced", "no part of this \\S+ may be reproduced"),
    ("copyright", "copyright", "copyright(?: c)? (?:19|20)\\d\\d(?: (?:19|20)\\d\\d)*"),
    ("warranty-disclaimer", "without warranty of any kind", "without warranty of any kind"),
    ("reserved", "rights reserved", "(?:all|some|no) rights reserved"),
    ("terms-of-use", "terms of use", "subject to the terms of use"),
    ("fair-use", "fair use", "fair use"),
]


def _number(version: str) -> str:
    """A version in words: ``2.0`` may be told as ``2``."""
    major, minor = version.split(".")
    return f"{major}(?: 0)?" if minor == "0" else f"{major} {minor}"


def _keyword(name: str) -> str:
    """The longest stretch of plain words of a name."""
    return max(re.split(r"\(\?:[^)]*\)|\[[^]]*\]\w*", name), key=len).strip()


def _versioned(label: str, name: str, versions: str) -> list[Rule]:
    """A name with each of its versions, with and without later ones, and alone."""
    found = []
    for version in versions.split():
        number = f"{name}(?: licen[cs]e)?(?: version)? (?:v ?)?{_number(version)}"
        found.append(Rule(f"{label}-{version}-or-later", _keyword(name), f"{number} or (?:at your option )?(?:any )?later(?: version)?"))
        found.append(Rule(f"{label}-{version}", _keyword(name), number))
    return [*found, Rule(label, _keyword(name), name)]


def rules() -> list[Rule]:
    """All rules in order, the more telling first."""
    out = [
        Rule(f"{label}-{version}", "spdx license identifier", f"spdx license identifier {label} {version.replace('.', ' ')}")
        for label, _, versions in VERSIONED for version in versions.split()
    ]
    for conditions, short, long in CONDITIONS:
        for version in CC_VERSIONS.split():
            number = _number(version)
            out.append(Rule(f"cc-{conditions}-{version}", "cc", f"cc {short} {number}"))
            out.append(Rule(f"cc-{conditions}-{version}", "creative commons", f"creative commons {long} {number}"))
            out.append(Rule(f"cc-{conditions}-{version}", "creative commons", f"creative commons {long} (?:international )?(?:public )?license(?: version)? {number}"))
        out.append(Rule(f"cc-{conditions}", "cc", f"cc {short}"))
        out.append(Rule(f"cc-{conditions}", "creative commons", f"creative commons {long}(?: license)?"))
    for label, names, versions in VERSIONED:
        for name in names:
            out += _versioned(label, name, versions)
    out += [Rule(label, keyword, pattern) for label, keyword, pattern in TEXTS]
    out.append(Rule("creative-commons", "creative commons", "creative commons"))
    out.append(Rule("license-mention", "licensed under", "licensed under the"))
    return out


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _table(ordered: list[Rule]) -> Column:
    """Rules by keyword: array<struct<keyword, rules: array<struct<rank, label, pattern>>>>."""
    groups: dict[str, list[tuple[int, Rule]]] = {}
    for rank, rule in enumerate(ordered):
        groups.setdefault(rule.keyword, []).append((rank, rule))

    def entry(rank: int, rule: Rule) -> Column:
        # A match takes the blank before each of its words and ends before a blank.
        return F.struct(F.lit(rank).alias("rank"), F.lit(f" (?:{rule.pattern})(?= )").alias("pattern"))

    return F.array(
        *(F.struct(F.lit(word).alias("keyword"), F.array(*(entry(*r) for r in group)).alias("rules")) for word, group in groups.items())
    )


def _base(docs: DataFrame, places: list[str]) -> DataFrame:
    """Of every phrase: how often, and its first and last word."""
    out = docs
    for name, phrase in zip(places, PHRASES):
        pieces = F.split("_words", f" {phrase}(?= )", -1)
        size, there = phrase.count(" ") + 1, F.contains("_words", F.lit(f" {phrase} "))
        out = out.withColumn(name, F.when(there, F.struct(
            (F.size(pieces) - 1).cast("long").alias("n"),
            _spaces(F.element_at(pieces, 1)).cast("long").alias("first"),
            (F.col("n_words") - (_spaces(F.element_at(pieces, -1)) - 1) - size).cast("long").alias("last"),
        )))
    return out


def _found(ordered: list[Rule]) -> Column:
    """array<struct<rank, k, gap, size>>: of every rule's k-th match the words since the last and its own."""
    def matches(rule: Column) -> Column:
        gaps = F.transform(F.split("_words", rule["pattern"], -1), _spaces)
        sizes = F.transform(F.regexp_extract_all("_words", rule["pattern"], F.lit(0)), _spaces)
        return F.transform(
            F.filter(F.arrays_zip(gaps.alias("gap"), sizes.alias("size")), lambda m: m["size"].isNotNull()),
            lambda m, k: F.struct(rule["rank"].alias("rank"), k.alias("k"), m["gap"].alias("gap"), m["size"].alias("size")),
        )

    open_ = F.filter(F.col("_rules"), lambda group: F.contains("_words", group["keyword"]))
    return F.flatten(F.transform(F.flatten(F.transform(open_, lambda group: group["rules"])), matches))


def scan(docs: DataFrame, ordered: list[Rule] | None = None) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, detections`` per row of ``docs`` (doc_id, text).

    ``n_base`` counts all places of the base phrases, ``first_word`` and
    ``last_word`` are the smallest and largest word at which one starts (NULL
    without any). ``labels`` are the base labels and those of the detections
    kept; ``score`` is 1 - 0.5^w for w words in detections kept, so 0 without any. NULL
    and empty texts have no words; rows that repeat are scanned alike; an
    empty table gives no rows.
    """
    ordered = rules() if ordered is None else ordered
    clean = F.trim(F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), _BREAK, " "))
    # A generated column is worked out once, however often it is referred to.
    words = docs.select("doc_id", F.explode(F.array(F.concat(F.lit(" "), clean, F.lit(" ")))).alias("_words"))
    words = words.withColumn("n_words", F.when(F.col("_words") == "  ", 0).otherwise(_spaces(F.col("_words")) - 1).cast("long"))
    places = [f"_p{i}" for i in range(len(PHRASES))]
    gate = F.lit(False)
    for keyword in dict.fromkeys(rule.keyword for rule in ordered):
        gate = gate | F.contains("_words", F.lit(keyword))
    gated = words.withColumn("_rules", F.when(gate, _table(ordered)))
    marked = _base(gated, places).withColumn("found", F.when(F.col("_rules").isNotNull(), _found(ordered)))
    rows = materialise(
        marked.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_words", *places, "found"), "detections"
    )

    label = F.element_at(F.array(*(F.lit(r.label) for r in ordered)), F.col("rank") + 1)
    each = rows.select("row", F.explode("found").alias("f")).select("row", "f.*")
    before = Window.partitionBy("row", "rank").orderBy("k")
    placed = each.select("row", "rank", "size", (F.sum(F.col("gap") + F.col("size")).over(before) - F.col("size")).alias("start"))
    placed = placed.withColumn("stop", F.col("start") + F.col("size"))
    outer = Window.partitionBy("row").orderBy("start", F.desc("stop"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    kept = placed.withColumn("_reach", F.max("stop").over(outer)).where("_reach is null or _reach < stop")
    per_row = kept.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "stop", label.alias("label")))).alias("detections"),
        F.sum("size").alias("_covered"),
    )
    base = [F.col(p) for p in places]
    base_labels = F.array_compact(F.array(*(F.when(p.isNotNull(), name) for p, name in zip(base, PHRASES.values()))))
    joined = rows.join(per_row, "row", "left")
    more = F.coalesce(F.transform("detections", lambda d: d["label"]), F.array().cast("array<string>"))
    return joined.select(
        "doc_id", "n_words",
        sum((F.coalesce(p["n"], F.lit(0)) for p in base), F.lit(0)).cast("long").alias("n_base"),
        F.least(*(p["first"] for p in base)).alias("first_word"),
        F.greatest(*(p["last"] for p in base)).alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base_labels, more))), ",").alias("labels"),
        (1 - F.pow(F.lit(0.5), F.coalesce("_covered", F.lit(0)).cast("double"))).alias("score"),
        "detections",
    )
