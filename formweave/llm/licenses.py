"""License scans by ordered signature rules, in DataFrame functions only.

A text is brought to its words (A-Z lowered; digits, letters and everything
beyond ASCII make words), joined by single spaces. Hundreds of signature rules,
regular expressions over whole words, are then tried: a rule runs only where its
keyword stands in the text; the keyword is a word of every text the rule matches. Each rule has a tier: tags first, full names next,
abbreviations last. A detection lying inside the interval of a detection of a
better tier, or inside a longer one of its own tier, is suppressed; the rules of
the base phrases are never suppressed.

The work is one pass over each row: no shuffle and no Python.
"""

from __future__ import annotations

import re
import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formweave.llm.common import whole_texts

# The base phrases and their labels.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BASE, _TAG, _NAME, _SHORT = -1, 0, 1, 2
_TIERS = 3


def _versioned(label: str, names: list[str], versions: list[str], keyword: str) -> list[tuple]:
    """Rules for a family with versions: with an 'or later' clause, with a version, without."""
    name = "(?:" + "|".join(names) + ")"
    rules = []
    for version in versions:
        digits = version.replace(".", " ")
        at = f"{name} (?:(?:as published by the free software foundation )?(?:version|v) ?)?{digits}"
        rules.append((f"{label}-{version}-or-later", _NAME, keyword, f"{at} or (?:at your option )?(?:any )?later"))
        rules.append((f"{label}-{version}", _NAME, keyword, at))
        rules.append((f"{label}-{version}", _NAME, keyword, f"{name} v{digits}"))
    rules.append((label, _SHORT, keyword, name))
    return rules


def _creative_commons() -> list[tuple]:
    """The licence elements in full and in short, for each version."""
    long = {
        "by": "attribution",
        "nc": "non ?commercial",
        "sa": "share ?alike",
        "nd": "no ?deriv(?:ative|ative work|s|atives)",
    }
    kinds = ["by", "by nc", "by sa", "by nd", "by nc sa", "by nc nd"]
    rules = []
    for kind in kinds:
        parts = kind.split()
        full = " ".join(long[p] for p in parts)
        label = "cc-" + "-".join(parts)
        for version in ["1.0", "2.0", "2.5", "3.0", "4.0"]:
            digits = version.replace(".", " ")
            rules.append((f"{label}-{version}", _TAG, "cc", f"cc {kind} {digits}"))
            rules.append((f"{label}-{version}", _NAME, "commons", f"creative commons {full} {digits}"))
            rules.append((f"{label}-{version}", _TAG, "creativecommons", f"creativecommons org licenses {kind} {digits}"))
            rules.append(
                (f"{label}-{version}", _NAME, "commons", f"creative commons {full} (?:international |generic |unported )?license {digits}")
            )
        rules.append((label, _SHORT, "cc", f"cc {kind}"))
        rules.append((label, _NAME, "commons", f"creative commons {full}"))
    rules.append(("cc0-1.0", _TAG, "cc0", "cc0(?: 1 0)?(?: universal)?"))
    rules.append(("cc0-1.0", _NAME, "creativecommons", "creativecommons org publicdomain zero 1 0"))
    rules.append(("cc", _SHORT, "commons", "creative commons(?: license)?"))
    return rules


def _tags() -> list[tuple]:
    """Machine-readable tags: 'SPDX-License-Identifier: <id>'."""
    ids = """mit apache-2.0 bsd-2-clause bsd-3-clause bsd-4-clause isc zlib unlicense wtfpl mpl-1.1 mpl-2.0
    epl-1.0 epl-2.0 cddl-1.0 cddl-1.1 gpl-1.0-only gpl-1.0-or-later gpl-2.0 gpl-2.0-only gpl-2.0-or-later gpl-3.0
    gpl-3.0-only gpl-3.0-or-later lgpl-2.0-only lgpl-2.0-or-later lgpl-2.1 lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0
    lgpl-3.0-only lgpl-3.0-or-later agpl-3.0 agpl-3.0-only agpl-3.0-or-later eupl-1.1 eupl-1.2 artistic-1.0
    artistic-2.0 bsl-1.0 postgresql python-2.0 psf-2.0 ofl-1.1 odbl-1.0 cc0-1.0 cc-by-4.0 cc-by-sa-4.0 ncsa
    afl-3.0 osl-3.0 ms-pl ms-rl 0bsd vim ruby php-3.01 openssl curl""".split()
    return [(i, _TAG, "spdx", "spdx license identifier " + re.sub(r"[-.]", " ", i)) for i in ids]


def signature_rules() -> list[tuple[str, int, str, str]]:
    """(label, tier, keyword, expression over words), hundreds of them, in order of priority."""
    rules = _tags() + _creative_commons()
    gnu = "(?:gnu )?"
    rules += _versioned("agpl", ["agpl"], ["3.0", "3"], "agpl")
    rules += _versioned("agpl", [f"{gnu}affero general public licen[cs]e"], ["3.0", "3"], "affero")
    rules += _versioned("lgpl", ["lgpl"], ["2.0", "2.1", "2", "3.0", "3"], "lgpl")
    rules += _versioned("lgpl", [f"{gnu}(?:lesser|library) general public licen[cs]e"], ["2.0", "2.1", "2", "3.0", "3"], "public")
    rules += _versioned("gpl", [f"{gnu}general public licen[cs]e"], ["1.0", "1", "2.0", "2", "3.0", "3"], "public")
    rules += _versioned("gpl", [f"{gnu}gpl"], ["1.0", "1", "2.0", "2", "3.0", "3"], "gpl")
    rules += _versioned("apache", ["apache (?:software )?licen[cs]e", "apache"], ["1.0", "1.1", "2.0", "2"], "apache")
    rules += _versioned("mpl", ["mozilla public licen[cs]e"], ["1.0", "1.1", "2.0", "2"], "mozilla")
    rules += _versioned("mpl", ["mpl"], ["1.0", "1.1", "2.0", "2"], "mpl")
    rules += _versioned("epl", ["eclipse public licen[cs]e"], ["1.0", "2.0"], "eclipse")
    rules += _versioned("cddl", ["common development and distribution licen[cs]e"], ["1.0", "1.1"], "development")
    rules += _versioned("eupl", ["eupl"], ["1.0", "1.1", "1.2"], "eupl")
    rules += _versioned("eupl", ["european union public licen[cs]e"], ["1.0", "1.1", "1.2"], "european")
    rules += _versioned("gfdl", [f"{gnu}free documentation licen[cs]e"], ["1.1", "1.2", "1.3"], "documentation")
    rules += _versioned("afl", ["academic free licen[cs]e"], ["1.2", "2.0", "2.1", "3.0"], "academic")
    rules += _versioned("osl", ["open software licen[cs]e"], ["1.0", "2.0", "2.1", "3.0"], "software")
    rules += _versioned("lppl", ["latex project public licen[cs]e"], ["1.0", "1.2", "1.3"], "latex")
    rules += _versioned("artistic", ["artistic licen[cs]e"], ["1.0", "2.0"], "artistic")
    rules += _versioned("boost", ["boost software licen[cs]e"], ["1.0"], "boost")
    rules += _versioned("odbl", ["open (?:data commons open )?database licen[cs]e"], ["1.0"], "database")
    rules += _versioned("ofl", ["(?:sil )?open font licen[cs]e"], ["1.0", "1.1"], "font")
    rules += _versioned("zpl", ["zope public licen[cs]e"], ["1.1", "2.0", "2.1"], "zope")
    rules += _versioned("php", ["php licen[cs]e"], ["3.0", "3.01"], "php")
    rules += _versioned("bsl", ["business source licen[cs]e"], ["1.0", "1.1"], "business")
    rules += _versioned("sspl", ["server side public licen[cs]e"], ["1"], "server")
    rules += [
        ("mit", _NAME, "mit", "(?:the )?mit licen[cs]e"),
        ("mit", _NAME, "permission", "permission is hereby granted free of charge to any person obtaining a copy"),
        ("mit", _SHORT, "mit", "licensed under (?:the )?mit"),
        ("isc", _NAME, "isc", "(?:the )?isc licen[cs]e"),
        ("isc", _NAME, "permission", "permission to use copy modify and or distribute this software for any purpose"),
        ("bsd-2-clause", _NAME, "bsd", "(?:simplified bsd|bsd 2 clause|2 clause bsd)(?: licen[cs]e)?"),
        ("bsd-2-clause", _NAME, "freebsd", "freebsd(?: licen[cs]e)?"),
        ("bsd-3-clause", _NAME, "bsd", "(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd)(?: licen[cs]e)?"),
        ("bsd-4-clause", _NAME, "bsd", "(?:original bsd|bsd 4 clause|4 clause bsd)(?: licen[cs]e)?"),
        ("bsd", _SHORT, "bsd", "bsd(?: style)? licen[cs]e"),
        ("bsd", _NAME, "redistribution", "redistribution and use in source and binary forms"),
        ("unlicense", _NAME, "unencumbered", "free and unencumbered software released into the public domain"),
        ("unlicense", _NAME, "unlicense", "(?:the )?unlicense"),
        ("public-domain", _NAME, "domain", "(?:released |placed |dedicated )?(?:in|into|to) the public domain"),
        ("wtfpl", _NAME, "wtfpl", "wtfpl"),
        ("zlib", _NAME, "zlib", "zlib(?: libpng)? licen[cs]e"),
        ("postgresql", _NAME, "postgresql", "postgresql licen[cs]e"),
        ("python", _NAME, "python", "python software foundation licen[cs]e"),
        ("openssl", _NAME, "openssl", "openssl licen[cs]e"),
        ("proprietary", _NAME, "proprietary", "proprietary (?:and|or) confidential"),
        ("proprietary", _NAME, "redistribute", "(?:do not|may not) (?:copy or )?redistribute"),
        ("reserved", _SHORT, "reserved", "(?:some|no|all other) rights reserved"),
        ("copyright", _SHORT, "copyright", "copyright (?:c )?(?:19|20)[0-9]{2}"),
    ]
    return rules


def _lowered(text: Column) -> Column:
    """A-Z in lower case; other letters stay, also those whose lower case is one of a-z."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def _words(text: Column) -> Column:
    """The words of a text, each followed by a blank, one blank before the first."""
    return F.concat(F.lit(" "), F.ltrim(F.regexp_replace(F.concat(_lowered(text), F.lit(" ")), _NOT_WORD, " ")))


def _blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _keyword_rules() -> Column:
    """Literal array of (keyword, rules); a rule is (label, tier, number, expression)."""
    by_keyword: dict[str, list[Column]] = {}
    rules = [(label, _BASE, phrase.split()[-1], phrase) for phrase, label in BASE_PHRASES.items()] + signature_rules()
    for number, (label, tier, keyword, expression) in enumerate(rules):
        rule = F.struct(
            F.lit(label).alias("label"),
            F.lit(tier).alias("tier"),
            F.lit(number).alias("number"),
            F.lit(f"(?<= )(?:{expression})(?= )").alias("expression"),
        )
        by_keyword.setdefault(keyword, []).append(rule)
    return F.array(
        *[F.struct(F.lit(f" {k} ").alias("keyword"), F.array(*r).alias("rules")) for k, r in by_keyword.items()]
    )


def _gate() -> str:
    """An expression that any text with a keyword matches."""
    keywords = {k for _, _, k, _ in signature_rules()} | {p.split()[-1] for p in BASE_PHRASES}
    return " (?:" + "|".join(sorted(keywords)) + ") "


def _places(words: Column, rule: Column) -> Column:
    """All places of a rule: array of (first word, last word, tier, number, label).

    Both ends of each match are marked inside the text, so the word numbers are
    found by one pass over its words.
    """
    marked = F.split(F.trim(F.regexp_replace(words, rule["expression"], F.lit("\u0001$0\u0002"))), " ")
    starts = F.filter(F.transform(marked, lambda w, i: F.when(F.startswith(w, F.lit("\u0001")), i)), F.isnotnull)
    ends = F.filter(F.transform(marked, lambda w, i: F.when(F.endswith(w, F.lit("\u0002")), i)), F.isnotnull)
    return F.zip_with(
        starts,
        ends,
        lambda a, b: F.struct(
            a.cast("long").alias("first"),
            (-b).cast("long").alias("last"),  # negative: longer intervals sort first
            rule["tier"].alias("tier"),
            rule["number"].alias("number"),
            rule["label"].alias("label"),
        ),
    )


def _detections(words: Column) -> Column:
    """Places of every rule whose keyword stands in the text, in order of their starts."""
    tried = F.flatten(
        F.transform(F.filter(_keyword_rules(), lambda k: F.contains(words, k["keyword"])), lambda k: k["rules"])
    )
    hit = F.filter(tried, lambda r: F.regexp_like(words, r["expression"]))
    return F.array_sort(F.flatten(F.transform(hit, lambda r: _places(words, r))))


def _surviving(detections: Column) -> Column:
    """(labels, number of detections) left after suppression.

    Detections come ordered by start, longer first. So one lies inside another
    of a tier at least as good exactly when the furthest end so far, over those
    tiers, is not before its own end: one pass, whatever the number of places.
    """
    tiers = [f"end{t}" for t in range(_TIERS)]
    start = F.struct(
        *[F.lit(-1).cast("long").alias(t) for t in tiers],
        F.array().cast("array<string>").alias("labels"),
        F.lit(0).cast("long").alias("n"),
    )

    def step(s: Column, d: Column) -> Column:
        end = -d["last"]
        reach = reduce(lambda rest, t: F.when(d["tier"] == t, s[tiers[t]]).otherwise(rest), range(_TIERS), F.lit(-1))
        stays = (d["tier"] == _BASE) | (reach < end)
        return F.struct(
            *[F.when(d["tier"].between(0, t), F.greatest(s[n], end)).otherwise(s[n]).alias(n) for t, n in enumerate(tiers)],
            F.when(stays, F.array_union(s["labels"], F.array(d["label"]))).otherwise(s["labels"]).alias("labels"),
            (s["n"] + F.when(stays, 1).otherwise(0)).alias("n"),
        )

    return F.aggregate(detections, start, step)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """License detections in every whole text of ``docs`` (doc_id, text).

    Returns per row: doc_id, n_words, n_base (all places of the base phrases),
    first_word and last_word (smallest and largest start of those, null if none),
    base_labels and labels (distinct, sorted, joined by commas; base labels are
    in both), score (n / (n + 1) for n surviving detections), and detections, the
    array of all places as (first, last, tier, number, label). Null and empty
    texts have no words, no detections and score 0. Repeated rows are scanned
    each; an empty table gives an empty table; other columns are not looked at.
    """
    words = whole_texts(docs).select("doc_id", _words(F.col("text")).alias("words"))
    none = F.array().cast("array<struct<first:bigint,last:bigint,tier:int,number:int,label:string>>")
    found = words.select(
        "doc_id",
        (_blanks(F.col("words")) - 1).cast("long").alias("n_words"),
        F.when(F.col("words").rlike(_gate()), _detections(F.col("words"))).otherwise(none).alias("found"),
    )
    base = F.filter("found", lambda d: d["tier"] == _BASE)
    kept = found.select(
        "doc_id", "n_words", "found", base.alias("base"), F.when(F.size("found") > 0, _surviving(F.col("found"))).alias("kept")
    )
    starts = F.transform("base", lambda d: d["first"])
    return kept.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        _joined(F.transform("base", lambda d: d["label"])).alias("base_labels"),
        F.coalesce(_joined(F.col("kept.labels")), F.lit("")).alias("labels"),
        F.coalesce(F.col("kept.n") / (F.col("kept.n") + 1), F.lit(0.0)).alias("score"),
        F.transform(
            "found",
            lambda d: F.struct(
                d["first"], (-d["last"]).alias("last"), d["tier"].alias("tier"), d["number"].alias("number"), d["label"].alias("label")
            ),
        ).alias("detections"),
    )


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")
