"""License scan by ordered signature rules, in DataFrame operations only.

A text becomes lower-case words joined by single blanks.  One pass finds the
keywords in a text; of the rules only those whose keyword was found are tried.  Every place a rule matches is a detection (rule, label, first word, end word).
Detections are swept by first word, the longer first and the higher priority first among
equal ones: one that lies inside an earlier one is dropped.  Detections of rules that name
no particular license count only where nothing particular is left.  Everything happens
inside the row: no shuffle, no group, nothing that grows with other rows.

Base phrases (``BASE``) are reported at every place, whatever the sweep drops.

Defined results: a null or wordless text has no detection, no labels (empty text) and score
0; repeated rows give repeated results; no rows give no rows; extra columns are kept, the
columns added here replace columns of the same name.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.base import NOT_A_LETTER, ascii_lower, query, table

#: Fixed by contract: phrase -> label.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Rules: (priority, weight, label, keyword, pattern).  Patterns run over words joined by single
# blanks and stand between blanks.  Priority 1: a grant or header sentence; 2: a full name;
# 3: a short name or identifier; 9: a license of no particular kind.
V = r"(?: version| v| ver)?"

#: Families with versions: label, keyword, name pattern, versions.
VERSIONED = (
    ("gpl", "gnu general public", r"gnu general public licen[sc]e", ("1 0", "2 0", "3 0", "1", "2", "3")),
    ("lgpl", "lesser general public", r"(?:gnu )?lesser general public licen[sc]e", ("2 1", "3 0", "3")),
    ("lgpl", "library general public", r"(?:gnu )?library general public licen[sc]e", ("2 0", "2")),
    ("agpl", "affero", r"(?:gnu )?affero general public licen[sc]e", ("1 0", "3 0", "3")),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation licen[sc]e", ("1 1", "1 2", "1 3")),
    ("apache", "apache", r"apache(?: software)? licen[sc]e", ("1 0", "1 1", "2 0", "2")),
    ("mpl", "mozilla", r"mozilla public licen[sc]e", ("1 0", "1 1", "2 0")),
    ("epl", "eclipse", r"eclipse public licen[sc]e", ("1 0", "2 0")),
    ("cddl", "common development", r"common development and distribution licen[sc]e", ("1 0", "1 1")),
    ("cpl", "common public", r"common public licen[sc]e", ("1 0",)),
    ("eupl", "european union public", r"european union public licen[sc]e", ("1 0", "1 1", "1 2")),
    ("artistic", "artistic", r"(?:perl )?artistic licen[sc]e", ("1 0", "2 0")),
    ("bsl", "boost", r"boost software licen[sc]e", ("1 0",)),
    ("busl", "business source", r"business source licen[sc]e", ("1 0", "1 1")),
    ("sspl", "server side public", r"server side public licen[sc]e", ("1",)),
    ("osl", "open software", r"open software licen[sc]e", ("1 0", "2 0", "2 1", "3 0")),
    ("afl", "academic free", r"academic free licen[sc]e", ("1 1", "1 2", "2 0", "2 1", "3 0")),
    ("zpl", "zope", r"zope public licen[sc]e", ("1 1", "2 0", "2 1")),
    ("ofl", "open font", r"(?:sil )?open font licen[sc]e", ("1 0", "1 1")),
    ("psf", "python", r"python(?: software foundation)? licen[sc]e", ("2", "2 0")),
    ("php", "php licen", r"php licen[sc]e", ("3 0", "3 01")),
    ("lppl", "latex project", r"latex project public licen[sc]e", ("1 0", "1 1", "1 2", "1 3")),
    ("apsl", "apple public", r"apple public source licen[sc]e", ("1 0", "1 1", "1 2", "2 0")),
    ("npl", "netscape", r"netscape public licen[sc]e", ("1 0", "1 1")),
    ("ipl", "ibm public", r"ibm public licen[sc]e", ("1 0",)),
    ("qpl", "q public", r"q public licen[sc]e", ("1 0",)),
    ("upl", "universal permissive", r"universal permissive licen[sc]e", ("1 0",)),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)? licen[sc]e", ("1 0",)),
    ("cecill", "cecill", r"cecill(?: free software)?(?: licen[sc]e)?", ("1 0", "1 1", "2 0", "2 1")),
    ("odbl", "open database", r"open database licen[sc]e", ("1 0",)),
    ("odcby", "open data commons attribution", r"open data commons attribution licen[sc]e", ("1 0",)),
    ("mspl", "microsoft public", r"microsoft public licen[sc]e", ("1 0",)),
    ("msrl", "microsoft reciprocal", r"microsoft reciprocal licen[sc]e", ("1 0",)),
    ("elastic", "elastic", r"elastic licen[sc]e", ("1 0", "2 0")),
    ("openssl", "openssl", r"openssl licen[sc]e", ("1 0",)),
    ("rail", "open rail", r"(?:creativeml )?open rail(?: [ms])?(?: licen[sc]e)?", ("1 0",)),
)

#: Short identifiers with versions: label, identifier, versions, endings.
IDENTIFIERS = (
    ("gpl", "gpl", ("1 0", "2 0", "3 0"), ("", " only", " or later")),
    ("lgpl", "lgpl", ("2 0", "2 1", "3 0"), ("", " only", " or later")),
    ("agpl", "agpl", ("1 0", "3 0"), ("", " only", " or later")),
    ("apache", "apache", ("1 0", "1 1", "2 0"), ("",)),
    ("mpl", "mpl", ("1 0", "1 1", "2 0"), ("",)),
    ("epl", "epl", ("1 0", "2 0"), ("",)),
    ("bsl", "bsl", ("1 0",), ("",)),
    ("eupl", "eupl", ("1 1", "1 2"), ("",)),
    ("artistic", "artistic", ("1 0", "2 0"), ("",)),
    ("ofl", "ofl", ("1 1",), ("",)),
)

#: Creative Commons: the letters of the condition, its words, versions.
COMMONS = (
    ("by", "attribution", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("by sa", "attribution share ?alike", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("by nc", "attribution non ?commercial", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("by nd", "attribution no ?deriv(?:ative|ativework|ative work)s?", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("by nc sa", "attribution non ?commercial share ?alike", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("by nc nd", "attribution non ?commercial no ?deriv(?:ative|ativework|ative work)s?", ("1 0", "2 0", "2 5", "3 0", "4 0")),
)

#: Written out one by one.
SINGLE = (
    (1, 0.95, "mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    (1, 0.95, "isc", "permission to use copy modify", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    (1, 0.95, "bsd", "redistribution and use", r"redistribution and use in source and binary forms with or without modification are permitted"),
    (1, 0.95, "zlib", "provided as is", r"this software is provided as is without any express or implied warranty"),
    (1, 0.95, "gpl", "free software", r"is free software you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e"),
    (1, 0.95, "lgpl", "free software", r"is free software you can redistribute it and or modify it under the terms of the gnu lesser general public licen[sc]e"),
    (1, 0.95, "agpl", "free software", r"is free software you can redistribute it and or modify it under the terms of the gnu affero general public licen[sc]e"),
    (1, 0.95, "apache", "apache", r"licen[sc]ed under the apache licen[sc]e version 2 0 the licen[sc]e"),
    (1, 0.95, "mpl", "mozilla", r"this source code form is subject to the terms of the mozilla public licen[sc]e"),
    (1, 0.95, "unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    (1, 0.95, "cc0", "dedicated", r"has dedicated the work to the public domain"),
    (1, 0.95, "wtfpl", "do what the", r"do what the f[a-z]* you want to(?: public licen[sc]e)?"),
    (1, 0.95, "boost", "permission is hereby granted", r"permission is hereby granted free of charge to any person or organization obtaining a copy"),
    (1, 0.9, "mit", "mit licen", r"(?:released|licen[sc]ed|available|distributed) under(?: the terms of)? the mit licen[sc]e"),
    (1, 0.9, "bsd", "bsd", r"(?:released|licen[sc]ed|available|distributed) under(?: the terms of)? (?:the|a) bsd(?: style)? licen[sc]e"),
    (1, 0.9, "gpl", "general public", r"(?:released|licen[sc]ed|available|distributed) under(?: the terms of)? the(?: gnu)? general public licen[sc]e"),
    (1, 0.9, "apache", "apache", r"(?:released|licen[sc]ed|available|distributed) under(?: the terms of)? the apache licen[sc]e"),
    (2, 0.85, "mit", "mit licen", r"(?:the )?mit licen[sc]e"), (2, 0.85, "mit", "expat", r"expat licen[sc]e"), (2, 0.85, "mit", "x11", r"x11 licen[sc]e"),
    (2, 0.85, "mit-0", "mit no attribution", r"mit no attribution(?: licen[sc]e)?"), (2, 0.8, "mit", "mit open source", r"mit open source licen[sc]e"), (2, 0.8, "mit", "mit style", r"mit style(?: open source)? licen[sc]e"),
    (2, 0.85, "bsd", "bsd", r"(?:the )?(?:new|simplified|modified|revised|original|free)? ?bsd(?: style)? licen[sc]e"),
    (2, 0.85, "bsd-0", "bsd", r"(?:zero clause|0 clause) bsd(?: licen[sc]e)?"), (2, 0.85, "bsd-1", "bsd", r"(?:one|1) clause bsd(?: licen[sc]e)?"),
    (2, 0.85, "bsd-2", "bsd", r"(?:two|2) clause bsd(?: licen[sc]e)?"), (2, 0.85, "bsd-3", "bsd", r"(?:three|3) clause bsd(?: licen[sc]e)?"),
    (2, 0.85, "bsd-4", "bsd", r"(?:four|4) clause bsd(?: licen[sc]e)?"), (3, 0.75, "bsd-0", "0bsd", "0bsd"),
    (3, 0.75, "bsd-1", "bsd", r"bsd 1 clause"), (3, 0.75, "bsd-2", "bsd", r"bsd 2 clause"), (3, 0.75, "bsd-3", "bsd", r"bsd 3 clause"), (3, 0.75, "bsd-4", "bsd", r"bsd 4 clause"),
    (2, 0.85, "isc", "isc licen", r"isc licen[sc]e"), (2, 0.85, "zlib", "zlib", r"zlib(?: libpng)? licen[sc]e"), (2, 0.85, "curl", "curl licen", r"curl licen[sc]e"),
    (2, 0.85, "unlicense", "unlicense", r"(?:the )?unlicense"), (2, 0.85, "wtfpl", "wtfpl", r"wtfpl"), (2, 0.85, "beerware", "beerware", r"beerware licen[sc]e"),
    (2, 0.85, "gpl", "general public", r"(?:gnu )?general public licen[sc]e"), (2, 0.85, "lgpl", "lesser general public", r"(?:gnu )?lesser general public licen[sc]e"),
    (2, 0.85, "agpl", "affero", r"(?:gnu )?affero general public licen[sc]e"), (2, 0.85, "apache", "apache", r"apache(?: software)? licen[sc]e"),
    (2, 0.85, "cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?"), (2, 0.85, "cc0", "creative commons", r"creative commons zero"),
    (2, 0.8, "cc", "creative commons", r"creative commons(?: public)? licen[sc]e"),
    (2, 0.85, "hpnd", "historical permission", r"historical permission notice and disclaimer"), (2, 0.85, "vim", "vim licen", r"vim licen[sc]e"),
    (2, 0.85, "ruby", "ruby licen", r"ruby licen[sc]e"), (2, 0.85, "postgresql", "postgresql", r"postgresql licen[sc]e"), (2, 0.85, "unicode", "unicode licen", r"unicode licen[sc]e"),
    (2, 0.85, "w3c", "w3c", r"w3c software(?: notice and)? licen[sc]e"), (2, 0.85, "json", "json licen", r"json licen[sc]e"), (2, 0.85, "ftl", "freetype", r"freetype(?: project)? licen[sc]e"),
    (2, 0.85, "ijg", "independent jpeg", r"independent jpeg group(?: licen[sc]e)?"), (2, 0.85, "libpng", "libpng", r"libpng licen[sc]e"), (2, 0.85, "mulan", "mulan", r"mulan permissive software licen[sc]e"),
    (2, 0.85, "bigscience", "bigscience", r"bigscience (?:open )?rail(?: m)?(?: licen[sc]e)?"), (2, 0.85, "llama", "community licen", r"llama(?: [0-9])* community licen[sc]e"),
    (2, 0.8, "public-domain", "public domain", r"(?:released|placed|dedicated) (?:in|in ?to|to) the public domain"), (3, 0.6, "public-domain", "public domain", r"public domain"),
    (3, 0.75, "mit", "spdx", r"spdx license identifier mit"), (3, 0.75, "isc", "spdx", r"spdx license identifier isc"), (3, 0.75, "unlicense", "spdx", r"spdx license identifier unlicense"),
    (3, 0.7, "proprietary", "all rights reserved", r"all rights reserved"), (3, 0.7, "proprietary", "proprietary", r"proprietary and confidential"),
    (3, 0.7, "proprietary", "commercial licen", r"commercial licen[sc]e"), (3, 0.7, "proprietary", "end user", r"end user licen[sc]e agreement"),
    (9, 0.4, "unknown", "licen", r"(?:released|licen[sc]ed|available|distributed) under(?: the terms of)?"), (9, 0.3, "unknown", "licen", r"licen[sc]e(?:s|d)?"),
    (9, 0.2, "unknown", "copyright", r"copyright"), (9, 0.3, "unknown", "copyleft", r"copyleft"), (9, 0.3, "unknown", "terms of use", r"terms of use"),
)


@cache
def rules() -> tuple[tuple[int, float, str, str, str], ...]:
    """All signatures in order: base phrases, then by priority as written."""
    out = [(2, 0.85, label, keyword, phrase) for (phrase, label), keyword in zip(BASE, ("mit licen", "apache", "general public"))] + list(SINGLE)
    for label, keyword, name, versions in VERSIONED:
        out.append((2, 0.85, label, keyword, name))
        out += [(1, 0.9, f"{label}-{v.replace(' ', '.')}", keyword, rf"{name}{V} {v}") for v in versions]
    for label, short, versions, endings in IDENTIFIERS:
        out += [(3, 0.75, f"{label}-{v.replace(' ', '.')}{e.replace(' ', '-')}", short if len(short) > 4 else f"{short} ", rf"{short}(?: v)? {v}{e}") for v in versions for e in endings]
    for letters, names, versions in COMMONS:
        label = "cc-" + letters.replace(" ", "-")
        out += [(3, 0.75, label, "cc by", rf"cc {letters}"), (2, 0.85, label, "creative commons", rf"creative commons {names}")]
        for v in versions:
            out += [(2, 0.85, f"{label}-{v.replace(' ', '.')}", "cc by", rf"cc {letters} {v}"),
                    (1, 0.9, f"{label}-{v.replace(' ', '.')}", "creative commons", rf"creative commons {names}(?: licen[sc]e)? {v}")]
    return tuple(sorted(out, key=lambda r: r[0]))


def _gate(keywords: list[str]) -> str:
    """One expression that finds the keyword, if any, at the start of each word, branching on the first letter.

    No keyword begins another one, so every word start has at most one and none hides another.
    """
    if any(a != b and b.startswith(a) for a in keywords for b in keywords):
        raise ValueError("a keyword begins another one")
    by: dict[str, list[str]] = {}
    for k in keywords:
        by.setdefault(k[0], []).append(k[1:])
    return " (?=(" + "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in sorted(by.items())) + "))"


def words_text(text: Column) -> Column:
    """Lower-case words joined by single blanks, one blank before and after; two blanks without words."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), NOT_A_LETTER, " ")), F.lit(" "))


def _blanks(x: str) -> str:
    return f"(length({x}) - length(replace({x}, ' ', '')))"


def _places(pattern: str) -> str:
    """SQL: (first word, end word) of all places of a pattern in ``_norm``, by counting blanks between matches."""
    bounded = f"concat('(?<= )(?:', {pattern}, ')(?= )')"
    return f"""
      aggregate(
        zip_with(split(_norm, {bounded}), regexp_extract_all(_norm, {bounded}, 0),
                 (p, m) -> struct({_blanks('p')} AS gap, {_blanks('m')} AS own)),
        struct(-1 AS at, CAST(array() AS array<struct<s: int, e: int>>) AS found),
        (a, x) -> struct(a.at + x.gap + coalesce(x.own, 0) AS at,
                         IF(x.own IS NULL, a.found, concat(a.found, array(struct(a.at + x.gap AS s, a.at + x.gap + x.own + 1 AS e)))) AS found),
        a -> a.found)"""


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, detections (array of rule, label, weight, first word, end word), base (places of base phrases), labels and score."""
    by: dict[str, list] = {}
    for i, (p, w, label, k, x) in enumerate(rules()):
        by.setdefault(k, []).append(F.struct(F.lit(i).alias("rule"), F.lit(p).alias("priority"), F.lit(w).alias("weight"),
                                             F.lit(label).alias("label"), F.lit(x).alias("pattern")))
    signatures = F.array(*[F.struct(F.lit(k).alias("keyword"), F.array(*r).alias("rules")) for k, r in by.items()])
    base = F.array(*[F.struct(F.lit(label).alias("label"), F.lit(phrase).alias("pattern")) for phrase, label in BASE])
    out = docs.drop("n_words", "detections", "base", "labels", "score", "_norm", "_hits", "_rules", "_bases", "_all", "_kept")
    out = out.withColumn("_norm", words_text(F.col(text)))
    out = out.withColumn("n_words", F.when(F.col("_norm") == "  ", F.lit(0)).otherwise(F.expr(_blanks("_norm")) - 1).cast("long"))
    out = out.withColumn("_hits", F.array_distinct(F.regexp_extract_all("_norm", F.lit(_gate(list(by))), F.lit(1))))
    gated = F.size("_hits") > 0
    out = out.withColumn("_rules", F.when(gated, F.filter(signatures, lambda k: F.array_contains(F.col("_hits"), k["keyword"]))))
    out = out.withColumn("_bases", F.when(gated, base))
    out = out.withColumn("base", F.expr(f"flatten(transform(_bases, b -> transform({_places('b.pattern')}, x -> struct(x.s AS s, x.e AS e, b.label AS label))))"))
    out = out.withColumn("_all", F.expr(f"""
        array_sort(flatten(transform(flatten(transform(_rules, k -> k.rules)),
          r -> transform({_places('r.pattern')}, x -> struct(x.s AS s, -x.e AS back, r.priority AS priority, r.rule AS rule, r.label AS label, r.weight AS weight)))))"""))
    out = out.withColumn("_kept", F.expr("""
        aggregate(_all, struct(-1 AS till, slice(_all, 1, 0) AS kept),
          (a, d) -> IF(-d.back <= a.till, a, struct(-d.back AS till, concat(a.kept, array(d)) AS kept)), a -> a.kept)"""))
    out = out.withColumn("_kept", F.expr("IF(exists(_kept, d -> d.priority < 9), filter(_kept, d -> d.priority < 9), _kept)"))
    out = out.withColumn("detections", F.expr("coalesce(transform(_kept, d -> struct(d.rule, d.label, d.weight, d.s AS first_word, -d.back AS end_word)), array())"))
    out = out.withColumn("labels", F.expr("array_sort(array_union(transform(detections, d -> d.label), transform(coalesce(base, array()), b -> b.label)))"))
    out = out.withColumn("score", F.expr("1.0D - aggregate(detections, 1.0D, (a, d) -> a * (1.0D - CAST(d.weight AS double)))"))
    return out.drop("_norm", "_hits", "_rules", "_bases", "_all", "_kept").withColumn("base", F.expr("coalesce(base, array())"))


@query("op8_licenses")
def op8_licenses(spark, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.expr("array_min(transform(base, b -> b.s))").cast("long").alias("first_word"),
        F.expr("array_max(transform(base, b -> b.s))").cast("long").alias("last_word"),
        F.expr("array_join(array_sort(array_distinct(transform(base, b -> b.label))), ',')").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score")
