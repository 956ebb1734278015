"""License scan: ordered signature rules over normalised words.

A text becomes its lower-case words joined by single blanks. Rules are expressions over that form, each
behind a keyword: only texts with a rule's keyword are tried against it, and only texts with any gate
word are normalised at all. Detections inside a detection of the same or a higher priority are
suppressed; what remains gives the labels and the score. Everything is column expressions.

Defined cases: a NULL text is empty and has no words; repeated rows and equal or NULL ids are scanned
one by one; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.texts import let, lower_ascii

# Phrases and labels that are always reported.
BASE = {
    "gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit",
}


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: str
    keyword: str
    priority: int


LIC = "licen[cs]e"
BY = "(?: (?:under|by|with|on))?(?: the)?(?: terms of(?: the)?)?"

# (label, expression, keyword, priority); full texts and exact versions rank above families, those above bare names.
_WRITTEN = [
    # full texts and headers
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "hereby", 90),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "modify", 90),
    ("bsd", "redistribution and use in source and binary forms with or without modification", "redistribution", 85),
    ("bsd-3-clause", "neither the name of .{1,80}? nor the names of its contributors may be used", "contributors", 90),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software", "advertising", 90),
    ("gpl", "this program is free software you can redistribute it and or modify", "redistribute", 85),
    ("gpl", "everyone is permitted to copy and distribute verbatim copies", "verbatim", 85),
    ("lgpl", "this library is free software you can redistribute it and or modify", "redistribute", 85),
    ("apache-2.0", "you may not use this file except in compliance with the license", "compliance", 88),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed", "applicable", 86),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla", 92),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered", 92),
    ("wtfpl", "do what the fuck you want to public license", "fuck", 90),
    ("zlib", "this software is provided as is without any express or implied warranty in no event", "implied", 84),
    ("bsl-1.0", "boost software license(?: version)? 1 0", "boost", 90),
    ("bsl-1.0", "boost software license", "boost", 70),
    ("cc0-1.0", "the person who associated a work with this deed has dedicated the work", "dedicated", 90),
    ("public-domain", "(?:dedicated to|released into|placed in(?:to)?|is in) the public domain", "domain", 60),
    ("public-domain", "no rights reserved", "reserved", 55),
    ("proprietary", "all rights reserved", "reserved", 40),
    ("proprietary", "(?:confidential and proprietary|proprietary and confidential)", "proprietary", 60),
    ("proprietary", "may not be (?:reproduced|copied|distributed) without (?:the )?(?:prior )?written (?:permission|consent)",
     "written", 60),
    ("proprietary", "unauthorized (?:copying|use|reproduction|distribution) (?:of this file )?is (?:strictly )?prohibited",
     "prohibited", 60),
    ("copyright-notice", "copyright(?: c)?(?: \\d{4})+ \\S+", "copyright", 30),
    ("commercial", "commercial licen[cs]e", "commercial", 45),
    ("eula", "end user licen[cs]e agreement", "user", 60),
    # grants by name
    ("mit", f"(?:released|licensed|distributed|available|provided){BY} mit license", "license", 80),
    ("mit", f"(?:released|licensed|distributed|available|provided){BY} mit licence", "licence", 80),
    ("mit", f"(?:released|licensed|distributed|available|provided){BY} (?:the )?mit", "mit", 75),
    ("isc", f"(?:released|licensed|distributed|available|provided){BY} (?:the )?isc", "isc", 75),
    ("bsd-2-clause", "bsd 2 clause", "bsd", 70), ("bsd-3-clause", "bsd 3 clause", "bsd", 70), ("bsd-4-clause", "bsd 4 clause", "bsd", 70),
    ("bsd-2-clause", "(?:simplified|2 clause) bsd", "bsd", 70), ("bsd-3-clause", "(?:new|modified|revised|3 clause) bsd", "bsd", 70),
    ("apache", f"(?:released|licensed|distributed|available|provided){BY} apache(?: {LIC})?", "apache", 75),
    ("gpl", f"(?:released|licensed|distributed|available|provided){BY} (?:gnu )?gpl", "gpl", 75),
    ("gpl", f"(?:released|licensed|distributed|available|provided){BY} gnu general public {LIC}", "gnu", 75),
    ("lgpl", f"(?:released|licensed|distributed|available|provided){BY} (?:gnu )?lgpl", "lgpl", 75),
    ("agpl", f"(?:released|licensed|distributed|available|provided){BY} (?:gnu )?agpl", "agpl", 75),
    ("bsd", f"(?:released|licensed|distributed|available|provided){BY} bsd(?: {LIC})?", "bsd", 75),
    ("mpl", f"(?:released|licensed|distributed|available|provided){BY} mozilla public {LIC}", "mozilla", 75),
    ("cc", f"(?:released|licensed|distributed|available|provided){BY} (?:a )?creative commons", "creative", 70),
    # names
    ("mit", "mit license", "license", 60), ("mit", "mit licence", "licence", 60), ("mit", f"expat {LIC}", "expat", 60), ("mit", f"x11 {LIC}", "x11", 55),
    ("gpl", f"gnu general public {LIC}", "gnu", 60), ("gpl", "gnu gpl", "gpl", 58),
    ("lgpl", f"gnu (?:lesser|library) general public {LIC}", "gnu", 62),
    ("agpl", f"gnu affero general public {LIC}", "affero", 62),
    ("agpl", f"affero general public {LIC}", "affero", 60), ("fdl", f"gnu free documentation {LIC}", "gnu", 62),
    ("apache", f"apache (?:software )?{LIC}", "apache", 60),
    ("bsd", f"bsd(?: style)? {LIC}", "bsd", 58), ("bsd", "berkeley software distribution", "berkeley", 58),
    ("isc", f"isc {LIC}", "isc", 60), ("zlib", f"zlib {LIC}", "zlib", 60),
    ("mpl", f"mozilla public {LIC}", "mozilla", 60), ("epl", f"eclipse public {LIC}", "eclipse", 60),
    ("cddl", f"common development and distribution {LIC}", "development", 60),
    ("cpl", f"common public {LIC}", "common", 58), ("ipl", f"ibm public {LIC}", "ibm", 58),
    ("artistic", f"artistic {LIC}", "artistic", 60), ("artistic", f"perl artistic {LIC}", "perl", 62),
    ("eupl", f"european union public {LIC}", "european", 62), ("osl", f"open software {LIC}", "open", 55),
    ("afl", f"academic free {LIC}", "academic", 58), ("ofl", f"(?:sil )?open font {LIC}", "font", 60),
    ("odbl", f"open database {LIC}", "database", 60),
    ("odc-by", f"open data commons attribution {LIC}", "commons", 62),
    ("pddl", f"public domain dedication and {LIC}", "dedication", 62),
    ("ms-pl", f"microsoft public {LIC}", "microsoft", 60), ("ms-rl", f"microsoft reciprocal {LIC}", "microsoft", 60),
    ("psf", f"python software foundation {LIC}", "python", 60), ("python", f"python {LIC}", "python", 50),
    ("php", f"php {LIC}", "php", 52), ("ruby", f"ruby {LIC}", "ruby", 52), ("openssl", f"openssl {LIC}", "openssl", 58),
    ("vim", f"vim {LIC}", "vim", 52), ("postgresql", f"postgresql {LIC}", "postgresql", 58),
    ("w3c", f"w3c software (?:notice and )?{LIC}", "w3c", 60), ("ncsa", f"university of illinois ncsa", "ncsa", 60),
    ("curl", f"curl {LIC}", "curl", 50), ("sleepycat", f"sleepycat {LIC}", "sleepycat", 58),
    ("sspl", f"server side public {LIC}", "server", 62), ("busl", f"business source {LIC}", "business", 62),
    ("elastic", f"elastic {LIC}", "elastic", 58), ("commons-clause", "commons clause", "clause", 58),
    ("llama", f"llama(?: \\d)? community {LIC}", "llama", 60), ("rail", f"responsible ai {LIC}", "responsible", 58), ("rail", f"openrail {LIC}", "openrail", 58),
    ("bigscience-rail", f"bigscience rail {LIC}", "bigscience", 60), ("gfdl", "gfdl", "gfdl", 50),
    ("cc", f"creative commons(?: {LIC})?", "creative", 45), ("cc0-1.0", "cc0(?: 1 0)?", "cc0", 60),
    ("cc0-1.0", "creative commons zero", "creative", 62), ("cc-pdm", "public domain mark(?: 1 0)?", "mark", 58),
    ("ogl", f"open government {LIC}", "government", 60), ("ogl", "ogl (?:uk )?(?:v )?[123](?: 0)?", "ogl", 58),
    ("copyleft", "copyleft", "copyleft", 35), ("permissive", f"permissive(?: open source)? {LIC}", "permissive", 35),
    ("open-source", f"open source {LIC}", "open", 30), ("free-software", f"free software {LIC}", "free", 30),
]


def _versioned() -> list[tuple[str, str, str, int]]:
    """Rules for exact versions: every name with every version it was published in."""
    names = [
        ("gpl", f"gnu general public {LIC}", "gnu", "1 2 3"), ("gpl", "gpl", "gpl", "1 2 3"),
        ("lgpl", f"gnu (?:lesser|library) general public {LIC}", "gnu", "2 2.1 3"), ("lgpl", "lgpl", "lgpl", "2 2.1 3"),
        ("agpl", f"(?:gnu )?affero general public {LIC}", "affero", "1 3"), ("agpl", "agpl", "agpl", "1 3"),
        ("fdl", f"gnu free documentation {LIC}", "gnu", "1.1 1.2 1.3"),
        ("apache", f"apache {LIC}", "apache", "1.0 1.1 2.0"), ("apache", "apache", "apache", "1.1 2.0"),
        ("mpl", f"mozilla public {LIC}", "mozilla", "1.0 1.1 2.0"), ("mpl", "mpl", "mpl", "1.1 2.0"),
        ("epl", f"eclipse public {LIC}", "eclipse", "1.0 2.0"), ("eupl", "eupl", "eupl", "1.1 1.2"),
        ("cddl", "cddl", "cddl", "1.0 1.1"), ("artistic", f"artistic {LIC}", "artistic", "1.0 2.0"),
        ("osl", f"open software {LIC}", "open", "1.0 2.0 2.1 3.0"), ("afl", f"academic free {LIC}", "academic", "2.1 3.0"),
        ("ofl", f"open font {LIC}", "font", "1.0 1.1"), ("zpl", f"zope public {LIC}", "zope", "2.0 2.1"),
        ("odbl", "odbl", "odbl", "1.0"), ("busl", f"business source {LIC}", "business", "1.1"),
        ("elastic", f"elastic {LIC}", "elastic", "2.0"), ("php", f"php {LIC}", "php", "3.0 3.01"),
        ("lppl", f"latex project public {LIC}", "latex", "1.0 1.3"), ("ecl", f"educational community {LIC}", "educational", "1.0 2.0"),
    ]
    out = []
    for label, name, keyword, versions in names:
        for version in versions.split():
            # "2.0" is also written "2"; a version that goes on with another number is another version.
            major, _, minor = version.partition(".")
            number = version.replace(".", " ") if minor not in ("", "0") else f"{major}(?: 0)?"
            end = "(?! [0-9])" if minor in ("", "0") else ""
            out.append((f"{label}-{version}", f"{name}(?: version)? v?{number}{end}", keyword, 70))
            out.append((f"{label}-{version}-or-later", f"{name}(?: version)? v?{number} or (?:any )?later", keyword, 78))
            # Written as one word, as in gplv3 or apache2: the word itself is the keyword.
            if name == keyword:
                for joined in (f"{keyword}v{major}", f"{keyword}{major}"):
                    rest = f" {minor}" if minor not in ("", "0") else "(?: 0)?"
                    out.append((f"{label}-{version}", f"{joined}{rest}{end}", joined, 70))
                    out.append((f"{label}-{version}-or-later", f"{joined}{rest} or (?:any )?later", joined, 78))
    return out


def _creative_commons() -> list[tuple[str, str, str, int]]:
    parts = {"by": "attribution", "nc": "non ?commercial", "sa": "share ?alike", "nd": "no ?deriv(?:ative)?s?(?: works)?"}
    out = []
    for kind in ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd"):
        short = "cc " + kind.replace("-", " ")
        long = "creative commons " + " ".join(parts[p] for p in kind.split("-"))
        rank = 60 + 2 * kind.count("-")
        out.append((f"cc-{kind}", f"{short}(?! (?:nc|sa|nd))", "cc", rank))
        out.append((f"cc-{kind}", f"{long}(?! (?:non ?commercial|share ?alike|no ?deriv))", "creative", rank))
        for version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            number = version.replace(".", " ")
            out.append((f"cc-{kind}-{version}", f"{short} {number}", "cc", rank + 10))
            out.append((f"cc-{kind}-{version}", f"{long}(?: international| unported)? {number}", "creative", rank + 10))
    return out


def _identifiers() -> list[tuple[str, str, str, int]]:
    names = """MIT MIT-0 Apache-1.1 Apache-2.0 GPL-1.0 GPL-2.0 GPL-3.0 LGPL-2.0 LGPL-2.1 LGPL-3.0 AGPL-3.0 BSD-2-Clause
    BSD-3-Clause BSD-4-Clause 0BSD ISC Zlib MPL-1.1 MPL-2.0 EPL-1.0 EPL-2.0 CDDL-1.0 CC0-1.0 CC-BY-4.0 CC-BY-SA-4.0
    Unlicense WTFPL BSL-1.0 Artistic-2.0 EUPL-1.2 OFL-1.1 ODbL-1.0 PostgreSQL NCSA UPL-1.0 MS-PL Python-2.0""".split()
    spelled = [(name.lower(), name.lower().replace("-", " ").replace(".", " ")) for name in names]
    return [(label, f"spdx {LIC} identifier {words}(?: (?:only|or later))?(?! [0-9])", "spdx", 95) for label, words in spelled]


RULES = [Rule(*row) for row in _WRITTEN + _versioned() + _creative_commons() + _identifiers()]
BASE_RULES = [Rule(label, phrase, "cc" if phrase == "cc by" else "license", 60) for phrase, label in BASE.items()]
KEYWORDS = sorted({rule.keyword for rule in RULES + BASE_RULES})
CLASSES = 10
MARK = "\x01"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _table(rules: list[Rule]) -> Column:
    """The rules as one array literal; a pattern starts and ends between blanks."""
    rows = [
        F.struct(
            F.lit(r.label).alias("label"), F.lit(f"(?<= )(?:{r.pattern})(?= )").alias("regex"),
            F.lit(r.keyword).alias("keyword"), F.lit(r.priority).alias("priority"),
        )
        for r in rules
    ]
    return F.array(*rows)


def _matching(rules: Column, keywords: Column, norm: Column) -> Column:
    """Rules whose keyword is there and whose expression occurs."""
    return F.filter(rules, lambda r: F.array_contains(keywords, r["keyword"]) & F.rlike(norm, r["regex"]))


def _places(norm: Column, rule: Column) -> Column:
    """Detections of one rule as (start, end, priority, label) in words.

    The first word of every match is marked; the marked places and the matches' lengths are the intervals.
    """
    marked = F.split(F.regexp_replace(norm, rule["regex"], F.lit(f"{MARK}$0")), " ", -1)
    starts = F.filter(F.transform(marked, lambda w, i: F.when(w.startswith(MARK), i - 1)), lambda i: i.isNotNull())
    lengths = F.transform(F.regexp_extract_all(norm, rule["regex"], F.lit(0)), lambda m: F.size(F.split(m, " ", -1)))
    return F.zip_with(
        starts, lengths,
        lambda start, length: F.struct(
            start.alias("start"), (start + length).alias("end"), rule["priority"].alias("priority"), rule["label"].alias("label")
        ),
    )


def _detections(rules: Column, keywords: Column, norm: Column) -> Column:
    return F.flatten(F.transform(_matching(rules, keywords, norm), lambda r: _places(norm, r)))


def _resolved(found: Column) -> Column:
    """Detections that lie in no other one of the same or a higher class of priority.

    Sorted by start, then from long to short, whatever holds a detection stands before it, so one sweep
    with the farthest end per class decides.
    """
    order = F.transform(
        found,
        lambda d: F.struct(
            d["start"].alias("start"), (-d["end"]).alias("back"), (-d["priority"]).alias("rank"), d["label"].alias("label")
        ),
    )
    kind = "array<struct<start:int,end:int,priority:int,label:string>>"
    begin = F.struct(
        F.array().cast(kind).alias("kept"), F.array_repeat(F.lit(-1), CLASSES).alias("ends")
    )

    def step(state: Column, d: Column) -> Column:
        end, priority = -d["back"], -d["rank"]
        of = F.least(F.floor(priority / CLASSES), F.lit(CLASSES - 1)).cast("int")
        one = F.struct(d["start"].alias("start"), end.alias("end"), priority.alias("priority"), d["label"].alias("label"))
        grown = F.struct(
            F.concat(state["kept"], F.array(one)).cast(kind).alias("kept"),
            F.transform(state["ends"], lambda far, c: F.when(c <= of, F.greatest(far, end)).otherwise(far)).alias("ends"),
        )
        return F.when(F.get(state["ends"], of) >= end, state).otherwise(grown)

    return F.aggregate(F.sort_array(order), begin, step, lambda state: state["kept"])


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_words, base, detections``; intervals in words, end exclusive. One map pass in the JVM."""
    none = F.array().cast("array<struct<start:int,end:int,priority:int,label:string>>")

    def of_words(found: Column) -> Column:
        return let(F.array_intersect(found, F.array(*[F.lit(k) for k in KEYWORDS])), lambda keys: F.struct(
            F.size(found).cast("long").alias("n_words"),
            F.when(F.size(keys) > 0, let(_norm(found), lambda norm: F.struct(
                _detections(_table(BASE_RULES), keys, norm).alias("base"),
                _resolved(_detections(_table(RULES), keys, norm)).alias("detections"),
            ))).otherwise(F.struct(none.alias("base"), none.alias("detections"))).alias("f"),
        ))

    plain = F.split(lower_ascii(F.coalesce(F.col(text), F.lit(""))), NOT_WORD, -1)
    found = docs.select(
        F.col(key).alias("_key"), F.inline(F.array(let(F.filter(plain, lambda w: w != ""), of_words)))
    )
    return found.select(F.col("_key").alias(key), "n_words", "f.base", "f.detections")


def _norm(found: Column) -> Column:
    return F.concat(F.lit(" "), F.array_join(found, " "), F.lit(" "))


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts and labels per row; the score is the highest surviving priority, over 100."""
    starts = F.transform("base", lambda d: d["start"])
    base_labels = F.array_distinct(F.transform("base", lambda d: d["label"]))
    own = F.transform("detections", lambda d: d["label"])
    ranks = F.transform(F.concat("base", "detections"), lambda d: d["priority"] / F.lit(100.0))
    return found.select(
        F.col(key), "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(F.sort_array(base_labels), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_distinct(F.concat(base_labels, own))), ",").alias("labels"),
        F.coalesce(F.array_max(ranks), F.lit(0.0)).alias("score"), F.size("detections").cast("long").alias("n_detections"),
    )
