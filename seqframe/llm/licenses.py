"""License scan: ordered signature rules over word-normalised texts.

A text is lower-cased (A-Z) and reduced to its words joined by single spaces, so
rules are plain regular expressions over words: names of license families in their versions,
and phrases of license bodies and notices that hold no name.  One pass of a single
alternation finds the keywords of a text (whole words; a version may be joined to them).  A rule runs
only on texts with one of its keywords and, where only a license word or a grant makes the
keyword a license, with one of those too; every match of its pattern holds
both, so nothing is lost by that.  Every match becomes a detection ``(first word, last word, tier, rule)``.  Rules are
ordered by tier, then by position in the table.  A detection whose interval lies inside
that of a detection of the same or a higher tier is suppressed, so "licensed under the
apache license version 2 0" is reported once, as ``apache-2.0``, and the plain
"license" inside it is not reported.

Detections stay in the row: everything is one projection without a shuffle.  They
are sorted by first word, longer first, and folded once with the running largest
end of each tier, so a text with many detections costs n log n.

The labels of the three base phrases are always kept.  Null and empty texts have no
words, no labels and score 0.  Repeated rows give repeated results; an empty table
an empty one; extra columns are ignored.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqframe.llm.common import read

# Separators between words, after lower-casing A-Z.
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BASE_PHRASES = [("mit license", "mit"), ("apache license", "apache"),
                ("general public license", "gpl")]

#: Confidence of a detection by tier.
TIERS = {0: 1.0, 1: 0.95, 2: 0.9, 3: 0.6, 4: 0.3}

CC = "cc by|creative commons attribution"


@dataclass(frozen=True)
class Family:
    """A license in its versions; names are patterns over words.

    Every match of a name, short name or identifier holds one of ``keywords`` (by "|") as whole words,
    but for a version joined to it.
    ``short`` names a license with a version and no "license"; ``alone`` without a version too.
    ``spdx`` is the identifier, empty if there is none beside the name.
    """

    label: str
    keywords: str
    name: str
    versions: tuple[str, ...] = ()
    spdx: str = ""
    short: str = ""
    alone: bool = False


_BY = r"(?:cc by|creative commons attribution)"
_NC, _SA, _ND = r"non ?commercial", r"share ?alike", r"no ?deriv(?:ative)?s"
_GPL = "general public"
FAMILIES: list[Family] = [
    Family("apache", "apache", r"apache(?: software)?(?: foundation)?", ("1.0", "1.1", "2.0"), "apache"),
    Family("gpl", "general public|gpl", rf"(?:gnu )?{_GPL}", ("1.0", "2.0", "3.0"), "gpl",
           r"(?:gnu )?gpl", True),
    Family("lgpl", "lesser general public|library general public|lgpl",
           rf"(?:gnu )?(?:lesser|library) {_GPL}", ("2.0", "2.1", "3.0"), "lgpl", r"(?:gnu )?lgpl", True),
    Family("agpl", "affero general public|agpl", rf"(?:gnu )?affero {_GPL}", ("1.0", "3.0"), "agpl",
           r"(?:gnu )?agpl", True),
    Family("gfdl", "free documentation|gfdl|fdl", r"(?:gnu )?free documentation", ("1.1", "1.2", "1.3"),
           "gfdl", r"(?:gfdl|gnu fdl)", True),
    Family("mpl", "mozilla|mpl", r"mozilla public", ("1.0", "1.1", "2.0"), "mpl", "mpl"),
    Family("epl", "eclipse|epl", r"eclipse public", ("1.0", "2.0"), "epl", "epl"),
    Family("cddl", "distribution|cddl", r"common development and distribution", ("1.0", "1.1"), "cddl",
           "cddl", True),
    Family("eupl", "european|eupl", r"european union public", ("1.1", "1.2"), "eupl", "eupl", True),
    Family("osl", "open software|osl", r"open software", ("1.0", "2.0", "3.0"), "osl", "osl"),
    Family("afl", "academic|afl", r"academic free", ("2.1", "3.0"), "afl", "afl"),
    Family("artistic", "artistic", r"artistic", ("1.0", "2.0"), "artistic"),
    Family("boost", "boost|bsl", r"boost(?: software)?", ("1.0",), "bsl", "bsl"),
    Family("bsd-2-clause", "bsd|freebsd",
           r"(?:bsd (?:2|two) clause|(?:2|two) clause bsd|simplified bsd|freebsd)", (), "bsd 2 clause"),
    Family("bsd-3-clause", "bsd",
           r"(?:bsd (?:3|three) clause|(?:3|three) clause bsd|(?:new|revised|modified) bsd)", (),
           "bsd 3 clause"),
    Family("bsd-4-clause", "bsd",
           r"(?:bsd (?:4|four) clause|(?:4|four) clause bsd|(?:original|old) bsd)", (), "bsd 4 clause"),
    Family("bsd", "bsd", r"bsd"),
    Family("mit", "mit", r"(?:the )?mit", (), "mit"),
    Family("expat", "expat", r"expat"),
    Family("x11", "x11", r"x11", (), "x11"),
    Family("isc", "isc", r"isc", (), "isc"),
    Family("zlib", "zlib", r"zlib(?: libpng)?", (), "zlib"),
    Family("unlicense", "unlicense", r"unlicense", (), "unlicense", "unlicense", True),
    Family("wtfpl", "do what the fuck|wtfpl", r"do what the fuck you want to public", ("2.0",), "wtfpl",
           "wtfpl", True),
    Family("ms-pl", "microsoft|ms pl", r"microsoft public", (), "ms pl", "ms pl", True),
    Family("ms-rl", "microsoft|ms rl", r"microsoft reciprocal", (), "ms rl", "ms rl", True),
    Family("python", "python|psf", r"(?:python(?: software foundation)?|psf)", ("2.0",), "(?:python|psf)"),
    Family("php", "php", r"php", ("3.0", "3.01"), "php"),
    Family("ruby", "ruby", r"ruby", (), "ruby"),
    Family("postgresql", "postgresql", r"postgresql", (), "postgresql"),
    Family("openssl", "openssl", r"openssl", (), "openssl"),
    Family("sil-ofl", "open font|ofl", r"(?:sil )?open font", ("1.0", "1.1"), "ofl", r"(?:sil )?ofl"),
    Family("odbl", "database|odbl", r"open (?:data commons open )?database", ("1.0",), "odbl", "odbl", True),
    Family("cc-by", CC, _BY, ("2.0", "3.0", "4.0"), "cc by", _BY, True),
    Family("cc-by-sa", CC, f"{_BY} (?:sa|{_SA})", ("2.0", "3.0", "4.0"), "cc by sa",
           f"{_BY} (?:sa|{_SA})", True),
    Family("cc-by-nd", CC, f"{_BY} (?:nd|{_ND})", ("3.0", "4.0"), "cc by nd", f"{_BY} (?:nd|{_ND})", True),
    Family("cc-by-nc", CC, f"{_BY} (?:nc|{_NC})", ("2.0", "3.0", "4.0"), "cc by nc",
           f"{_BY} (?:nc|{_NC})", True),
    Family("cc-by-nc-sa", CC, f"{_BY} (?:nc sa|{_NC} {_SA})", ("3.0", "4.0"), "cc by nc sa",
           f"{_BY} (?:nc sa|{_NC} {_SA})", True),
    Family("cc-by-nc-nd", CC, f"{_BY} (?:nc nd|{_NC} {_ND})", ("3.0", "4.0"), "cc by nc nd",
           f"{_BY} (?:nc nd|{_NC} {_ND})", True),
    Family("cc0", "cc0|creative commons zero", r"(?:cc0|creative commons zero)", ("1.0",), "cc0",
           r"(?:cc0|creative commons zero)", True),
]

_LICENSE = r"licen[sc]e"
_GRANT = r"(?:licensed|released|distributed|provided|available|published)"
_PORT = r"(?: (?:international|unported|universal|generic))?"
_FSF = r"(?: as published by the free software foundation(?: inc)?(?: either)?)?"


#: Words without which the name of a license says nothing: "mit" alone is no license.
ANCHORS = ("license", "licence", "under")

_GAP = r"(?: [^ ]+){0,%d}?"
_URL = r"(?:www )?"
# Phrases of license bodies, notices and addresses as their authors publish them,
# as (label, keyword, pattern over words).
BODIES: list[tuple[str, str, str]] = [
    ("mit", "permission is hereby granted",
     "permission is hereby granted free of charge to any person obtaining a copy of this software and "
     "associated documentation files the software to deal in the software without restriction"),
    ("mit", "the above copyright notice and this permission notice",
     "the above copyright notice and this permission notice(?: including the next paragraph)? shall be "
     "included in all copies or substantial portions of the software"),
    ("x11", "except as contained in this notice",
     "except as contained in this notice the names? of" + _GAP % 12 +
     " shall not be used in advertising or otherwise to promote the sale use or other dealings"),
    ("ncsa", "permission is hereby granted",
     "permission is hereby granted free of charge to any person obtaining a copy of this software and "
     "associated documentation files the software to deal with the software without restriction"),
    ("json", "the software shall be used for good", "the software shall be used for good not evil"),
    ("boost-1.0", "permission is hereby granted",
     "permission is hereby granted free of charge to any person or organization obtaining a copy of the "
     "software and accompanying documentation covered by this license"),
    ("sil-ofl-1.1", "permission is hereby granted",
     "permission is hereby granted free of charge to any person obtaining a copy of the font software"),
    ("sil-ofl-1.1", "the goals of the open font",
     "the goals of the open font license ofl are to stimulate worldwide development of collaborative font "
     "projects"),
    ("isc", "permission to use copy modify",
     "permission to use copy modify and(?: or)? distribute this software for any purpose with or without "
     "fee is hereby granted provided that the above copyright notice and this permission notice appear in "
     "all copies"),
    ("0bsd", "permission to use copy modify",
     "permission to use copy modify and(?: or)? distribute this software for any purpose with or without "
     "fee is hereby granted(?= the software)"),
    ("postgresql", "permission to use copy modify",
     "permission to use copy modify and distribute this software and its documentation for any purpose "
     "without fee and without a written agreement is hereby granted"),
    ("hpnd", "permission to use copy modify",
     "permission to use copy modify(?: and)? distribute(?: and sell)? this software and its documentation "
     "for any purpose (?:and )?(?:is hereby granted )?without fee(?: is hereby granted)? provided that"),
    ("bsd", "redistribution and use in source and binary forms",
     "redistribution and use in source and binary forms with or without modification are permitted "
     "provided that the following conditions are met"),
    ("bsd-2-clause", "redistribution and use in source and binary forms",
     "redistribution and use in source and binary forms with or without modification are permitted "
     "provided that the following conditions are met" + _GAP % 60 +
     " disclaimer in the documentation and or other materials provided with the distribution this software "
     "is provided by"),
    # Before the three clauses, which hold in the same interval.
    ("bsd-4-clause", "redistribution and use in source and binary forms",
     "redistribution and use in source and binary forms with or without modification are permitted "
     "provided that the following conditions are met" + _GAP % 70 +
     " all advertising materials mentioning features or use of this software must display the following "
     "acknowledge?ment" + _GAP % 60 + " (?:neither the names? of|the names? of)" + _GAP % 30 +
     " (?:may|be) (?:not )?(?:be )?used to endorse or promote products derived from this software without "
     "specific prior written permission"),
    ("bsd-3-clause", "redistribution and use in source and binary forms",
     "redistribution and use in source and binary forms with or without modification are permitted "
     "provided that the following conditions are met" + _GAP % 90 +
     " (?:neither the names? of|the names? of)" + _GAP % 30 + " (?:may|be) (?:not )?(?:be )?used to endorse "
     "or promote products derived from this software without specific prior written permission"),
    ("zlib", "this software is provided as is",
     "this software is provided as is without any express or implied warranty in no event will the "
     "authors? be held liable for any damages arising from the use of this software"),
    ("zlib", "the origin of this software must not be misrepresented",
     "the origin of this software must not be misrepresented you must not claim that you wrote the "
     "original software"),
    ("apache-2.0", "licensed under the apache",
     "licensed under the apache license version 2 0 the license you may not use this file except in "
     "compliance with the license"),
    ("apache-2.0", "each contributor hereby grants to you",
     "subject to the terms and conditions of this license each contributor hereby grants to you a "
     "perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|except)"),
    ("apache-1.1", "this product includes software developed by the apache",
     r"this product includes software developed by the apache (?:software foundation|group)"),
    ("gpl-1.0", "this program is free software",
     "this program is free software you can redistribute it and or modify it under the terms of the gnu "
     "general public license as published by the free software foundation either version 1"),
    ("gpl-2.0", "this program is free software",
     "this program is free software you can redistribute it and or modify it under the terms of the gnu "
     "general public license (?:version 2 as published by the free software foundation|"
     "as published by the free software foundation (?:either )?version 2)"),
    ("gpl-3.0", "this program is free software",
     "this program is free software you can redistribute it and or modify it under the terms of the gnu "
     "general public license as published by the free software foundation either version 3"),
    ("gpl-2.0", "the licenses for most software are designed",
     "the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl-3.0", "is a free copyleft",
     "general public license is a free copyleft license for software and other kinds of works"),
    ("lgpl-2.1", "this library is free software",
     "this library is free software you can redistribute it and or modify it under the terms of the gnu "
     "lesser general public license as published by the free software foundation either version 2 1"),
    ("lgpl-2.0", "this library is free software",
     "this library is free software you can redistribute it and or modify it under the terms of the gnu "
     "library general public license as published by the free software foundation either version 2"),
    ("lgpl-3.0", "this version of the gnu lesser general public",
     "this version of the gnu lesser general public license incorporates the terms and conditions of "
     "version 3 of the gnu general public license"),
    ("agpl-3.0", "affero general public",
     "gnu affero general public license is a free copyleft license for software and other kinds of works "
     "specifically designed to ensure cooperation with the community"),
    ("gfdl", "permission is granted to copy",
     "permission is granted to copy distribute and or modify this document under the terms of the gnu free "
     "documentation license"),
    ("mpl-2.0", "this source code form is subject",
     "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-1.1", "the contents of this file are subject",
     "the contents of this file are subject to the mozilla public license version 1 1"),
    ("cddl", "the contents of this file are subject",
     "the contents of this file are subject to the terms of the common development and distribution "
     "license"),
    ("epl", "the accompanying program is provided",
     "the accompanying program is provided under the terms of this eclipse public license"),
    ("eupl", "this european union public",
     "this european union public licen[sc]e the eupl applies to the work"),
    ("artistic-1.0", "the intent of this document",
     "the intent of this document is to state the conditions under which a package may be copied such that "
     "the copyright holder maintains some semblance of artistic control"),
    ("unlicense", "this is free and unencumbered software",
     "this is free and unencumbered software released into the public domain"),
    ("unlicense", "anyone is free to copy",
     "anyone is free to copy modify publish use compile sell or distribute this software either in source "
     "code form or as a compiled binary"),
    ("wtfpl", "you just do what the fuck", "you just do what the fuck you want to"),
    ("beerware", "as long as you retain this notice",
     "as long as you retain this notice you can do whatever you want with this stuff"),
    ("ms-pl", "if you use the software you accept",
     "if you use the software you accept this license if you do not accept the license do not use the "
     "software"),
    ("python-2.0", "psf hereby grants",
     "psf hereby grants licensee a nonexclusive royalty free world wide license"),
    ("openssl", "this product includes software developed by the openssl",
     "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("php", "this product includes php", "this product includes php software freely available from"),
    ("cc0-1.0", "to the extent possible under law",
     "to the extent possible under law" + _GAP % 20 +
     " has waived all copyright and related or neighboring rights"),
    ("cc0-1.0", "creativecommons org publicdomain zero", "creativecommons org publicdomain zero 1 0"),
    ("cc-by-4.0", "creativecommons org", "creativecommons org licenses by 4 0"),
    ("cc-by-sa-4.0", "creativecommons org", "creativecommons org licenses by sa 4 0"),
    ("cc-by-sa-3.0", "creativecommons org", "creativecommons org licenses by sa 3 0"),
    ("cc-by-nc-4.0", "creativecommons org", "creativecommons org licenses by nc 4 0"),
    ("cc-by-nc-sa-4.0", "creativecommons org", "creativecommons org licenses by nc sa 4 0"),
    ("cc-by-nc-nd-4.0", "creativecommons org", "creativecommons org licenses by nc nd 4 0"),
    ("cc-by-nd-4.0", "creativecommons org", "creativecommons org licenses by nd 4 0"),
    ("mit", "opensource org", f"{_URL}opensource org licenses? mit(?: license(?: php)?)?"),
    ("bsd-3-clause", "opensource org", f"{_URL}opensource org licenses? bsd 3 clause"),
    ("bsd-2-clause", "opensource org", f"{_URL}opensource org licenses? bsd 2 clause"),
    ("apache-2.0", "apache org", f"{_URL}apache org licenses license 2 0"),
    ("gpl-3.0", "gnu org", f"{_URL}gnu org licenses gpl 3 0"),
    ("gpl-2.0", "gnu org", f"{_URL}gnu org licenses (?:old licenses )?gpl 2 0"),
    ("lgpl-2.1", "gnu org", f"{_URL}gnu org licenses (?:old licenses )?lgpl 2 1"),
    ("lgpl-3.0", "gnu org", f"{_URL}gnu org licenses lgpl 3 0"),
    ("agpl-3.0", "gnu org", f"{_URL}gnu org licenses agpl 3 0"),
    ("mpl-2.0", "mozilla org", f"{_URL}mozilla org mpl 2 0"),
    ("epl-2.0", "eclipse org", f"{_URL}eclipse org legal epl (?:v20|2 0)"),
    ("sil-ofl-1.1", "scripts sil org", "scripts sil org ofl"),
    ("boost-1.0", "boost org", f"{_URL}boost org license 1 0"),
    ("unlicense", "unlicense org", f"{_URL}unlicense org"),
]


@dataclass(frozen=True)
class Rule:
    """Every match of ``pattern`` holds one of ``keywords`` and, if ``anchored``, one of ANCHORS."""

    tier: int
    label: str
    keywords: tuple[str, ...]
    pattern: str
    base: bool = False
    anchored: bool = False


def _wordings(f: Family, version: str) -> list[tuple[int, str]]:
    """Tier and pattern of a family's identifier, of grants under its name, and of mentions."""
    words = version.replace(".", " ").removesuffix(" 0")
    number = rf"{words}(?: 0)*"
    after = rf" (?:version |ver |v ?)?{number}(?: of the {_LICENSE})?" if version else ""
    # A number or its v may be joined to a short name: "gplv3", "lgpl2 1".
    joined = rf"(?: (?:version |ver |v ?)?|v ?)?{number}" if version else ""
    aside = rf"(?: {f.short})?" if f.short else ""
    full = rf"{f.name} {_LICENSE}{aside}{_FSF if version else ''}{after}"
    granted = [full, rf"{f.name}{after}(?:{_PORT} {_LICENSE})?"]
    named = [full, rf"{f.name}{after}{_PORT} {_LICENSE}"]
    if version:
        named.append(rf"version {number} of the {f.name} {_LICENSE}")
    if f.short:
        granted.append(rf"{f.short}(?: {_LICENSE})?{joined}(?: {_LICENSE})?")
        if version:
            named.append(rf"{f.short}(?: {_LICENSE})?{joined}(?: {_LICENSE})?")
            named.append(rf"version {number} of the {f.short}")
        else:
            named.append(rf"{f.short} {_LICENSE}")
    identifier = rf"{f.name}(?: {_LICENSE})?{after}" + (rf"|{f.spdx}{joined}" if f.spdx else "")
    out = [(0, rf"spdx {_LICENSE} identifier (?:{identifier})"),
           (1, rf"{_GRANT} under (?:the )?(?:terms of (?:the )?)?(?:a |an )?(?:{'|'.join(granted)})"),
           (2, rf"(?:{'|'.join(named)})")]
    if version:
        # The second of two versions: "gpl version 2 or version 3".  Its interval holds the first
        # version's, so it ranks below it and does not suppress it.
        base = rf"(?:{f.name} {_LICENSE}{aside}" + (rf"|{f.short}(?: {_LICENSE})?)" if f.short else ")")
        first = rf"{_FSF}(?: (?:version |versions |ver |v ?)?|v ?)?\d(?: \d\d?)?(?: of the {_LICENSE})?"
        out.append((3, rf"{base}{first} (?:or|and) (?:version |ver |v ?)?{number}"))
    if f.alone and not version:
        out.append((3, f.short))
    return out


def build_rules() -> list[Rule]:
    """The rule table: families x versions x wordings, then generic notices, then base phrases."""
    rules = []
    for f in FAMILIES:
        for version in [*f.versions, ""]:
            for tier, pattern in _wordings(f, version):
                # An unversioned name is less specific than a versioned one.
                at = tier if version or not f.versions else max(tier, 2)
                label = f"{f.label}-{version}" if version else f.label
                rules.append(Rule(at, label, tuple(f.keywords.split("|")), pattern,
                                  anchored=not f.short))
    rules += [Rule(1, label, (keyword,), pattern) for label, keyword, pattern in BODIES]
    rules += [
        Rule(3, "public-domain", ("public domain",), r"(?:in|into|to) the public domain"),
        Rule(3, "all-rights-reserved", ("copyright",),
             r"copyright(?: [^ ]+){0,8}? all rights reserved"),
        Rule(3, "proprietary", ("proprietary", "commercial"),
             rf"proprietary {_LICENSE}|commercial {_LICENSE}"),
        Rule(3, "eula", ("end user",), rf"end user {_LICENSE} agreement"),
        Rule(4, "copyright", ("copyright",), r"copyright (?:c )?(?:19|20)\d\d"),
        Rule(4, "unknown-license", ("licensed",), r"licensed (?:under|for|to)"),
        Rule(4, "unknown-license", ("license", "licenses", "licence", "licences"), rf"{_LICENSE}s?"),
    ]
    return rules + [Rule(2, label, (phrase,), phrase, True) for phrase, label in BASE_PHRASES]


RULES = build_rules()
#: All keywords, in the order in which the gate tries them: a longer one before its own beginning.
KEYWORDS = sorted({k for r in RULES for k in r.keywords} | set(ANCHORS), key=lambda k: (-len(k), k))


def _gate() -> str:
    """One pattern for all keywords, tried by first letter at every space; a version may be joined."""
    by_letter: dict[str, list[str]] = {}
    for k in KEYWORDS:
        by_letter.setdefault(k[0], []).append(k[1:])
    words = "|".join(rf"{c}(?:{'|'.join(rest)})" for c, rest in sorted(by_letter.items()))
    return rf" (?=[{''.join(sorted(by_letter))}])(?=({words})[ v0-9])"


def _bounded(pattern: str) -> str:
    return rf"(?<![^ ])(?:{pattern})(?![^ ])"


def _constant(value, schema: str) -> Column:
    """A table of constants as one expression, which Catalyst folds to a literal; as thousands of
    literals it took the analyzer 20 s."""
    return F.from_json(F.lit(json.dumps(value)), schema)


def _rule_array() -> Column:
    return _constant(
        [{"id": i, "tier": r.tier, "label": r.label, "pattern": _bounded(r.pattern), "base": r.base}
         for i, r in enumerate(RULES)],
        "array<struct<id int, tier int, label string, pattern string, base boolean>>")


def _rules_by_keyword() -> Column:
    """Keyword the gate found -> ids of the rules that may match: ``free`` and ``anchored`` ones.

    The gate finds the longest keyword at a word; rules of one that begins it come along.
    """
    table = {}
    for k in KEYWORDS:
        ids = [i for i, r in enumerate(RULES) if any(f"{k} ".startswith(f"{own} ") for own in r.keywords)]
        table[k] = {"free": [i for i in ids if not RULES[i].anchored],
                    "anchored": [i for i in ids if RULES[i].anchored]}
    return _constant(table, "map<string, struct<free array<int>, anchored array<int>>>")


def _matches(n: Column, r: Column) -> Column:
    """Detections of one rule: matches are marked and the marks found among the words."""
    marked = F.split(F.regexp_replace(n, r["pattern"], F.lit("\u0001$0\u0002")), " ")
    at = lambda mark: F.filter(
        F.transform(marked, lambda w, i: F.when(F.contains(w, F.lit(mark)), i)),
        lambda i: i.isNotNull())
    pairs = F.arrays_zip(at("\u0001").alias("a"), at("\u0002").alias("b"))
    return F.transform(pairs, lambda p: F.struct(
        p["a"].alias("first"), (-p["b"]).alias("neg_last"), r["tier"].alias("tier"),
        r["id"].alias("id"), r["label"].alias("label"), r["base"].alias("base")))


def detections(n: Column) -> Column:
    """Sorted detections of a normalised text; bind ``n`` first, it is used often."""
    hits = F.array_distinct(F.regexp_extract_all(
        F.concat(F.lit(" "), n, F.lit(" ")), F.lit(_gate()), F.lit(1)))

    def of_hits(found):
        anchored = F.exists(found, lambda h: h.isin(*ANCHORS))
        ids = F.array_distinct(F.flatten(F.transform(found, lambda h: _let(
            F.element_at(_rules_by_keyword(), h),
            lambda r: F.when(anchored, F.concat(r["free"], r["anchored"])).otherwise(r["free"])))))
        return F.array_sort(F.flatten(F.transform(
            ids, lambda i: _let(F.element_at(_rule_array(), i + 1), lambda r: _matches(n, r)))))

    return _let(hits, of_hits)


def _kept(dets: Column) -> Column:
    """Fold over sorted detections: ``labels`` (distinct) and ``n`` kept, best tier."""
    ends = [f"e{t}" for t in TIERS]
    start = F.struct(*[F.lit(-1).alias(e) for e in ends],
                     F.array().cast("array<string>").alias("labels"),
                     F.lit(0).cast("long").alias("n"), F.lit(len(TIERS)).alias("best"))

    def step(acc, d):
        last = -d["neg_last"]
        covered = F.lit(False)
        for t, e in zip(TIERS, ends, strict=True):
            covered = covered | ((d["tier"] >= t) & (acc[e] >= last))
        new_ends = [F.when(d["tier"] == t, F.greatest(acc[e], last)).otherwise(acc[e]).alias(e)
                    for t, e in zip(TIERS, ends, strict=True)]
        return F.struct(
            *new_ends,
            F.when(covered, acc["labels"]).otherwise(
                F.array_union(acc["labels"], F.array(d["label"]))).alias("labels"),
            (acc["n"] + F.when(covered, 0).otherwise(1)).cast("long").alias("n"),
            F.when(covered, acc["best"]).otherwise(F.least(acc["best"], d["tier"])).alias("best"))

    return F.aggregate(dets, start, step)


def normalised(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.trim(F.regexp_replace(lowered, F.lit(NON_WORD), F.lit(" ")))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_kept,
    detections`` (label, first, last of every match, suppressed ones included)."""

    def of_text(n):
        words = F.when(n == "", F.lit(0)).otherwise(
            F.length(n) - F.length(F.replace(n, F.lit(" "), F.lit(""))) + 1)
        return F.struct(words.cast("long").alias("n_words"), detections(n).alias("dets"))

    def of_dets(x):
        base = F.filter(x["dets"], lambda d: d["base"])
        kept = _kept(x["dets"])
        return F.struct(
            x["n_words"].alias("n_words"), x["dets"].alias("dets"), kept.alias("kept"),
            F.transform(base, lambda d: d["first"]).alias("at"),
            F.array_sort(F.array_distinct(F.transform(base, lambda d: d["label"]))).alias("names"))

    row = docs.select("doc_id", _let(_let(normalised(F.col("text")), of_text), of_dets).alias("x"))
    score = F.lit(0.0)
    for t, c in TIERS.items():
        score = F.when(F.col("x.kept.best") == t, F.lit(c)).otherwise(score)
    return row.select(
        "doc_id", F.col("x.n_words").alias("n_words"),
        F.size("x.at").cast("long").alias("n_base"),
        F.array_min("x.at").cast("long").alias("first_word"),
        F.array_max("x.at").cast("long").alias("last_word"),
        F.array_join("x.names", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("x.kept.labels", "x.names")), ",").alias("labels"),
        score.alias("score"), F.col("x.kept.n").alias("n_kept"),
        F.transform("x.dets", lambda d: F.struct(
            d["label"].alias("label"), d["first"].alias("first"),
            (-d["neg_last"]).alias("last"))).alias("detections"))


def op2_license_rules(spark, sf_dir):
    return scan(read(spark, sf_dir, "documents")).drop("detections")


QUERIES = {"op2_license_rules": op2_license_rules}
ORACLE_SQL: dict[str, str] = {}  # suppression is checked by brute force in tests/llm
