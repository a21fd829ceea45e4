"""License scan by ordered signature rules (native: DataFrame functions only).

A text is lower-cased and reduced to its words (runs of
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``) joined by one space. Three base
phrases are counted and located in every text. Texts that hold a gate word
are then held against the signature rules: each rule has words of which one
stands in each of its matches, looked for before its regular expression is
tried, and a priority. A detection that lies within one of higher priority, or within a longer one of
the same priority, is suppressed; base labels are never suppressed.

All of it is one projection over the rows, without a shuffle, so a hot key or
a group of copies costs no more than its rows. Only texts with a gate word
meet the rules.

Defined results: a null or empty text has no words and no label; ties between
equal detections keep both labels; repeated rows are scanned one by one; an
empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.places import let, places

#: The phrases of the base labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int  # 1 lowest, 3 highest
    pattern: str
    gate: tuple[str, ...]  # one of them stands in any match of the pattern
    keywords: tuple[str, ...] = ()  # of these too, if there are any
    beside: str = ""  # must stand in the text besides


#: label: (words of which any form of the name holds one, the license's name as it stands in words, SPDX id as it stands in words)
NAMES = {
    "mit": (("mit", "expat"), r"(?:mit|expat)(?: x11)?", r"mit"),
    "mit-0": (("mit",), r"mit (?:no attribution|0)", r"mit 0"),
    "apache-1.1": (("apache",), r"apache(?: software)? license v(?:ersion )?1 1", r"apache 1 1"),
    "apache-2": (("apache",), r"apache(?: software)?(?: license)?(?: v| version| v ersion)? ?2(?: 0)?", r"apache 2 0"),
    "bsd-2-clause": (("bsd",), r"(?:simplified|freebsd|(?:2|two) clause) bsd|bsd (?:2|two) clause", r"bsd 2 clause"),
    "bsd-3-clause": (("bsd",), r"(?:new|modified|revised|(?:3|three) clause) bsd|bsd (?:3|three) clause", r"bsd 3 clause"),
    "bsd-4-clause": (("bsd",), r"(?:original|old|(?:4|four) clause) bsd|bsd (?:4|four) clause", r"bsd 4 clause"),
    "0bsd": (("bsd",), r"zero clause bsd|bsd (?:0|zero) clause|0bsd", r"0bsd"),
    "gpl-1": (("gpl", "general public"), r"(?:gnu )?(?:gpl|general public license)(?: v| version)? ?1(?: 0)?", r"gpl 1 0(?: only| or later)?"),
    "gpl-2": (("gpl", "general public"), r"(?:gnu )?(?:gpl|general public license)(?: v| version)? ?2(?: 0)?", r"gpl 2 0(?: only| or later)?"),
    "gpl-3": (("gpl", "general public"), r"(?:gnu )?(?:gpl|general public license)(?: v| version)? ?3(?: 0)?", r"gpl 3 0(?: only| or later)?"),
    "lgpl-2": (("lgpl", "library general"), r"(?:gnu )?(?:lgpl|library general public license)(?: v| version)? ?2(?: 0)?", r"lgpl 2 0(?: only| or later)?"),
    "lgpl-2.1": (("lgpl", "lesser general"), r"(?:gnu )?(?:lgpl|lesser general public license)(?: v| version)? ?2 1", r"lgpl 2 1(?: only| or later)?"),
    "lgpl-3": (("lgpl", "lesser general"), r"(?:gnu )?(?:lgpl|lesser general public license)(?: v| version)? ?3(?: 0)?", r"lgpl 3 0(?: only| or later)?"),
    "agpl-3": (("agpl", "affero"), r"(?:gnu )?(?:agpl|affero general public license)(?: v| version)? ?3(?: 0)?", r"agpl 3 0(?: only| or later)?"),
    "mpl-1.1": (("mpl", "mozilla"), r"(?:mozilla public license|mpl)(?: v| version)? ?1 1", r"mpl 1 1"),
    "mpl-2": (("mpl", "mozilla"), r"(?:mozilla public license|mpl)(?: v| version)? ?2(?: 0)?", r"mpl 2 0"),
    "epl-1": (("epl", "eclipse"), r"(?:eclipse public license|epl)(?: v| version)? ?1(?: 0)?", r"epl 1 0"),
    "epl-2": (("epl", "eclipse"), r"(?:eclipse public license|epl)(?: v| version)? ?2(?: 0)?", r"epl 2 0"),
    "cddl-1": (("cddl", "common development"), r"(?:common development and distribution license|cddl)(?: v| version)? ?1(?: 0)?", r"cddl 1 0"),
    "cddl-1.1": (("cddl", "common development"), r"(?:common development and distribution license|cddl)(?: v| version)? ?1 1", r"cddl 1 1"),
    "cpl-1": (("common public",), r"common public license(?: v| version)? ?1(?: 0)?", r"cpl 1 0"),
    "eupl-1.1": (("eupl", "european union"), r"(?:european union public licen[cs]e|eupl)(?: v| version)? ?1 1", r"eupl 1 1"),
    "eupl-1.2": (("eupl", "european union"), r"(?:european union public licen[cs]e|eupl)(?: v| version)? ?1 2", r"eupl 1 2"),
    "isc": (("isc",), r"isc", r"isc"),
    "zlib": (("zlib",), r"zlib(?: libpng)?", r"zlib"),
    "bsl-1": (("boost",), r"boost(?: software)?(?: license)?(?: v| version)? ?1(?: 0)?", r"bsl 1 0"),
    "busl-1.1": (("business source",), r"business source license(?: v| version)? ?1 1", r"busl 1 1"),
    "unlicense": (("unlicense",), r"unlicense", r"unlicense"),
    "wtfpl": (("wtfpl",), r"wtfpl", r"wtfpl"),
    "artistic-1": (("artistic",), r"artistic license(?: v| version)? ?1(?: 0)?", r"artistic 1 0"),
    "artistic-2": (("artistic",), r"artistic license(?: v| version)? ?2(?: 0)?", r"artistic 2 0"),
    "ofl-1.1": (("font",), r"(?:sil )?open font license(?: v| version)? ?1 1", r"ofl 1 1"),
    "psf-2": (("python",), r"python(?: software foundation)? license(?: v| version)? ?2?", r"(?:psf|python) 2 0"),
    "postgresql": (("postgresql",), r"postgresql", r"postgresql"),
    "php-3": (("php",), r"php license(?: v| version)? ?3(?: 0| 01)?", r"php 3 0?1?"),
    "ruby": (("ruby",), r"ruby", r"ruby"),
    "openssl": (("openssl",), r"openssl", r"openssl"),
    "x11": (("x11",), r"x11", r"x11"),
    "ncsa": (("ncsa",), r"(?:university of illinois )?ncsa(?: open source)?", r"ncsa"),
    "ms-pl": (("microsoft",), r"microsoft public license", r"ms pl"),
    "ms-rl": (("microsoft",), r"microsoft reciprocal license", r"ms rl"),
    "osl-3": (("open software",), r"open software license(?: v| version)? ?3(?: 0)?", r"osl 3 0"),
    "afl-3": (("academic free",), r"academic free license(?: v| version)? ?3(?: 0)?", r"afl 3 0"),
    "upl-1": (("universal permissive",), r"universal permissive license(?: v| version)? ?1?(?: 0)?", r"upl 1 0"),
    "mulan-psl-2": (("mulan",), r"mulan(?: permissive software license|psl)(?: v| version)? ?2", r"mulanpsl 2 0"),
    "sspl-1": (("server side public",), r"server side public license(?: v| version)? ?1?", r"sspl 1 0"),
    "elastic-2": (("elastic",), r"elastic license(?: v| version)? ?2(?: 0)?", r"elastic 2 0"),
    "gfdl-1.2": (("documentation",), r"(?:gnu )?free documentation license(?: v| version)? ?1 2", r"gfdl 1 2(?: only| or later)?"),
    "gfdl-1.3": (("documentation",), r"(?:gnu )?free documentation license(?: v| version)? ?1 3", r"gfdl 1 3(?: only| or later)?"),
    "odbl-1": (("database",), r"open (?:data commons open )?database license(?: v| version)? ?1?(?: 0)?", r"odbl 1 0"),
    "odc-by-1": (("open data commons",), r"open data commons attribution license(?: v| version)? ?1?(?: 0)?", r"odc by 1 0"),
    "pddl-1": (("public domain dedication",), r"(?:open data commons )?public domain dedication and license", r"pddl 1 0"),
    "cc0-1": (("cc0",), r"(?:creative commons )?cc0(?: v| version)? ?1?(?: 0)?", r"cc0 1 0"),
    "cc-by": (("commons attribution", "commons by", "cc attribution", "cc by"), r"(?:creative commons|cc) (?:attribution|by)(?: [1-4] [0-9])?", r"cc by [1-4] [0-9]"),
    "cc-by-sa": (("by sa",), r"cc by sa(?: [1-4] [0-9])?", r"cc by sa [1-4] [0-9]"),
    "cc-by-nd": (("by nd",), r"cc by nd(?: [1-4] [0-9])?", r"cc by nd [1-4] [0-9]"),
    "cc-by-nc-sa": (("nc sa",), r"cc by nc sa(?: [1-4] [0-9])?", r"cc by nc sa [1-4] [0-9]"),
    "cc-by-nc-nd": (("nc nd",), r"cc by nc nd(?: [1-4] [0-9])?", r"cc by nc nd [1-4] [0-9]"),
    "cc-by-nc-4": (("by nc",), r"cc by nc 4 0", r"cc by nc 4 0"),
}

#: Forms in which a license is named: (priority, words of which any match holds one, pattern around the name or the id).
FORMS = (
    (3, ("spdx license identifier",), r"spdx license identifier {id}"),
    (
        3,
        ("licensed under", "licenced under", "released under", "distributed under", "available under", "published under", "covered under"),
        r"(?:licen[cs]ed|released|distributed|available|published|covered) under (?:the )?(?:terms of )?(?:the )?{name}(?: licen[cs]e)?",
    ),
    (
        2,
        ("subject to the", "terms of the", "conditions of the", "governed by the"),
        r"(?:subject to|terms of|conditions of|governed by) the {name}(?: licen[cs]e)?",
    ),
    (2, ("license", "licence"), r"licen[cs]e(?:s)?(?: is| are)? {name}"),
    (1, ("license", "licence"), r"{name} licen[cs]e"),
)

#: Signatures that name no license by itself, and texts of licenses.
TEXTS = (
    Rule("gpl", 1, r"gnu general public licen[cs]e", ("general public",)),
    Rule("lgpl", 1, r"gnu lesser general public licen[cs]e", ("lesser general public",)),
    Rule("agpl", 1, r"gnu affero general public licen[cs]e", ("affero general public",)),
    Rule("gpl-3", 3, r"gnu general public licen[cs]e (?:as published by the free software foundation )?(?:either )?version 3", ("general public",)),
    Rule("gpl-2", 3, r"gnu general public licen[cs]e (?:as published by the free software foundation )?(?:either )?version 2", ("general public",)),
    Rule("or-later", 1, r"or at your option any later version", ("any later version",)),
    Rule("mit", 3, r"permission is hereby granted free of charge to any person obtaining a copy of this software", ("hereby granted",)),
    Rule("isc", 3, r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use",)),
    Rule("bsd", 2, r"redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use",)),
    Rule("bsd-3-clause", 3, r"may be used to endorse or promote products derived from this software", ("endorse or promote",)),
    # the sentence alone is also that of other licenses
    Rule("apache-2", 3, r"you may not use this file except in compliance with the license", ("compliance with the license",), beside="apache"),
    Rule("zlib", 3, r"this software is provided as is without any express or implied warranty in no event", ("provided as is",)),
    Rule("unlicense", 3, r"free and unencumbered software released into the public domain", ("public domain",)),
    Rule("public-domain", 2, r"(?:released|placed|dedicated) (?:in|into|to) the public domain", ("public domain",)),
    Rule("public-domain", 1, r"in the public domain", ("public domain",)),
    Rule("wtfpl", 3, r"do what the f\S+ you want to public license", ("do what the",)),
    Rule("cc-by-sa", 2, r"creative commons attribution share ?alike(?: [1-4] [0-9])?", ("creative commons",)),
    Rule("cc-by-nc-sa", 3, r"creative commons attribution non ?commercial share ?alike(?: [1-4] [0-9])?", ("creative commons",)),
    Rule("cc-by-nc-nd", 3, r"creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: [1-4] [0-9])?", ("creative commons",)),
    Rule("cc-by-nd", 2, r"creative commons attribution no ?deriv(?:ative)?s?(?: [1-4] [0-9])?", ("creative commons",)),
    Rule("cc-by-nc", 2, r"creative commons attribution non ?commercial(?: [1-4] [0-9])?", ("creative commons",)),
    Rule("cc-by-nc", 2, r"cc by nc(?: [1-4] [0-9])?", ("cc by",)),
    Rule("cc-by", 2, r"licen[cs]ed under (?:a )?cc by(?: [1-4] [0-9])?", ("cc by",)),
    Rule("cc0-1", 2, r"no rights reserved", ("rights reserved",)),
    Rule("creative-commons", 1, r"creative commons", ("creative commons",)),
    Rule("proprietary", 2, r"all rights reserved", ("rights reserved",)),
    Rule("proprietary", 2, r"proprietary and confidential", ("proprietary and",)),
    Rule("proprietary", 2, r"without (?:the )?(?:prior )?(?:express )?written permission", ("written permission",)),
    Rule("copyright", 1, r"copyright (?:c )?(?:19|20)[0-9]{2}", ("copyright",)),
    Rule("copyleft", 1, r"copyleft", ("copyleft",)),
    Rule("warranty-disclaimer", 1, r"without warranty of any kind|without any warranty", ("warranty",)),
    Rule("spdx", 1, r"spdx license identifier \S+", ("spdx license identifier",)),
    Rule("unknown-license", 1, r"licen[cs]ed under", ("licensed under", "licenced under")),
    Rule("unknown-license", 1, r"released under the \S+ licen[cs]e", ("released under",)),
    Rule("non-commercial", 1, r"(?:for )?non ?commercial (?:use|purposes) only", ("commercial use only", "commercial purposes only")),
    Rule("free-for-use", 1, r"free for (?:personal|academic|educational|research) use", ("free for",)),
)


def rules() -> list[Rule]:
    """All rules: each name in each form, then the signatures that stand alone."""
    named = [
        Rule(label, priority, form.format(name=f"(?:{name})", id=f"(?:{spdx})"), words, names if "{name}" in form else ())
        for label, (names, name, spdx) in NAMES.items()
        for priority, words, form in FORMS
    ]
    return named + list(TEXTS)


def gate() -> list[str]:
    """Words of which one stands in any text that a base phrase or some rule can match, without those that hold another."""
    words = sorted({*BASE, *(w for r in rules() for w in r.gate)})
    return [w for w in words if not any(v != w and v in w for v in words)]


def word_text(text: Column) -> Column:
    """The words of a text between single spaces.

    Only A-Z count as capitals; ``lower`` also changes other letters, which
    keeps them in the same class and never makes a base phrase or rule match.
    """
    return F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS, " "), F.lit(" "))


def _spaces(stretch: Column) -> Column:
    return F.length(stretch) - F.length(F.replace(stretch, F.lit(" "), F.lit("")))


def _words(words: tuple[str, ...]) -> Column:
    return F.array(*map(F.lit, words)) if words else F.array().cast("array<string>")


def _rule_table() -> Column:
    """The rules in groups of equal gate words."""
    groups: dict[tuple[str, ...], list[Rule]] = {}
    for r in rules():
        groups.setdefault(r.gate, []).append(r)
    return F.array(
        *[
            F.struct(
                _words(words).alias("gate"),
                F.array(
                    *[
                        F.struct(
                            F.lit(r.label).alias("label"),
                            F.lit(r.priority).alias("priority"),
                            _words(r.keywords).alias("keywords"),
                            F.lit(r.beside).alias("beside"),
                            F.lit(f" (?:{r.pattern})(?= )").alias("pattern"),
                        )
                        for r in group
                    ]
                ).alias("rules"),
            )
            for words, group in groups.items()
        ]
    )


def _base_starts(padded: Column, phrase: str) -> Column:
    """Word numbers at which a base phrase starts; ``padded`` has a space at both ends."""
    found = places(padded, F.lit(f" {phrase}(?= )"), _spaces)
    return F.when(F.contains(padded, F.lit(f" {phrase} ")), F.transform(found, lambda p: p["start"])).otherwise(
        F.array().cast("array<int>")
    )


def _detections(padded: Column) -> Column:
    """Detections of all rules whose words the text holds, in order of place, the widest first."""

    def held(words: Column) -> Column:
        return F.exists(words, lambda w: F.contains(padded, w))

    tried = F.flatten(
        F.transform(
            F.filter(_rule_table(), lambda g: held(g["gate"])),
            lambda g: F.filter(
                g["rules"],
                lambda r: ((F.size(r["keywords"]) == 0) | held(r["keywords"])) & F.contains(padded, r["beside"]),
            ),
        )
    )
    found = F.flatten(
        F.transform(
            tried,
            lambda r: F.transform(
                places(padded, r["pattern"], _spaces),
                lambda p: F.struct(
                    p["start"].alias("start"),
                    (-p["end"]).alias("minus_end"),
                    (-r["priority"]).alias("minus_priority"),
                    r["label"].alias("label"),
                ),
            ),
        )
    )
    return F.array_sort(found)


def _survivors(detections: Column) -> Column:
    """Labels and the highest priority that remain after suppression.

    Detections come by start, the widest first, so one that has been passed
    contains the present one if it ends no earlier. ``ends`` is the furthest
    end so far by priority (1, 2, 3); one of the same priority must be longer.
    """
    start = F.struct(
        F.array(F.lit(-1), F.lit(-1), F.lit(-1)).alias("ends"),
        F.struct(F.lit(-1).alias("start"), F.lit(-1).alias("end"), F.lit(0).alias("priority")).alias("last"),
        F.array().cast("array<string>").alias("labels"),
        F.lit(0).alias("best"),
    )

    def step(acc: Column, d: Column) -> Column:
        end, priority = -d["minus_end"], -d["minus_priority"]
        same = (acc["last"]["start"] == d["start"]) & (acc["last"]["end"] == end) & (acc["last"]["priority"] == priority)
        higher = F.exists(
            F.transform(acc["ends"], lambda e, k: (k + 1 > priority) & (e >= end)), lambda x: x
        )
        longer = (F.element_at(acc["ends"], priority) >= end) & ~same
        gone = higher | longer
        return F.struct(
            F.transform(
                acc["ends"], lambda e, k: F.when(k + 1 == priority, F.greatest(e, end)).otherwise(e)
            ).alias("ends"),
            F.struct(d["start"].alias("start"), end.alias("end"), priority.alias("priority")).alias("last"),
            F.when(gone, acc["labels"]).otherwise(F.array_union(acc["labels"], F.array(d["label"]))).alias("labels"),
            F.when(gone, acc["best"]).otherwise(F.greatest(acc["best"], priority)).alias("best"),
        )

    return F.aggregate(detections, start, step)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: word count, base places and labels, all labels, score.

    ``score`` is 1 with a base label; else 0.9, 0.6 or 0.3 by the highest
    priority of the detections that remain, and 0 without any.
    """
    maybe = F.lit(False)
    for word in gate():
        maybe = maybe | F.contains(F.col("words"), F.lit(word))
    starts = [_base_starts(F.col("padded"), phrase) for phrase in BASE]
    nothing = F.array().cast("array<struct<start:int,minus_end:int,minus_priority:int,label:string>>")
    counted = (
        docs.select("doc_id", word_text(F.col("text")).alias("words"))
        .withColumn("n_words", F.when(F.col("words") == "", 0).otherwise(_spaces(F.col("words")) + 1).cast("long"))
        .withColumn("maybe", maybe)
        .withColumn("padded", F.when(F.col("maybe"), F.concat(F.lit(" "), "words", F.lit(" "))))
    )
    located = counted.select(
        "doc_id",
        "n_words",
        *[
            F.when(F.col("maybe"), s).otherwise(F.array().cast("array<int>")).alias(f"base_{k}")
            for k, s in enumerate(starts)
        ],
        F.when(F.col("maybe"), _survivors(_detections(F.col("padded")))).alias("method"),
    )
    every = F.concat(*[F.col(f"base_{k}") for k in range(len(BASE))])
    base_labels = F.filter(
        F.array(*[F.when(F.size(f"base_{k}") > 0, F.lit(label)) for k, label in enumerate(BASE.values())]),
        lambda x: x.isNotNull(),
    )
    base_labels = F.array_sort(F.array_distinct(base_labels))
    method = F.coalesce(F.col("method.labels"), F.array().cast("array<string>"))
    return located.withColumn("starts", every).withColumn("base", base_labels).select(
        "doc_id",
        "n_words",
        F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"),
        F.array_max("starts").cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", method)), ",").alias("labels"),
        F.when(F.size("base") > 0, 1.0)
        .otherwise(F.element_at(F.array(F.lit(0.0), F.lit(0.3), F.lit(0.6), F.lit(0.9)), F.coalesce("method.best", F.lit(0)) + 1))
        .alias("score"),
    )
