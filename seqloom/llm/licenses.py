"""License scan by ordered signature rules.

The rules are regular expressions over the lower-cased text: signatures written one by one (clauses, notices,
names, addresses), and families of names in sentence forms. A keyword automaton gates them: only the
rules of which a keyword occurs in a document are run on it (each alternative holds one). Hits are resolved by priority:
a hit whose interval lies inside that of a rule with the same or higher priority is
suppressed (full sentences over bare names, versioned names over plain ones).

Base phrases (three, by consecutive words) are always kept. Words are counted from 0 in
the lower-cased text.

Defined cases: null or empty text: no words, no labels, score 0; repeated rows repeat;
an empty table gives an empty result; extra columns are ignored; of equal rules the longer hit goes first, then the earlier one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import common

#: Base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Label, keywords of which one must occur, and pattern of the licence's names (spaces match any gap between words).
FAMILIES = [
    ("mit", "mit|expat", "mit|expat|x11 mit"),
    ("apache-2", "apache|asl", "apache(?: software)?(?: license)?(?: version| v)? ?2(?: 0)?|asl ?2(?: 0)?"),
    ("apache-1", "apache", "apache(?: software)?(?: license)?(?: version| v)? ?1(?: [01])?"),
    ("gpl-3", "general public", "(?<!lesser )(?<!affero )(?<!library )(?:gnu )?general public license(?: version| v)? ?3(?: 0)?"),
    ("gpl-2", "general public", "(?<!lesser )(?<!affero )(?<!library )(?:gnu )?general public license(?: version| v)? ?2(?: 0)?"),
    ("gpl", "general public", "(?<!lesser )(?<!affero )(?<!library )(?:gnu )?general public license"),
    ("gpl-3", "gpl", "(?:gnu )?gpl ?v?3(?: 0)?(?: only| or later)?"),
    ("gpl-2", "gpl", "(?:gnu )?gpl ?v?2(?: 0)?(?: only| or later)?"),
    ("lgpl-3", "lesser", "(?:gnu )?lesser general public license(?: version| v)? ?3(?: 0)?"),
    ("lgpl-2", "lesser", "(?:gnu )?lesser general public license(?: version| v)? ?2(?: [01])?"),
    ("lgpl", "lesser", "(?:gnu )?lesser general public license"),
    ("lgpl-3", "lgpl", "lgpl ?v?3(?: 0)?"),
    ("lgpl-2", "lgpl", "lgpl ?v?2(?: [01])?"),
    ("agpl-3", "affero", "(?:gnu )?affero general public license(?: version| v)?(?: 3(?: 0)?)?"),
    ("agpl-3", "agpl", "agpl ?v?3(?: 0)?"),
    ("bsd-3", "bsd", "(?:3|three) clause bsd|bsd ?(?:3|three) clause|(?:new|modified|revised) bsd"),
    ("bsd-2", "bsd", "(?:2|two) clause bsd|bsd ?(?:2|two) clause|simplified bsd|freebsd"),
    ("bsd-4", "bsd", "(?:4|four) clause bsd|bsd ?(?:4|four) clause|original bsd"),
    ("0bsd", "0bsd|zero clause", "0bsd|zero clause bsd"),
    ("isc", "isc", "isc"),
    ("mpl-2", "mozilla", "mozilla public license(?: version| v)? ?2(?: 0)?"),
    ("mpl-1", "mozilla", "mozilla public license(?: version| v)? ?1(?: [01])?"),
    ("mpl-2", "mpl", "mpl ?v?2(?: 0)?"),
    ("epl-2", "eclipse", "eclipse public license(?: version| v)? ?2(?: 0)?"),
    ("epl-1", "eclipse", "eclipse public license(?: version| v)? ?1(?: 0)?"),
    ("cc0", "cc0", "cc0(?: 1 0)?(?: universal)?"),
    ("cc-by-nc-nd", "cc by", "cc by nc nd(?: [1-4] [0-9])?"),
    ("cc-by-nc-sa", "cc by", "cc by nc sa(?: [1-4] [0-9])?"),
    ("cc-by-nc", "cc by", "cc by nc(?: [1-4] [0-9])?"),
    ("cc-by-nd", "cc by", "cc by nd(?: [1-4] [0-9])?"),
    ("cc-by-sa", "cc by", "cc by sa(?: [1-4] [0-9])?"),
    ("cc-by", "cc by", "cc by(?: [1-4] [0-9])?"),
    ("cc-by-nc-sa", "creative", "creative commons attribution non ?commercial share ?alike"),
    ("cc-by-nc-nd", "creative", "creative commons attribution non ?commercial no ?deriv(?:ative)?s?"),
    ("cc-by-nc", "creative", "creative commons attribution non ?commercial"),
    ("cc-by-sa", "creative", "creative commons attribution share ?alike"),
    ("cc-by-nd", "creative", "creative commons attribution no ?deriv(?:ative)?s?"),
    ("cc-by", "creative", "creative commons attribution"),
    ("unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("zlib", "zlib", "zlib(?: libpng)?"),
    ("bsl-1", "boost", "boost software(?: license)?(?: version| v)?(?: 1(?: 0)?)?"),
    ("artistic-2", "artistic", "artistic(?: license)?(?: version| v)? ?2(?: 0)?"),
    ("artistic-1", "artistic", "artistic(?: license)?(?: version| v)? ?1(?: 0)?"),
    ("ofl-1", "open font", "sil open font(?: license)?(?: version| v)?(?: 1(?: [01])?)?"),
    ("odbl", "open database", "open database(?: license)?(?: version| v)?(?: 1(?: 0)?)?"),
    ("eupl", "european union", "european union public licen[cs]e(?: version| v)?(?: 1(?: [012])?)?"),
    ("cddl", "cddl", "cddl(?: 1 [01])?"),
    ("postgresql", "postgresql", "postgresql"),
    ("python-2", "python|psf", "(?:python software foundation|psf)(?: license)?(?: version| v)?(?: 2(?: 0)?)?"),
]
#: Sentence forms, best first; {} is the name, {named} the name with "license" in or after it. A family and a form make one rule.
FORMS = [
    (r"spdx license identifier {}", 0.99),
    (r"(?:this (?:work|file|software|program|document|text|code|project|package) )?(?:is |are )?(?:licensed|released|distributed|published|provided|available|redistributed) (?:under|subject to) (?:the )?(?:terms of )?(?:the )?{}(?: licen[cs]e)?", 0.95),
    (r"(?:under|subject to) (?:the )?(?:terms|conditions)(?: and conditions)? of (?:the )?{}(?: licen[cs]e)?", 0.9),
    (r"under (?:the |a )?{named}", 0.9),
    (r"licen[cs]e (?:is )?{}", 0.7),
    (r"(?:the )?{named}", 0.6),
]
#: Signatures written one by one, best first: label, pattern. Their keywords are the longest texts that each alternative can't do without.
SIGNATURES = r"""
# permission grants
mit|permission is hereby granted free of charge to any person obtaining a copy
mit|to deal in the software without restriction including without limitation the rights
mit|the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit|warranties of merchantability fitness for a particular purpose and noninfringement
x11|except as contained in this notice the name of the x consortium shall not be used
mit-0|mit no attribution(?: license)?
isc|permission to use copy modify and or distribute this software for any purpose
isc|the author disclaims all warranties with regard to this software including all implied warranties
hpnd|permission to use copy modify and distribute this software and its documentation for any purpose (?:and )?without fee
hpnd|historical permission notice and disclaimer
ncsa|(?:university of illinois )?ncsa open source license
curl|curl license
fair|usage of the works is permitted provided that this instrument is retained|fair license
# redistribution clauses
bsd|redistribution and use in source and binary forms with or without modification are permitted
bsd|redistributions of source code must retain the above copyright notice
bsd|redistributions in binary form must reproduce the above copyright notice
bsd-3|may be used to endorse or promote products derived from this software
bsd-4|all advertising materials mentioning features or use of this software must display
bsd-3|neither the name of the (?:university|regents) nor the names of its contributors
bsd-1|(?:1|one) clause bsd license|bsd 1 clause license
bsd-patent|bsd 2 clause plus patent license
bsd-clear|bsd 3 clause clear license
# apache
apache-2|you may not use this file except in compliance with the license
apache-2|apache org licenses license 2 0
apache-2|distributed on an as is basis without warranties or conditions of any kind
apache-2|grant of patent license subject to the terms and conditions of this license
apache-1|this product includes software developed by the apache group
apache-2|licensed to the apache software foundation asf under one or more contributor license agreements
# gnu
gpl|you can redistribute it and or modify it under the terms of the gnu general public license
lgpl|you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license
agpl-3|you can redistribute it and or modify it under the terms of the gnu affero general public license
gpl-2|general public license as published by the free software foundation either version 2
gpl-3|(?<!lesser )(?<!affero )general public license as published by the free software foundation either version 3
lgpl-2|lesser general public license as published by the free software foundation either version 2
lgpl-3|lesser general public license as published by the free software foundation either version 3
gpl|you should have received a copy of the gnu general public license
lgpl|you should have received a copy of the gnu lesser general public license
agpl-3|you should have received a copy of the gnu affero general public license
agpl-3|users interacting with it remotely through a computer network
gpl-classpath|gnu general public license (?:version )?2 (?:only )?with (?:the )?classpath exception
gpl-font|gpl (?:2|3) 0 with font exception
gcc-exception|gcc runtime library exception(?: 3 1)?
gfdl|gnu free documentation license(?: version)?(?: 1 [123])?
gfdl|gfdl 1 [123](?: or later| only)?
gpl-1|gnu general public license version 1
lgpl-2|gnu library general public license(?: version 2)?
gpl|this (?:work|program|software) is (?:released )?under a copyleft license
# weak copyleft
mpl-2|this source code form is subject to the terms of the mozilla public license v 2 0
mpl-1|mpl 1 [01]
mpl-2|mozilla org mpl 2 0
epl-2|eclipse org legal epl 2 0
epl-1|eclipse org legal epl v10
epl-2|this program and the accompanying materials are made available under the terms of the eclipse public license 2 0
epl-1|this program and the accompanying materials are made available under the terms of the eclipse public license v1 0
cpl|common public license(?: version)?(?: 1 0)?
ipl|ibm public license(?: version)?(?: 1 0)?
cddl|common development and distribution license(?: version)?(?: 1 [01])?
ms-pl|microsoft public license
ms-rl|microsoft reciprocal license
osl-3|open software license(?: version| v)?(?: 3(?: 0)?)?
afl-3|academic free license(?: version| v)?(?: 3(?: 0)?)?
apsl|apple public source license(?: version)?(?: 2 0)?
npl|netscape public license(?: version)?(?: 1 [01])?
qpl|q public license(?: version)?(?: 1 0)?
sleepycat|sleepycat license
eupl|eupl(?: v)? ?1 [012]
cecill|cecill(?: [abc])?(?: v)?(?: ?[12](?: [01])?)?(?: license)?
upl|universal permissive license(?: version| v)?(?: 1(?: 0)?)?
vim|vim license
ruby|ruby license|terms of ruby s license
php|php license(?: version| v)?(?: 3(?: 0| 01)?)?
zpl|zope public license(?: version| v)?(?: 2(?: [01])?)?
w3c|w3c software (?:notice and license|and document license)
tcl|tcl tk license
openssl|openssl license|this product includes software developed by the openssl project
ssleay|this product includes cryptographic software written by eric young
intel|intel open source license
libpng|libpng license(?: version 2)?
ijg|based in part on the work of the independent jpeg group
freetype|freetype (?:project )?license|portions of this software are copyright the freetype project
zlib|the origin of this software must not be misrepresented
zlib|altered source versions must be plainly marked as such
bzip2|bzip2 (?:and libbzip2 )?license
icu|icu license|unicode icu license
unicode|unicode license agreement|unicode terms of use
python-2|python software foundation license agreement
cnri|cnri (?:python )?(?:open source )?license agreement
perl|same terms as (?:the )?perl(?: 5)?(?: programming language system)? itself
artistic-2|artistic license 2 0
artistic-1|clarified artistic license
postgresql|postgresql license|postgresql global development group
bsl-1|boost org license 1 0
bsl-1|boost software license version 1 0
ecl-2|educational community license(?: version)?(?: 2(?: 0)?)?
ofl-1|open font license(?: version)?(?: 1 1)?
ofl-1|with reserved font name
ubuntu-font|ubuntu font licen[cs]e(?: version)?(?: 1 0)?
blueoak|blue oak model license(?: 1 0 0)?
mulan|mulan (?:psl|permissive software license)(?: v)?(?: ?2)?
wtfpl|do what the \w+ you want to public license
beerware|beerware(?: license)?|the beer ware license
unlicense|this is free and unencumbered software released into the public domain
unlicense|unlicense org
0bsd|bsd zero clause license
public-domain|(?:released|placed|dedicated|dedicate\w*) (?:in|into|to) the public domain
public-domain|(?:in|into|to) the public domain|public domain dedication
public-domain|public domain mark(?: 1 0)?
pddl|pddl(?: 1 0)?|open data commons public domain dedication and license
odc-by|odc by(?: 1 0)?|open data commons attribution license
odbl|odbl(?: 1 0)?
cdla-permissive|(?:cdla|community data license agreement) permissive(?: [12] 0)?
cdla-sharing|(?:cdla|community data license agreement) sharing(?: 1 0)?
ogl-uk|open government licen[cs]e(?: version| v)?(?: [123] 0)?
# creative commons
cc0|creativecommons org publicdomain zero 1 0
cc-by|creativecommons org licenses by [1-4] [05]
cc-by-sa|creativecommons org licenses by sa [1-4] [05]
cc-by-nd|creativecommons org licenses by nd [1-4] [05]
cc-by-nc|creativecommons org licenses by nc [1-4] [05]
cc-by-nc-sa|creativecommons org licenses by nc sa [1-4] [05]
cc-by-nc-nd|creativecommons org licenses by nc nd [1-4] [05]
cc0|the person who associated a work with this deed has dedicated the work to the public domain
cc-by|creative commons attribution [1-4] 0 (?:international|generic|unported)(?: public)? license
cc-by-sa|creative commons attribution sharealike [1-4] 0 (?:international|generic|unported)(?: public)? license
cc-by-nc|creative commons attribution noncommercial [1-4] 0 (?:international|generic|unported)(?: public)? license
cc-by|cc by licen[cs]e
cc-by-sa|cc by sa licen[cs]e
copyright-only|some rights reserved
# proprietary and source available
proprietary|all rights reserved
proprietary|proprietary and confidential|confidential and proprietary
proprietary|unauthorized (?:copying|use|reproduction|distribution) (?:of this \w+ )?(?:\w+ )?is (?:strictly )?prohibited
proprietary|end user license agreement
proprietary|(?:contains|constitutes) (?:valuable )?trade secrets?
proprietary|without (?:the )?(?:express )?(?:prior )?written (?:permission|consent) of
proprietary|may not be reproduced (?:or )?(?:distributed|transmitted)
proprietary|for personal(?: and)? non ?commercial use only
busl-1|business source license(?: 1 1)?
sspl-1|server side public license(?: version| v)?(?: 1)?
elastic-2|elastic license(?: 2 0| v2)?
commons-clause|commons clause(?: license)?(?: condition)?
polyform-nc|polyform noncommercial(?: license)?(?: 1 0 0)?
polyform-sb|polyform small business(?: license)?(?: 1 0 0)?
polyform-shield|polyform shield(?: license)?(?: 1 0 0)?
functional-source|functional source license(?: 1 1)?
confluent|confluent community license(?: agreement)?
rsal|redis source available license(?: v2)?
json|the software shall be used for good not evil
hippocratic|hippocratic license(?: [123] [01])?
anti-996|anti 996 license
parity|parity public license(?: 7 0 0)?
prosperity|prosperity public license(?: 3 0 0)?
openrail|(?:bigscience )?(?:creativeml )?open ?rail(?: m)?(?: license)?
llama|llama [234](?: [0-9])? community license agreement
# hardware, documents, other languages
cern-ohl-s|cern ohl s(?: v2)?|cern open hardware licence version 2 strongly reciprocal
cern-ohl-w|cern ohl w(?: v2)?|cern open hardware licence version 2 weakly reciprocal
cern-ohl-p|cern ohl p(?: v2)?|cern open hardware licence version 2 permissive
tapr-ohl|tapr open hardware license
solderpad|solderpad hardware licen[cs]e(?: version| v)?(?: [02] [015]+)?
free-art|free art license(?: 1 3)?|licence art libre
opl|open publication license(?: v)?(?: 1 0)?
ogl-1|open game license(?: version| v)?(?: 1 0a?)?
dsl|design science license
etalab|licence ouverte(?: open licence)?(?: version| v)?(?: [12] 0)?|open licence etalab
dl-de|datenlizenz deutschland (?:namensnennung|zero)(?: version)?(?: 2 0)?
nlod|norwegian licence for open government data
mit|(?:unter der )?mit lizenz
mit|(?:sous )?licence mit
mit|(?:bajo la )?licencia mit
gpl|(?:unter der )?gpl lizenz
gpl|(?:sous )?licence gpl
gpl|(?:bajo la )?licencia gpl
cc-by|licence creative commons attribution
cc-by|(?:unter der )?lizenz cc by
"""
#: Anything that is no word character (digits, lower case, all beyond ASCII) becomes a space; rules match in that form.
GAP = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
PHRASES = [p.encode() for p in BASE]
#: No sentence form can match a text without one of these.
MARKS = ("licen", "under", "subject to")

SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, n_hits long"
ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("n_hits", pa.int64())]
)


def alternatives(name: str) -> list[str]:
    """The outermost alternatives of a pattern."""
    out, depth = [""], 0
    for c in name:
        depth += (c == "(") - (c == ")")
        if c == "|" and not depth:
            out.append("")
        else:
            out[-1] += c
    return out


def named(name: str) -> str:
    """The name with "license" after it, or without when the name itself holds it."""
    holding = [a.replace("(?: license)?", " license") for a in alternatives(name) if "licen" in a]
    return "(?:" + "|".join([f"(?:{name}) licen[cs]e", *holding]) + ")"


def signatures() -> list[tuple[str, str]]:
    return [tuple(line.split("|", 1)) for line in SIGNATURES.splitlines() if line and line[0] != "#"]


def needed(alternative: str) -> str:
    """The longest run of plain characters that every match of an alternative holds."""
    runs = [""]
    for op, value in re._parser.parse(alternative):
        if str(op) == "LITERAL":
            runs[-1] += chr(value)
        else:
            runs.append("")
    return max(runs, key=len)


@lru_cache(maxsize=1)
def rules() -> list[tuple[int, str, str, re.Pattern, float]]:
    """(priority, keywords, label, pattern, weight), highest priority first."""
    out = []
    for form, (template, weight) in enumerate(FORMS):
        for order, (label, keyword, name) in enumerate(FAMILIES):
            out.append((form * 1000 + order, keyword, label, re.compile(r"(?<![^ ])" + template.format(f"(?:{name})", named=named(name)) + r"(?![^ ])"), weight))
    for order, (label, pattern) in enumerate(signatures()):
        keywords = "|".join(needed(x) for x in alternatives(pattern))
        out.append((500 + order, keywords, label, re.compile(rf"(?<![^ ])(?:{pattern})(?![^ ])"), 0.9))
    return sorted(out, key=lambda r: r[0])


@lru_cache(maxsize=2)
def gate(forms: bool) -> ahocorasick.Automaton:
    """Keywords of the sentence forms, or of the signatures."""
    automaton = ahocorasick.Automaton()
    by: dict[str, list[int]] = {}
    for i, rule in enumerate(rules()):
        if forms == (not 500 <= rule[0] < 1000):
            for keyword in rule[1].split("|"):
                by.setdefault(keyword, []).append(i)
    for keyword, at in by.items():
        automaton.add_word(keyword, at)
    automaton.make_automaton()
    return automaton


def opened(line: str) -> list[int]:
    """The rules that a line's keywords open; sentence forms only where one of their marks occurs."""
    found: set[int] = set()
    for forms in (False, True):
        if not forms or any(w in line for w in MARKS):
            for _, at in gate(forms).iter(line):
                found.update(at)
    return sorted(found)


def resolve(hits: list[tuple[int, int, int, str, float]]) -> list[tuple[int, int, int, str, float]]:
    """Drop each hit (priority, start, end, label, weight) that lies within a kept one of at least its priority.

    Among equal priorities longer hits go first, then earlier ones, then labels by name. A Fenwick tree over the starts holds the farthest end of
    the kept hits that begin at or before a place, so the time is in proportion to the hits, but for a logarithm.
    """
    starts = sorted({h[1] for h in hits})
    place = {s: i + 1 for i, s in enumerate(starts)}
    farthest = [-1] * (len(starts) + 1)
    kept: list[tuple[int, int, int, str, float]] = []
    for hit in sorted(hits, key=lambda h: (h[0], h[1] - h[2], h[1], h[3])):
        i, reach = place[hit[1]], -1
        while i:
            reach = max(reach, farthest[i])
            i &= i - 1
        if reach >= hit[2]:
            continue
        kept.append(hit)
        i = place[hit[1]]
        while i < len(farthest):
            farthest[i] = max(farthest[i], hit[2])
            i += i & -i
    return kept


def base_places(words: list[bytes]) -> list[tuple[int, str]]:
    """(first word, label) of every place of a base phrase in a list of words."""
    out = []
    for phrase, label in BASE.items():
        p = phrase.encode().split()
        at = -1
        while True:
            try:
                at = words.index(p[0], at + 1)
            except ValueError:
                break
            if words[at : at + len(p)] == p:
                out.append((at, label))
    return out


def scan_text(text: str) -> dict:
    words = text.encode("utf-8", "surrogatepass").lower().translate(GAP).split()  # lower() of bytes: A-Z only
    line = b" ".join(words)
    base = base_places(words) if any(p in line for p in PHRASES) else []
    hits: list[tuple[int, int, int, str, float]] = []
    line = line.decode("utf-8", "surrogatepass")
    for i in opened(line):
        priority, _, label, pattern, weight = rules()[i]
        hits += [(priority, m.start(), m.end(), label, weight) for m in pattern.finditer(line)]
    hits = resolve(hits)
    base_labels = sorted({x for _, x in base})
    starts = [a for a, _ in base]
    return {
        "n_words": len(words), "n_base": len(base), "first_word": min(starts, default=None), "last_word": max(starts, default=None),
        "base_labels": ",".join(base_labels), "labels": ",".join(sorted({*base_labels, *(h[3] for h in hits)})),
        "score": max([1.0 if base else 0.0, *(h[4] for h in hits)]), "n_hits": len(hits),
    }


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: base phrases by word position, labels of all rules, confidence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.rows(batches):
            found = [scan_text(t) for t in batch.column(1).to_pylist()]
            yield common.batch_of(ARROW, doc_id=batch.column(0), **{f.name: [x[f.name] for x in found] for f in ARROW if f.name != "doc_id"})

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), common.utf8(text).alias("text")).mapInArrow(run, SCHEMA)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(common.table(spark, sf_dir, "documents"))
