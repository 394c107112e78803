"""License scan by ordered signature rules.

Texts are folded to words (A-Z lowered; everything ASCII but letters and digits separates) joined
by one blank, so a rule sees neither punctuation nor layout.  Some hundreds of regular expressions
are built from a table of license names and a table of wordings, and further ones are sentences of
license notices that need not name their license.  Three steps keep the scan cheap:

1. a text without any *root* keyword has no detection (almost every text);
2. a family's rules run only if its own keyword occurs;
3. detections are ordered by (priority, length, start, rule) and one whose word interval lies
   inside the interval of an earlier one is suppressed (``cc by`` inside ``cc by nc``,
   ``mit license`` inside ``licensed under the mit license``).

Base phrases are literal and always counted; their labels are never suppressed.  Of detections with
the same priority and interval, the first rule by name stays.

Very long texts: word numbers come from one index of the blanks, and suppression is one sweep over
the detections with the furthest end of each priority, so the cost grows with the text and its
detections, not with their pairs.

Defined results: NULL and empty texts have no words and no detections; repeated rows are scanned
each on its own; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import per_text, raw, small_batches

#: Phrases and the labels they give.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: (label, name as a regular expression over folded words, keyword that must occur)
FAMILIES = [
    ("mit", r"(?:mit|expat)", "mit"),
    ("x11", r"x11", "x11"),
    ("apache-2", r"apache(?: software)?(?: licen[cs]e)?(?: version| v)? ?2(?: 0)?", "apache"),
    ("apache-1.1", r"apache(?: software)?(?: licen[cs]e)?(?: version| v)? ?1 1", "apache"),
    ("gpl-2", r"(?:gnu )?(?:general public licen[cs]e|gpl)(?: version| v)? ?2(?: 0)?", "g"),
    ("gpl-3", r"(?:gnu )?(?:general public licen[cs]e|gpl)(?: version| v)? ?3(?: 0)?", "g"),
    ("gpl", r"(?:gnu (?:general public licen[cs]e|gpl)|general public licen[cs]e|gpl)", "g"),
    ("lgpl-2.1", r"(?:gnu )?(?:(?:lesser|library) general public licen[cs]e|lgpl)(?: version| v)? ?2(?: 1| 0)?", "l"),
    ("lgpl-3", r"(?:gnu )?(?:lesser general public licen[cs]e|lgpl)(?: version| v)? ?3(?: 0)?", "l"),
    ("agpl-3", r"(?:gnu )?(?:affero general public licen[cs]e|agpl)(?:(?: version| v)? ?3(?: 0)?)?", "a"),
    ("gfdl", r"(?:gnu )?(?:free documentation licen[cs]e|gfdl)(?:(?: version| v)? ?1 [123])?", "f"),
    ("mpl-1.1", r"(?:mozilla public licen[cs]e|mpl)(?: version| v)? ?1 1", "m"),
    ("mpl-2", r"(?:mozilla public licen[cs]e|mpl)(?: version| v)? ?2(?: 0)?", "m"),
    ("epl-1", r"(?:eclipse public licen[cs]e|epl)(?: version| v)? ?1(?: 0)?", "e"),
    ("epl-2", r"(?:eclipse public licen[cs]e|epl)(?: version| v)? ?2(?: 0)?", "e"),
    ("bsd-2", r"(?:(?:2|two) clause bsd|(?:simplified|freebsd) bsd|bsd 2(?: clause)?)", "bsd"),
    ("bsd-3", r"(?:(?:3|three) clause bsd|(?:new|modified|revised) bsd|bsd 3(?: clause)?)", "bsd"),
    ("bsd-4", r"(?:(?:4|four) clause bsd|original bsd|bsd 4(?: clause)?)", "bsd"),
    ("0bsd", r"(?:0bsd|(?:0|zero) clause bsd)", "bsd"),
    ("isc", r"(?:isc|internet systems consortium)", "is"),
    ("cc0", r"(?:cc0(?: 1 0)?|creative commons zero|cc zero)", "cc0"),
    ("cc-by-nc-sa", r"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)", "by"),
    ("cc-by-nc-nd", r"(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s?)", "by"),
    ("cc-by-nc", r"(?:cc by nc|creative commons attribution non ?commercial)", "by"),
    ("cc-by-sa", r"(?:cc by sa|creative commons attribution share ?alike)", "by"),
    ("cc-by-nd", r"(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s?)", "by"),
    ("cc-by", r"(?:cc by|creative commons attribution)", "by"),
    ("unlicense", r"unlicense", "unlicense"),
    ("wtfpl", r"(?:wtfpl|do what the fuck you want to public)", "wtf"),
    ("zlib", r"zlib(?: libpng)?", "zlib"),
    ("bsl-1", r"(?:boost software|bsl 1 0)", "b"),
    ("artistic-1", r"artistic(?: licen[cs]e)?(?: version| v)? ?1(?: 0)?", "artistic"),
    ("artistic-2", r"artistic(?: licen[cs]e)?(?: version| v)? ?2(?: 0)?", "artistic"),
    ("eupl", r"(?:european union public licen[cs]e|eupl)(?:(?: version| v)? ?1 [12])?", "eu"),
    ("cecill", r"cecill(?: [abc2])?", "cecill"),
    ("ofl", r"(?:sil )?(?:open font licen[cs]e|ofl)(?:(?: version| v)? ?1 1)?", "o"),
    ("ms-pl", r"(?:microsoft public|ms pl)", "m"),
    ("ms-rl", r"(?:microsoft reciprocal|ms rl)", "m"),
    ("cddl", r"(?:common development and distribution licen[cs]e|cddl)(?: 1 [01])?", "c"),
    ("cpl", r"(?:common public licen[cs]e|cpl)(?: 1 0)?", "c"),
    ("osl-3", r"(?:open software licen[cs]e|osl)(?:(?: version| v)? ?3(?: 0)?)?", "o"),
    ("afl-3", r"(?:academic free licen[cs]e|afl)(?:(?: version| v)? ?3(?: 0)?)?", "a"),
    ("psf", r"(?:python software foundation|psf)", "ps"),
    ("php", r"php(?: licen[cs]e)?(?:(?: version| v)? ?3(?: 0?1)?)", "php"),
    ("postgresql", r"postgresql", "postgresql"),
    ("openssl", r"openssl", "openssl"),
    ("ncsa", r"(?:ncsa|university of illinois open source|uiuc)", "c"),
    ("w3c", r"w3c(?: software)?", "w3c"),
    ("zpl", r"(?:zope public|zpl)", "z"),
    ("odbl", r"(?:open database|odbl)", "o"),
    ("odc-by", r"(?:open data commons attribution|odc by)", "o"),
    ("pddl", r"(?:public domain dedication and|pddl)", "p"),
    ("busl", r"(?:business source|busl)", "bus"),
    ("sspl", r"(?:server side public|sspl)", "s"),
    ("elastic-2", r"elastic(?: licen[cs]e)?(?: version| v)? ?2(?: 0)?", "elastic"),
    ("apsl", r"(?:apple public source|apsl)", "a"),
    ("sleepycat", r"sleepycat", "sleepycat"),
]

#: (name of the wording, pattern with N for the license's name, priority = confidence in percent)
WORDINGS = [
    ("spdx", r"spdx licen[cs]e identifier N(?: or later| only)?", 100),
    ("grant", r"(?:licen[cs]ed|released|distributed|published|available|provided|covered|redistribute it)"
              r"(?: \w+){0,3}? under(?: the)?(?: terms(?: and conditions)? of)?(?: the)?(?: a)? N(?: international)?"
              r"(?: licen[cs]e)?(?: version [0-9](?: [0-9])?)?", 95),
    ("subject", r"(?:subject to|governed by|according to|in accordance with|pursuant to)(?: the)?"
                r"(?: terms(?: and conditions)? of)?(?: the)? N(?: licen[cs]e)?", 85),
    ("refer", r"(?:see|read|accept|agree to|copy of|text of|terms of|version of)(?: the)? N licen[cs]e", 75),
    ("header", r"licen[cs]e N(?: licen[cs]e)?", 70),
    ("name", r"(?:the )?N licen[cs]e(?: version [0-9](?: [0-9])?)?", 60),
]

#: Wordings that need no license name.
PLAIN = [
    ("permissive", r"permission is hereby granted free of charge to any person obtaining a copy", 90, "permission"),
    ("permissive", r"permission to use copy modify and or distribute this software for any purpose", 90, "permission"),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted", 90,
     "redistribution"),
    ("public-domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain", 85, "public domain"),
    ("public-domain", r"this (?:work|file|text|code) is (?:in|part of) the public domain", 85, "public domain"),
    ("proprietary", r"all rights reserved", 50, "rights reserved"),
    ("proprietary", r"(?:may not|must not|shall not) be (?:copied|reproduced|redistributed)(?: \w+){0,4} without", 55,
     "without"),
    ("gpl", r"under the terms of the gnu general public licen[cs]e", 80, "gnu"),
    ("gpl", r"gnu general public licen[cs]e", 58, "gnu"),
    ("cc", r"creative commons licen[cs]e", 40, "creative commons"),
    ("cc-by-nc-sa", r"cc by nc sa(?: [234] [05])?", 65, "cc by"),
    ("cc-by-nc-nd", r"cc by nc nd(?: [234] [05])?", 65, "cc by"),
    ("cc-by-nc", r"cc by nc(?: [234] [05])?", 64, "cc by"),
    ("cc-by-sa", r"cc by sa(?: [234] [05])?", 65, "cc by"),
    ("cc-by-nd", r"cc by nd(?: [234] [05])?", 65, "cc by"),
    ("cc-by", r"cc by(?: [234] [05])", 63, "cc by"),
    ("cc0", r"cc0 1 0(?: universal)?", 65, "cc0"),
]

#: Sentences of license notices: (label, pattern, priority, keyword).
NOTICES = [
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions"
            r" of the software", 92, "permission notice"),
    ("x11", r"except as contained in this notice the names? of .{1,80}? shall not be used in advertising", 92, "except as contained"),
    ("isc", r"permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted"
            r" provided that the above copyright notice and this permission notice appear in all copies", 92, "permission to use"),
    ("0bsd", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
             r" granted the software is provided", 93, "permission to use"),
    ("mit-0", r"to deal in the software without restriction(?: \w+){0,30} to permit persons to whom the software is furnished"
              r" to do so the software is provided", 93, "without restriction"),
    ("bsd-2", r"redistributions in binary form must reproduce the above copyright notice this list of conditions and the"
              r" following disclaimer", 88, "redistributions in"),
    ("bsd-3", r"neither the names? of .{1,120}? (?:nor the names of (?:its|their|the) contributors )?may be used to endorse or"
              r" promote products derived from this software", 92, "endorse or promote"),
    ("bsd-4", r"all advertising materials mentioning features or use of this software must display the following"
              r" acknowledge?ment", 93, "advertising materials"),
    ("apache-2", r"you may not use this file except in compliance with the licen[cs]e", 90, "except in compliance"),
    ("apache-2", r"unless required by applicable law or agreed to in writing software distributed under the licen[cs]e is"
                 r" distributed on an as is basis", 91, "as is basis"),
    ("apache-1.1", r"products derived from this software may not be called apache nor may apache appear in their name", 92, "apache"),
    ("gpl", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public"
            r" licen[cs]e", 90, "free software"),
    ("gpl-2", r"gnu general public licen[cs]e as published by the free software foundation (?:either )?version 2(?: 0)?", 94,
     "free software foundation"),
    ("gpl-3", r"gnu general public licen[cs]e as published by the free software foundation (?:either )?version 3(?: 0)?", 94,
     "free software foundation"),
    ("gpl", r"without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public"
            r" licen[cs]e for more details", 89, "implied warranty"),
    ("lgpl-2.1", r"gnu (?:lesser|library) general public licen[cs]e as published by the free software foundation (?:either )?"
                 r"version 2(?: [01])?", 95, "general public"),
    ("lgpl-3", r"gnu lesser general public licen[cs]e as published by the free software foundation (?:either )?version 3(?: 0)?",
     95, "general public"),
    ("agpl-3", r"gnu affero general public licen[cs]e as published by the free software foundation (?:either )?version 3(?: 0)?",
     95, "affero"),
    ("gfdl", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation"
             r" licen[cs]e", 93, "free documentation"),
    ("mpl-2", r"this source code form is subject to the terms of the mozilla public licen[cs]e v(?:ersion)? 2 0", 95, "source code form"),
    ("mpl-1.1", r"the contents of this file are subject to the mozilla public licen[cs]e version 1 1", 95, "mozilla"),
    ("epl-1", r"made available under the terms of the eclipse public licen[cs]e v(?:ersion)? ?1 0", 95, "eclipse"),
    ("epl-2", r"made available under the terms of the eclipse public licen[cs]e v(?:ersion)? ?2 0", 95, "eclipse"),
    ("cddl", r"the contents of this file are subject to the terms of (?:either )?(?:the gnu general public licen[cs]e .{1,60}? or )?"
             r"the common development and distribution licen[cs]e", 95, "common development"),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors be held"
             r" liable for any damages arising from the use of this software", 92, "without any express"),
    ("zlib", r"altered source versions must be plainly marked as such and must not be misrepresented as being the original"
             r" software", 92, "altered source"),
    ("unlicense", r"this is free and unencumbered software released into the public domain", 95, "unencumbered"),
    ("cc0", r"to the extent possible under law .{1,120}? (?:has|have) waived all copyright and related or neighbou?ring rights", 94,
     "waived all copyright"),
    ("bsl-1", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and"
              r" accompanying documentation covered by this licen[cs]e", 95, "person or organization"),
    ("ofl", r"this font software is licensed under the sil open font licen[cs]e", 96, "font software"),
    ("wtfpl", r"you just do what the fuck you want to", 90, "you just do"),
    ("artistic-2", r"everyone is permitted to copy and distribute verbatim copies of this licen[cs]e document but changing it is"
                   r" not allowed this licen[cs]e establishes the terms under which a given free software package", 93, "verbatim copies"),
    ("postgresql", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee"
                   r" and without a written agreement is hereby granted", 94, "written agreement"),
    ("psf", r"licensed to psf under a contributor agreement", 94, "contributor agreement"),
    ("openssl", r"this product includes software developed by the openssl project", 92, "openssl"),
    ("php", r"this product includes php software freely available from", 92, "php"),
    ("w3c", r"permission to copy modify and distribute this work with or without modification for any purpose and without fee or"
            r" royalty is hereby granted", 92, "royalty"),
    ("eupl", r"licensed under the eupl(?: version)? 1 [12] or as soon they will be approved", 95, "eupl"),
    ("elastic-2", r"you may not provide the software to third parties as a hosted or managed service", 90, "managed service"),
    ("sspl", r"if you make the functionality of the program or a modified version available to third parties as a service", 90,
     "as a service"),
    ("busl", r"the licensor hereby grants you the right to copy modify create derivative works redistribute and make non"
             r" production use of the licensed work", 93, "non production"),
    ("cc-by", r"you must give appropriate credit provide a link to the licen[cs]e and indicate if changes were made", 72,
     "appropriate credit"),
    ("cc-by-sa", r"you must distribute your contributions under the same licen[cs]e as the original", 73, "same licen"),
    ("cc-by-nc", r"you may not use the material for commercial purposes", 73, "commercial purposes"),
    ("cc-by-nd", r"you may not distribute the modified material", 73, "modified material"),
    ("proprietary", r"no part of this (?:book|publication|work|document|material) may be reproduced(?: \w+){0,40}? without", 70, "no part of"),
    ("proprietary", r"unauthori[sz]ed (?:copying|reproduction|distribution|use) of this (?:file|software|material|document)"
                    r"(?: via any medium)? is strictly prohibited", 70, "strictly prohibited"),
    ("proprietary", r"this (?:software|document|file) contains (?:proprietary and confidential|confidential and proprietary)"
                    r" information", 70, "proprietary"),
]

#: Without any of these no rule can match.
ROOTS = [b"licen", b"spdx", b"cc by", b"cc0", b"creative commons", b"rights reserved", b"public domain", b"under",
         b"permission", b"redistribution", b"subject to", b"governed by", b"accord", b"pursuant to", b"without",
         *sorted({key.encode() for _, _, _, key in NOTICES})]


@dataclass(frozen=True)
class Signature:
    rule: str
    label: str
    priority: int
    pattern: re.Pattern
    gates: tuple[bytes, ...]


def signatures() -> list[Signature]:
    """All rules in order; the gates of a rule must all occur in the text before its pattern is tried."""
    must = {"spdx": b"spdx", "grant": b"under ", "subject": b"", "refer": b"licen", "header": b"licen", "name": b"licen"}
    out = []
    for label, name, key in FAMILIES:
        for wording, shape, priority in WORDINGS:
            out.append(Signature(f"{label}/{wording}", label, priority,
                                 re.compile((r" (?:" + shape.replace("N", f"(?:{name})") + r")(?= )").encode()),
                                 (must[wording], key.encode())))
    for label, shape, priority, key in PLAIN:
        out.append(Signature(f"{label}/plain", label, priority, re.compile(f" (?:{shape})(?= )".encode()), (key.encode(),)))
    for label, shape, priority, key in NOTICES:
        out.append(Signature(f"{label}/notice", label, priority, re.compile(f" (?:{shape})(?= )".encode()), (key.encode(),)))
    return out


def suppressed(found: list[tuple[int, int, int, str]]) -> list[bool]:
    """Which of the detections (priority, start, end, rule) lie inside an earlier one by (priority, length, start, rule).

    Swept from left to right, longer intervals first: one that ends no later than an interval
    before it lies inside it.
    """
    order = sorted(range(len(found)), key=lambda i: (found[i][1], -found[i][2], -found[i][0], found[i][3]))
    levels = sorted({f[0] for f in found}, reverse=True)
    at = {p: i for i, p in enumerate(levels)}
    furthest = [-1] * len(levels)
    out = [False] * len(found)
    for i in order:
        priority, _, end, _ = found[i]
        mine = at[priority]
        out[i] = max(furthest[:mine + 1]) >= end
        furthest[mine] = max(furthest[mine], end)
    return out


_FOLD = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


class Scanner:
    def __init__(self) -> None:
        self.rules = signatures()
        self.base = [(f" {p} ".encode(), len(p.split()), label) for p, label in BASE_PHRASES.items()]

    def __call__(self, text: bytes) -> tuple:
        words = text.translate(_FOLD).split()
        folded = b" " + b" ".join(words) + b" "
        places: list[tuple] = []  # (from, to, priority, rule, label, base): bytes of the folded text
        if any(r in folded for r in ROOTS):
            for phrase, _, label in self.base:
                at = folded.find(phrase)
                while at >= 0:
                    places.append((at, at + len(phrase) - 1, 98, f"{label}/base", label, True))
                    at = folded.find(phrase, at + 1)
            gates: dict[bytes, bool] = {}
            for s in self.rules:
                if all(gates.setdefault(g, g in folded) for g in s.gates):
                    places += [(m.start(), m.end(), s.priority, s.rule, s.label, False) for m in s.pattern.finditer(folded)]
        if places:
            blanks = np.flatnonzero(np.frombuffer(folded, dtype=np.uint8) == 32)
            first = np.searchsorted(blanks, [p[0] for p in places]).tolist()
            last = np.searchsorted(blanks, [p[1] for p in places]).tolist()
        else:
            first = last = []
        found = [(-p[2], f - e, f, p[3], p[4], e, p[5]) for p, f, e in zip(places, first, last)]  # (-priority, -length, start, rule, label, end, base)
        starts = [d[2] for d in found if d[6]]
        inside = suppressed([(-d[0], d[2], d[5], d[3]) for d in found])
        kept = [d for d, gone in zip(found, inside) if d[6] or not gone]
        kept.sort(key=lambda d: (d[2], d[5], d[3]))
        base_labels = ",".join(sorted({d[4] for d in kept if d[6]}))
        labels = ",".join(sorted({d[4] for d in kept}))
        spans = [{"label": d[4], "rule": d[3], "priority": -d[0], "first": d[2], "end": d[5]} for d in kept]
        return (len(words), len(starts), min(starts, default=None), max(starts, default=None), base_labels, labels,
                max((-d[0] for d in kept), default=0) / 100, len(found) - len(kept), spans)


_SPAN = pa.struct([("label", pa.string()), ("rule", pa.string()), ("priority", pa.int32()), ("first", pa.int64()),
                   ("end", pa.int64())])
_OUT = pa.struct([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                  ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
                  ("n_suppressed", pa.int32()), ("spans", pa.list_(_SPAN))])
_DDL = ("n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
        "score double, n_suppressed int, "
        "spans array<struct<label:string,rule:string,priority:int,first:bigint,end:bigint>>")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, counts, labels, score and the detections kept (word intervals)."""
    small_batches(docs.sparkSession)
    udf = per_text(Scanner, _DDL, _OUT)
    return docs.select(F.col(id_col), udf(raw(text_col)).alias("s")).select(id_col, "s.*")
