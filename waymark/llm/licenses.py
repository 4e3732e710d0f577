"""License scans: ordered signature rules over the words of a text, gated by keywords, overlaps resolved by containment.

A text's words are lower-cased and joined by single spaces, so a rule is a regular expression over words and does not
care how they were punctuated or broken into lines. One pass of an Aho-Corasick automaton finds which keywords a text
has; only rules whose keyword is there are run, which for most texts are none. Every match is an interval of words.
Intervals are settled level by level: one that contains or is contained in an interval of an earlier level goes, and
so does one within a longer interval of its own level. Each text is read whole and on its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cluster import column_bytes, held, text_of

#: Phrases that always count, with their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: How sure a match is, by level: machine-readable tags and addresses, sentences of grants and texts, names with versions, names, phrases that name no license.
SURE = (1.0, 0.95, 0.9, 0.75, 0.4)
#: How sure a base phrase is.
BASE_SURE = 0.75

# Rules of each level: a label and a pattern of words. {v} in a pattern is a version, which the label takes where it has one too.
# GRANT and VER stand for patterns of WORDS. The spelling licence is read as license.
WORDS = {
    "GRANT": "(?:licensed|released|distributed|available|published|provided|covered|redistributed|shared|dual licensed)(?: to you)?(?: under| subject to| according to| by)(?: the)?(?: terms(?: and conditions)? of)?(?: the)?",
    "VER": "(?:(?:version |ver |v )?|v)",
}
TAGS = """
gpl-{v} spdx license identifier gpl {v}
gpl spdx license identifier gpl
lgpl-{v} spdx license identifier lgpl {v}
lgpl spdx license identifier lgpl
agpl-{v} spdx license identifier agpl {v}
agpl spdx license identifier agpl
apache-{v} spdx license identifier apache {v}
mit spdx license identifier mit
mit-0 spdx license identifier mit 0
isc spdx license identifier isc
zlib spdx license identifier zlib
bsd-2-clause spdx license identifier bsd 2 clause
bsd-3-clause spdx license identifier bsd 3 clause
bsd-4-clause spdx license identifier bsd 4 clause
0bsd spdx license identifier 0bsd
mpl-{v} spdx license identifier mpl {v}
epl-{v} spdx license identifier epl {v}
cddl-{v} spdx license identifier cddl {v}
eupl-{v} spdx license identifier eupl {v}
osl-{v} spdx license identifier osl {v}
afl-{v} spdx license identifier afl {v}
ofl-{v} spdx license identifier ofl {v}
artistic-{v} spdx license identifier artistic {v}
bsl-1.0 spdx license identifier bsl 1 0
busl-{v} spdx license identifier busl {v}
unlicense spdx license identifier unlicense
wtfpl spdx license identifier wtfpl
cc0-{v} spdx license identifier cc0 {v}
cc-by-{v} spdx license identifier cc by {v}
cc-by-sa-{v} spdx license identifier cc by sa {v}
cc-by-nc-{v} spdx license identifier cc by nc {v}
cc-by-nd-{v} spdx license identifier cc by nd {v}
cc-by-nc-sa-{v} spdx license identifier cc by nc sa {v}
cc-by-nc-nd-{v} spdx license identifier cc by nc nd {v}
postgresql spdx license identifier postgresql
python-{v} spdx license identifier (?:psf|python) {v}
php-{v} spdx license identifier php {v}
ms-pl spdx license identifier ms pl
ms-rl spdx license identifier ms rl
ncsa spdx license identifier ncsa
vim spdx license identifier vim
x11 spdx license identifier x11
proprietary spdx license identifier licenseref proprietary
other spdx license identifier licenseref(?: [^ ]+)?
gpl gnu org licenses gpl(?: (?:html|txt))?
gpl-{v} gnu org licenses (?:old licenses )?gpl {v}(?: (?:html|txt))?
lgpl gnu org licenses lgpl(?: (?:html|txt))?
lgpl-{v} gnu org licenses (?:old licenses )?lgpl {v}(?: (?:html|txt))?
agpl gnu org licenses agpl(?: (?:html|txt))?
agpl-{v} gnu org licenses agpl {v}(?: (?:html|txt))?
gfdl gnu org licenses fdl(?: [^ ]+)?
apache-{v} apache org licenses license {v}(?: (?:html|txt))?
mit opensource org licenses?(?: php)? mit(?: license)?
bsd opensource org licenses?(?: php)? bsd(?: license)?
isc opensource org licenses isc
mpl-{v} mozilla org (?:en us )?mpl {v}
epl-{v} eclipse org (?:legal|org documents) epl (?:v )?{v}
cc-by-{v} creativecommons org licenses by {v}
cc-by-sa-{v} creativecommons org licenses by sa {v}
cc-by-nc-{v} creativecommons org licenses by nc {v}
cc-by-nd-{v} creativecommons org licenses by nd {v}
cc-by-nc-sa-{v} creativecommons org licenses by nc sa {v}
cc-by-nc-nd-{v} creativecommons org licenses by nc nd {v}
cc0-{v} creativecommons org publicdomain zero {v}
public-domain creativecommons org publicdomain mark 1 0
unlicense unlicense org
wtfpl wtfpl net
bsl-1.0 boost org license 1 0 txt
ofl-1.1 scripts sil org ofl
"""
SENTENCES = """
mit permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions
mit the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
isc permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice
0bsd permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided
bsd redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
bsd-3-clause neither the name of (?:[^ ]+ ){1,12}may be used to endorse or promote products derived from this software
bsd-4-clause all advertising materials mentioning features or use of this software must display the following acknowledg[e]?ment
gpl this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
gpl-2.0 under the terms of the gnu general public license as published by the free software foundation either version 2 of the license
gpl-3.0 under the terms of the gnu general public license as published by the free software foundation either version 3 of the license
gpl you should have received a copy of the gnu general public license along with this
gpl everyone is permitted to copy and distribute verbatim copies of this license document
lgpl under the terms of the gnu (?:lesser|library) general public license as published by the free software foundation
lgpl you should have received a copy of the gnu (?:lesser|library) general public license
agpl under the terms of the gnu affero general public license as published by the free software foundation
agpl you should have received a copy of the gnu affero general public license
gfdl permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
apache-2.0 licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
apache you may not use this file except in compliance with the license
apache unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache redistribution and use in source and binary forms (?:[^ ]+ ){1,40}apache software foundation
mpl-2.0 this source code form is subject to the terms of the mozilla public license v 2 0
mpl-1.1 the contents of this file are subject to the mozilla public license version 1 1
mpl if a copy of the mpl was not distributed with this file you can obtain one
epl this program and the accompanying materials are made available under the terms of the eclipse public license
cddl the contents of this file are subject to the terms of the common development and distribution license
eupl licensed under the eupl(?: version)?
bsl-1.0 permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
zlib this software is provided as is without any express or implied warranty in no event will the authors be held liable
zlib altered source versions must be plainly marked as such and must not be misrepresented as being the original software
unlicense this is free and unencumbered software released into the public domain
unlicense anyone is free to copy modify publish use compile sell or distribute this software
wtfpl everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed
wtfpl you just do what the fuck you want to
cc0 the person who associated a work with this deed has dedicated the work to the public domain
cc0 to the extent possible under law (?:[^ ]+ ){1,12}waived all copyright and related or neighboring rights
cc-by you are free to share copy and redistribute the material in any medium or format
cc-by-sa if you remix transform or build upon the material you must distribute your contributions under the same license
cc-by-nc you may not use the material for commercial purposes
cc-by-nd if you remix transform or build upon the material you may not distribute the modified material
cc-by you must give appropriate credit provide a link to the license and indicate if changes were made
ofl this font software is licensed under the sil open font license
artistic the intent of this document is to state the conditions under which a package may be copied
postgresql permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement
ncsa permission is hereby granted free of charge (?:[^ ]+ ){1,20}to deal with the software without restriction
x11 except as contained in this notice the name of the x consortium shall not be used in advertising
openssl this product includes software developed by the openssl project
python this license agreement is between the python software foundation
public-domain (?:this (?:work|file|software|text|code) is|has been|dedicated|released|placed) (?:in|into|to) the public domain
public-domain no copyright is claimed
public-domain no rights reserved
commercial this software is proprietary and confidential
commercial unauthorized copying of this file via any medium is strictly prohibited
commercial no part of this (?:publication|book|work|document) may be reproduced
commercial may not be copied (?:reproduced |modified |published |or |distributed ){1,6}without (?:the )?(?:prior |express |written )*permission
commercial reproduction without (?:prior |written |express )*permission is prohibited
commercial for personal and non commercial use only
commercial confidential and proprietary information of
gpl GRANT gnu general public license
gpl-{v} GRANT gnu general public license VER{v}(?: or (?:any )?later)?
gpl-{v} GRANT gpl VER{v}(?: or (?:any )?later)?
lgpl GRANT gnu (?:lesser|library) general public license
lgpl-{v} GRANT gnu (?:lesser|library) general public license VER{v}(?: or (?:any )?later)?
lgpl-{v} GRANT lgpl VER{v}(?: or (?:any )?later)?
agpl GRANT gnu affero general public license
agpl-{v} GRANT gnu affero general public license VER{v}(?: or (?:any )?later)?
agpl-{v} GRANT agpl VER{v}(?: or (?:any )?later)?
gfdl GRANT gnu free documentation license
apache GRANT apache license
apache-{v} GRANT apache license VER{v}
apache-{v} GRANT apache VER{v}(?: license)?
mit GRANT mit(?: x11)? license
bsd GRANT bsd(?: style)? license
bsd-2-clause GRANT bsd 2 clause(?: license)?
bsd-3-clause GRANT bsd 3 clause(?: license)?
isc GRANT isc license
mpl-{v} GRANT mozilla public license VER{v}
epl-{v} GRANT eclipse public license VER{v}
cddl-{v} GRANT common development and distribution license VER{v}
artistic-{v} GRANT artistic license VER{v}
ofl-{v} GRANT sil open font license VER{v}
bsl-1.0 GRANT boost software license(?: version 1 0)?
zlib GRANT zlib(?: libpng)? license
cc0 GRANT (?:creative commons )?cc0(?: 1 0)?
cc-by-{v} GRANT cc by {v}
cc-by-sa-{v} GRANT cc by sa {v}
cc-by-nc-{v} GRANT cc by nc {v}
cc-by-nd-{v} GRANT cc by nd {v}
cc-by-nc-sa-{v} GRANT cc by nc sa {v}
cc-by-nc-nd-{v} GRANT cc by nc nd {v}
cc-by GRANT creative commons attribution(?: license)?
cc-by-{v} GRANT creative commons attribution {v}
cc-by-sa-{v} GRANT creative commons attribution share ?alike {v}
cc-by-nc-{v} GRANT creative commons attribution non ?commercial {v}
unlicense GRANT unlicense
wtfpl GRANT wtfpl
ogl-{v} GRANT open government license VER{v}
odbl GRANT open (?:data commons open )?database license
"""
VERSIONED = """
gpl-{v} gnu general public license VER{v}
gpl-{v} general public license VER{v}
gpl-{v} gnu gpl VER{v}
gpl-2.0 gplv2
gpl-3.0 gplv3
gpl-{v} gpl v?{v}
lgpl-{v} (?:gnu )?(?:lesser|library) general public license VER{v}
lgpl-{v} lgpl v?{v}
lgpl-2.0 lgplv2
lgpl-3.0 lgplv3
agpl-{v} (?:gnu )?affero general public license VER{v}
agpl-{v} agpl v?{v}
agpl-3.0 agplv3
gfdl-{v} (?:gnu )?free documentation license VER{v}
apache-{v} apache license VER{v}
apache-{v} apache software license VER{v}
apache-{v} apache v?{v} license
mpl-{v} mozilla public license VER{v}
mpl-{v} mpl v?{v}
epl-{v} eclipse public license VER{v}
epl-{v} epl v?{v}
cpl-{v} common public license VER{v}
cddl-{v} common development and distribution license VER{v}
cddl-{v} cddl v?{v}
eupl-{v} european union public license VER{v}
eupl-{v} eupl v?{v}
artistic-{v} artistic license VER{v}
osl-{v} open software license VER{v}
afl-{v} academic free license VER{v}
ofl-{v} sil open font license VER{v}
ofl-{v} open font license VER{v}
bsl-{v} boost software license VER{v}
busl-{v} business source license VER{v}
python-{v} python software foundation license VER{v}
php-{v} php license VER{v}
zpl-{v} zope public license VER{v}
lppl-{v} latex project public license VER{v}
cecill-{v} cecill VER{v}
ecl-{v} educational community license VER{v}
upl-{v} universal permissive license VER{v}
mulan-{v} mulan psl VER{v}
sspl-{v} server side public license VER{v}
elastic-{v} elastic license VER{v}
ogl-{v} open government license VER{v}
odbl-{v} odbl v?{v}
cc0-{v} cc0 {v}
cc-by-{v} cc by {v}
cc-by-sa-{v} cc by sa {v}
cc-by-nc-{v} cc by nc {v}
cc-by-nd-{v} cc by nd {v}
cc-by-nc-sa-{v} cc by nc sa {v}
cc-by-nc-nd-{v} cc by nc nd {v}
cc-by-{v} creative commons attribution {v}
cc-by-sa-{v} creative commons attribution share ?alike {v}
cc-by-nc-{v} creative commons attribution non ?commercial {v}
cc-by-nd-{v} creative commons attribution no ?deriv(?:ative|ativ)e?s? {v}
cc-by-nc-sa-{v} creative commons attribution non ?commercial share ?alike {v}
cc-by-nc-nd-{v} creative commons attribution non ?commercial no ?deriv(?:ative|ativ)e?s? {v}
bsd-2-clause bsd (?:2|two) clause(?: license)?
bsd-2-clause (?:2|two) clause bsd(?: license)?
bsd-3-clause bsd (?:3|three) clause(?: license)?
bsd-3-clause (?:3|three) clause bsd(?: license)?
bsd-4-clause bsd (?:4|four) clause(?: license)?
bsd-4-clause (?:4|four) clause bsd(?: license)?
bsd-2-clause simplified bsd license
bsd-2-clause freebsd license
bsd-3-clause (?:new|modified|revised) bsd license
bsd-4-clause original bsd license
0bsd zero clause bsd(?: license)?
"""
NAMES = """
gpl gnu general public license
gpl gnu gpl
gpl gpl license
lgpl gnu (?:lesser|library) general public license
lgpl (?:lesser|library) general public license
lgpl gnu lgpl
agpl gnu affero general public license
agpl affero general public license
agpl gnu agpl
gfdl gnu free documentation license
gfdl free documentation license
apache apache(?: software)? license
mit mit(?: x11| expat)? license
mit expat license
mit-0 mit no attribution
isc isc license
bsd bsd(?: style| like)? license
x11 x11 license
zlib zlib(?: libpng)? license
mpl mozilla public license
epl eclipse public license
cpl common public license
cddl common development and distribution license
eupl european union public license
artistic artistic license
osl open software license
afl academic free license
ofl (?:sil )?open font license
bsl-1.0 boost software license
busl business source license
python python software foundation license
php php license
postgresql postgresql license
ncsa university of illinois ncsa open source license
openssl openssl license
zpl zope public license
lppl latex project public license
cecill cecill(?: [abc])? license
ecl educational community license
upl universal permissive license
mulan mulan permissive software license
mulan mulan psl
sspl server side public license
elastic elastic license
vim vim license
ms-pl microsoft public license
ms-rl microsoft reciprocal license
unlicense the unlicense
wtfpl do what the fuck you want to public license
wtfpl wtfpl
beerware beerware license
jsonlicense the software shall be used for good not evil
ogl open government license
odbl open database license
odc-by open data commons attribution license
cdla community data license agreement
etalab license ouverte
dl-de datenlizenz deutschland
rail responsible ai license
openrail openrail(?: m)?
cc0 creative commons (?:zero|cc0)
cc0 cc0
cc-by creative commons attribution(?: license)?
cc-by-sa cc by sa
cc-by-nc cc by nc
cc-by-nd cc by nd
cc-by-nc-sa cc by nc sa
cc-by-nc-nd cc by nc nd
cc-by-sa creative commons attribution share ?alike
cc-by-nc creative commons attribution non ?commercial
cc-by cc by
public-domain public domain(?: dedication| mark)?
"""
VAGUE = """
commercial all rights reserved
commercial alle rechte vorbehalten
commercial tous droits r[^ ]+serv[^ ]+s
commercial todos los derechos reservados
commercial proprietary license
commercial commercial license
commercial end user license agreement
creative-commons creative commons(?: license)?
other licensed under(?: the| a| an)?
other released under(?: the| a| an) (?:[^ ]+ ){1,4}license
other dual licensed
other see (?:the )?(?:file )?(?:copying|license)(?: txt| md)? (?:file )?for (?:details|more|terms|the)
other license agreement
other open source license
other free software license
copyright copyright (?:c )?(?:19|20)[0-9][0-9]
copyright (?:c )?copyright (?:c )?by
copyright copyright c
"""
LEVELS = (TAGS, SENTENCES, VERSIONED, NAMES, VAGUE)
_VERSION = r"(?P<v>[0-9](?: [0-9])?)(?: [0-9])?"


#: Words that many texts without a license have; a rule's keyword is another one if it has another.
COMMON = frozenset("license licensed software version general public source this that with from free under conditions copies you the and".split())


class Rule(NamedTuple):
    """``keyword`` is in every match, and so are the words of ``needs``."""

    label: str
    level: int
    keyword: str
    needs: tuple[str, ...]
    pattern: re.Pattern


def sure_words(pattern: str) -> list[str]:
    """Words that every match of a pattern has, the best keyword first: what stands in a group, or in a word that a group or an
    optional space is part of, is not sure to be there."""
    plain, depth = [], 0
    pattern = re.sub(r"[^ ]* \?[^ ]*", "?", pattern).replace("(?: ", " (?: ")
    for c in re.sub(r" \)([?+*]|\{[0-9,]+\})?", r" )\1 ", pattern):
        depth += c == "("
        plain.append("?" if depth else c)
        depth -= c == ")"
    sure = {w for w in "".join(plain).split(" ") if re.fullmatch("[a-z0-9]+", w)}
    return sorted(sure, key=lambda w: (w in COMMON, -len(w), w))


def rules(levels: tuple[str, ...] = LEVELS) -> list[Rule]:
    out = []
    for level, text in enumerate(levels):
        for line in text.strip().splitlines():
            label, pattern = line.split(" ", 1)
            pattern = pattern.replace("GRANT", WORDS["GRANT"]).replace("VER", WORDS["VER"])
            sure = sure_words(pattern.replace("{v}", "#"))
            if not sure:
                raise ValueError(f"no keyword: {line}")
            out.append(Rule(label, level, sure[0], tuple(f" {w} " for w in sure[1:]), re.compile(f"(?<= )(?:{pattern.replace('{v}', _VERSION)})(?= )")))
    return out


def label_of(rule: Rule, match: re.Match) -> str:
    if "{v}" not in rule.label:
        return rule.label
    major, *minor = match["v"].split(" ")
    return rule.label.replace("{v}", f"{major}.{minor[0] if minor else 0}")


class Found(NamedTuple):
    """An interval of words [start, end) and the rule, by its number, that found it."""

    start: int
    end: int
    level: int
    rule: int
    label: str


def settle(found: list[Found]) -> list[Found]:
    """What stands of overlapping intervals. Earlier levels go first; an interval that contains one that stands, or lies within
    one, is suppressed. Within a level the longer one stands, of equal ones that of the earlier rule. Intervals that only
    overlap both stand."""
    stand: list[Found] = []
    for level in range(len(SURE)):
        own = sorted((f for f in found if f.level == level), key=lambda f: (f.start, -f.end, f.rule))
        if own and stand:
            start, end = np.array([f.start for f in stand]), np.array([f.end for f in stand])
            furthest, nearest = np.maximum.accumulate(end), np.minimum.accumulate(end[::-1])[::-1]
            s, e = np.array([f.start for f in own]), np.array([f.end for f in own])
            before, after = np.searchsorted(start, s, "right"), np.searchsorted(start, s, "left")
            within = (before > 0) & (furthest[np.maximum(before - 1, 0)] >= e)
            around = (after < len(start)) & (nearest[np.minimum(after, len(start) - 1)] <= e)
            own = [f for f, gone in zip(own, (within | around).tolist(), strict=True) if not gone]
        reach = -1
        for f in own:
            if f.end > reach:
                stand.append(f)
                reach = f.end
        stand.sort()
    return stand


#: Bytes that part words become spaces, A-Z lower-cased.
_WORD_BYTES = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def worded(text: bytes) -> str:
    """The words of a UTF-8 text, each between two single spaces, one character a byte; a space for none."""
    text = text.translate(_WORD_BYTES)
    while b"  " in text:
        text = text.replace(b"  ", b" ")
    text = text.strip(b" ")
    return f" {text.decode('latin-1')} " if text else " "


class Scanner:
    """All rules, with one automaton for their keywords and the base phrases."""

    def __init__(self, levels: tuple[str, ...] = LEVELS):
        self.rules = rules(levels)
        self.by_keyword: dict[str, list[int]] = {}
        for i, rule in enumerate(self.rules):
            self.by_keyword.setdefault(f" {rule.keyword} ", []).append(i)
        self.automaton = ahocorasick.Automaton()
        for word in (*self.by_keyword, *(f" {p} " for p in BASE)):
            self.automaton.add_word(word, word)
        self.automaton.make_automaton()

    def scan(self, words: str) -> tuple[list[tuple[int, str]], list[Found]]:
        """Base places (first word, label), in order, and what stands of the rules' matches, by place."""
        seen, where = set(), []
        for at, word in self.automaton.iter(words):
            seen.add(word)
            if word[1:-1] in BASE:
                where.append((at + 1 - len(word), BASE[word[1:-1]]))
        spelled = words.replace(" licence", " license")
        if spelled != words:
            seen.update(word for _, word in self.automaton.iter(spelled))
        if not seen:
            return [], []
        matches = [(i, m) for word in seen for i in self.by_keyword.get(word, ()) if all(w in spelled for w in self.rules[i].needs) for m in self.rules[i].pattern.finditer(spelled)]
        # Numbers of words before places: the spaces before them, counted from one place to the next.
        spots = sorted({at for at, _ in where} | {m.start() - 1 for _, m in matches} | {m.end() for _, m in matches})
        number, spaces, last = {}, 0, 0
        for at in spots:
            spaces += words.count(" ", last, at)
            number[at], last = spaces, at
        base = sorted((number[at], label) for at, label in where)
        found = [Found(number[m.start() - 1], number[m.end()], self.rules[i].level, i, label_of(self.rules[i], m)) for i, m in matches]
        return base, settle(found)


def scanner() -> Scanner:
    return held("licenses", Scanner)


def sureness(base: list[tuple[int, str]], found: list[Found]) -> float:
    """How sure it is that a text tells of a license: of each label the surest match, combined as if they were independent."""
    best: dict[str, float] = dict.fromkeys((label for _, label in base), BASE_SURE)
    for f in found:
        best[f.label] = max(best.get(f.label, 0.0), SURE[f.level])
    doubt = 1.0
    for label in sorted(best):
        doubt *= 1 - best[label]
    return 1 - doubt


SPAN = "struct<start: long, end: long, level: int, rule: int, label: string>"


def licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, base (places of base phrases: start, label), detections (intervals of words
    that stand: start, end, level, rule, label; by place), score.

    Null and empty texts have no words, no places and score 0; repeated rows are scanned each; other columns are ignored; an
    empty table gives an empty one. A text of any length is scanned whole: it is held a few times, and what a rule may
    match is bounded in words, so its time grows with its length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner().scan
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            view, n, base, found, score = memoryview(data), [], [], [], []
            for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                words = worded(bytes(view[lo:hi]))
                places, spans = scan(words)
                n.append(words.count(" ") - 1)
                base.append([{"start": at, "label": label} for at, label in places])
                found.append([f._asdict() for f in spans])
                score.append(sureness(places, spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(base, pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())]))), pa.array(found, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("level", pa.int32()), ("rule", pa.int32()), ("label", pa.string())]))), pa.array(score, pa.float64())],
                ["doc_id", "n_words", "base", "detections", "score"],
            )

    schema = f"doc_id long, n_words long, base array<struct<start: long, label: string>>, detections array<{SPAN}>, score double"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(run, schema)


def joined(labels: Column) -> Column:
    """Distinct labels, sorted, by comma."""
    return F.array_join(F.sort_array(F.array_distinct(labels)), ",")
