"""License scans by template markup.

A template is a line of words with two kinds of markup: `<<beginOptional>> .. <<endOptional>>`
may be left out, and `<<var;name=..;match=REGEX;max=N>>` stands for up to N words that each match
REGEX. Templates compile to one automaton over words, which accepts a place in a text where all
other words of a template stand exactly and in order. Texts are scanned whole, each one alone.

Two kinds of wordings: `NOTICES` say under which license a work is, in a sentence; `TEXTS` are whole
license texts, or whole headers of files, and give their label only where all of them stands. The
long licenses of GNU, Apache, Mozilla and Creative Commons are known by notices and headers alone.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlytics.llm.common import LOWER, text_function

# Phrases and their labels.
BASE_PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Wordings of license notices, with our markup.
NOTICES = (
    (
        "apache-2.0",
        "licensed under the apache license <<beginOptional>>version<<endOptional>> 2 0"
        " <<beginOptional>>the license<<endOptional>>",
    ),
    (
        "gpl-3.0",
        "licensed under <<beginOptional>>the terms of<<endOptional>> the gnu general public license"
        " <<beginOptional>>as published by the free software foundation<<endOptional>>"
        " <<beginOptional>>either<<endOptional>> <<beginOptional>>version<<endOptional>>"
        " <<var;name=version;match=v?3;max=1>> <<beginOptional>>0<<endOptional>>",
    ),
    (
        "gpl-2.0",
        "licensed under <<beginOptional>>the terms of<<endOptional>> the gnu general public license"
        " <<beginOptional>>version<<endOptional>> <<var;name=version;match=v?2;max=1>>"
        " <<beginOptional>>0<<endOptional>>",
    ),
    ("cc-by-4.0", "licensed under <<beginOptional>>a<<endOptional>> cc by <<var;name=version;match=4;max=1>> 0"),
    ("cc-by-nc-4.0", "licensed under <<beginOptional>>a<<endOptional>> cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under <<beginOptional>>a<<endOptional>> cc by sa 4 0"),
    (
        "cc-by-4.0",
        "licensed under a creative commons attribution 4 0 <<beginOptional>>international<<endOptional>> license",
    ),
    ("mit", "released under the <<beginOptional>>terms of the<<endOptional>> mit license"),
    ("mit", "licensed under the <<beginOptional>>terms of the<<endOptional>> mit license"),
    *((f"cc-by-{kind.replace(' ', '-')}-4.0", f"licensed under <<beginOptional>>a<<endOptional>> cc by {kind} 4 0") for kind in ("nd", "nc sa", "nc nd")),
    *(
        (
            f"cc-by-{kind}-4.0",
            f"licensed under a creative commons attribution {name} 4 0 <<beginOptional>>international<<endOptional>> license",
        )
        for kind, name in (
            ("nc", "noncommercial"),
            ("sa", "sharealike"),
            ("nd", "noderivatives"),
            ("nc-sa", "noncommercial sharealike"),
            ("nc-nd", "noncommercial noderivatives"),
        )
    ),
    ("copyright", "copyright <<var;name=owner;match=.+;max=8>> all rights reserved"),
    ("all-rights-reserved", "all rights reserved"),
)

# Whole wordings of licenses and of standard file headers, with our markup.
HOLDER = "<<var;name=holder;match=.+;max=16>>"
NUMBER = "<<beginOptional>><<var;name=number;match=[1-4]|[a-d]|i+|iv;max=1>><<endOptional>>"
MIT_GRANT = (
    "permission is hereby granted free of charge to any person obtaining a copy of this software and"
    " associated documentation files <<beginOptional>>the software<<endOptional>> to deal in the software"
    " without restriction including without limitation the rights to use copy modify merge publish"
    " distribute sublicense and or sell copies of the software and to permit persons to whom the software"
    " is furnished to do so"
)
MIT_NOTICE = (
    "subject to the following conditions the above copyright notice and this permission notice"
    " <<beginOptional>>including the next paragraph<<endOptional>> shall be included in all copies or"
    " substantial portions of the software"
)
MIT_WARRANTY = (
    "the software is provided as is without warranty of any kind express or implied including but not"
    " limited to the warranties of merchantability fitness for a particular purpose and noninfringement in"
    f" no event shall {HOLDER} be liable for any claim damages or other liability whether in an action of"
    " contract tort or otherwise arising from out of or in connection with the software or the use or other"
    " dealings in the software"
)
ISC_GRANT = (
    "permission to use copy modify and <<beginOptional>>or<<endOptional>> distribute this software for any"
    " purpose with or without fee is hereby granted"
)
ISC_NOTICE = "provided that the above copyright notice and this permission notice appear in all copies"
ISC_WARRANTY = (
    f"the software is provided as is and {HOLDER} disclaims all warranties with regard to this software"
    " including all implied warranties of merchantability and fitness in no event shall"
    f" {HOLDER} be liable for any special direct indirect or consequential damages or any damages whatsoever"
    " resulting from loss of use data or profits whether in an action of contract negligence or other"
    " tortious action arising out of or in connection with the use or performance of this software"
)
BSD_CONDITIONS = (
    "redistribution and use in source and binary forms with or without modification are permitted provided"
    f" that the following conditions are met {NUMBER} redistributions of source code must retain the above"
    " copyright notice this list of conditions and the following disclaimer"
    f" {NUMBER} redistributions in binary form must reproduce the above copyright notice this list of"
    " conditions and the following disclaimer in the documentation and or other materials provided with the"
    " distribution"
)
BSD_ADVERTISING = (
    f"{NUMBER} all advertising materials mentioning features or use of this software must display the"
    f" following acknowledgement this product includes software developed by {HOLDER}"
)
BSD_NAMES = (
    f"{NUMBER} neither the name of {HOLDER} nor the names of its contributors may be used to endorse or"
    " promote products derived from this software without specific prior written permission"
)
BSD_WARRANTY = (
    f"this software is provided by {HOLDER} as is and any express or implied warranties including but not"
    " limited to the implied warranties of merchantability and fitness for a particular purpose are"
    f" disclaimed in no event shall {HOLDER} be liable for any direct indirect incidental special exemplary"
    " or consequential damages including but not limited to procurement of substitute goods or services loss"
    " of use data or profits or business interruption however caused and on any theory of liability whether"
    " in contract strict liability or tort including negligence or otherwise arising in any way out of the"
    " use of this software even if advised of the possibility of such damage"
)
GNU_GRANT = "free software you can redistribute it and or modify it under the terms of the gnu"
GNU_LATER = "of the license or <<beginOptional>>at your option<<endOptional>> any later version"
GNU_LICENSES = (
    ("gpl-2.0", "general", "2"),
    ("gpl-3.0", "general", "3"),
    ("lgpl-2.0", "library general", "2"),
    ("lgpl-2.1", "lesser general", "2 1"),
    ("lgpl-3.0", "lesser general", "3"),
    ("agpl-3.0", "affero general", "3"),
)
TEXTS = (
    ("mit", f"{MIT_GRANT} {MIT_NOTICE} {MIT_WARRANTY}"),
    ("mit-0", f"{MIT_GRANT} {MIT_WARRANTY}"),
    ("json", f"{MIT_GRANT} {MIT_NOTICE} the software shall be used for good not evil {MIT_WARRANTY}"),
    ("isc", f"{ISC_GRANT} {ISC_NOTICE} {ISC_WARRANTY}"),
    ("0bsd", f"{ISC_GRANT} {ISC_WARRANTY}"),
    ("bsd-2-clause", f"{BSD_CONDITIONS} {BSD_WARRANTY}"),
    ("bsd-3-clause", f"{BSD_CONDITIONS} {BSD_NAMES} {BSD_WARRANTY}"),
    ("bsd-4-clause", f"{BSD_CONDITIONS} {BSD_ADVERTISING} {BSD_NAMES} {BSD_WARRANTY}"),
    (
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license"
        " <<beginOptional>>v<<endOptional>> 2 0 if a copy of the mpl was not distributed with this file you can"
        " obtain one at <<var;name=scheme;match=https?;max=1>> <<beginOptional>>www<<endOptional>> mozilla org"
        " mpl 2 0",
    ),
    *(
        (
            label,
            f"{GNU_GRANT} {name} public license as published by the free software foundation either version"
            f" {version} {GNU_LATER}",
        )
        for label, name, version in GNU_LICENSES
    ),
    *(
        (
            label,
            f"{GNU_GRANT} {name} public license version {version} <<beginOptional>>only<<endOptional>> as"
            " published by the free software foundation",
        )
        for label, name, version in GNU_LICENSES
    ),
)

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
MARKUP = re.compile(r"<<(beginOptional|endOptional|var;[^>]*)>>|(\S+?)(?=\s|<<|$)")


@dataclass
class Automaton:
    """States with word, pattern and empty moves; `accepting` maps a state to its template."""

    words: list[dict[bytes, list[int]]] = field(default_factory=list)
    patterns: list[list[tuple[re.Pattern, int]]] = field(default_factory=list)
    empty: list[list[int]] = field(default_factory=list)
    accepting: dict[int, int] = field(default_factory=dict)
    starts: dict[bytes, set[int]] = field(default_factory=dict)

    def state(self) -> int:
        self.words.append({})
        self.patterns.append([])
        self.empty.append([])
        return len(self.words) - 1

    def add(self, template: str, number: int) -> None:
        """Append a template, which must begin with a word of its own."""
        start = at = self.state()
        opened: list[int] = []
        first = None
        for match in MARKUP.finditer(template):
            tag, word = match.groups()
            if word:
                first = first or word.encode()
                at = self._word(at, word.encode())
            elif first is None:
                raise ValueError(f"template does not begin with a word: {template!r}")
            elif tag == "beginOptional":
                opened.append(at)
            elif tag == "endOptional":
                self.empty[opened.pop()].append(at)
            else:
                at = self._variable(at, tag)
        if opened or first is None:
            raise ValueError(f"markup is not balanced: {template!r}")
        self.accepting[at] = number
        self.starts.setdefault(first, set()).add(start)

    def _word(self, at: int, word: bytes) -> int:
        target = self.state()
        self.words[at].setdefault(word, []).append(target)
        return target

    def _variable(self, at: int, tag: str) -> int:
        options = dict(part.split("=", 1) for part in tag.split(";")[1:])
        pattern = re.compile(options.get("match", ".+").encode(), re.S)
        after = self.state()
        for _ in range(int(options.get("max", 1))):
            target = self.state()
            self.patterns[at].append((pattern, target))
            self.empty[target].append(after)
            at = target
        return after

    def closure(self, states: set[int]) -> set[int]:
        todo, reached = list(states), set(states)
        while todo:
            for target in self.empty[todo.pop()]:
                if target not in reached:
                    reached.add(target)
                    todo.append(target)
        return reached

    def accepted(self, words: list[bytes], at: int) -> dict[int, int]:
        """template -> end of its longest match that begins with the word at a place."""
        ends: dict[int, int] = {}
        states = self.closure(self.starts[words[at]])
        for place in range(at, len(words)):
            word = words[place]
            moved = {target for state in states for target in self.words[state].get(word, ())}
            moved |= {t for state in states for pattern, t in self.patterns[state] if pattern.fullmatch(word)}
            if not moved:
                break
            states = self.closure(moved)
            ends |= {self.accepting[s]: place + 1 for s in states if s in self.accepting}
        return ends


def compiled(templates: tuple[tuple[str, str], ...]) -> Automaton:
    automaton = Automaton()
    for number, (_, template) in enumerate(templates):
        automaton.add(template, number)
    return automaton


SCAN = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField(
        "places",
        T.ArrayType(T.StructType([
            T.StructField("label", T.StringType()),
            T.StructField("base", T.BooleanType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
        ])),
    ),
])


def scanner(notices: tuple[tuple[str, str], ...] = NOTICES + TEXTS):
    """A function text -> {n_words, places}: base phrases and accepted templates, by start."""
    base = tuple((label, phrase) for phrase, label in BASE_PHRASES)
    templates = base + tuple(notices)
    automaton = compiled(templates)

    def scan(text: str | None) -> dict:
        words = WORD.findall((text or "").encode("utf-8", "surrogatepass").translate(LOWER))
        places = [
            {"label": templates[number][0], "base": number < len(base), "start": at, "end": end}
            for at, word in enumerate(words)
            if word in automaton.starts
            for number, end in sorted(automaton.accepted(words, at).items())
        ]
        return {"n_words": len(words), "places": places}

    return scan


def places_of(text: str, notices: tuple[tuple[str, str], ...] = NOTICES + TEXTS) -> Column:
    """The scan struct of a text column; a null text has no words."""
    return text_function(scanner(notices), SCAN)(F.col(text).cast("string"))


def _labels(places: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")


def license_report(docs: DataFrame) -> DataFrame:
    """Labels and places per row; repeated rows each give one.

    The score is 1 where a template is accepted, 0.5 where only base phrases stand, else 0.
    """
    places = F.col("scan.places")
    base = F.filter(places, lambda p: p["base"])
    starts = F.transform(base, lambda p: p["start"])
    own = F.exists(places, lambda p: ~p["base"])
    scanned = docs.select("doc_id", places_of("text").alias("scan"))
    return scanned.select(
        "doc_id",
        F.col("scan.n_words").alias("n_words"),
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        _labels(base).alias("base_labels"),
        _labels(places).alias("labels"),
        F.when(own, 1.0).when(F.size(base) > 0, 0.5).otherwise(0.0).alias("score"),
        F.transform(places, lambda p: F.concat_ws(":", p["label"], p["start"], p["end"])).alias("places"),
    )
