"""License scan by template markup.

A template is a license text in which ``<<beginOptional>>`` ... ``<<endOptional>>`` enclose wording that may be absent (regions
nest) and ``<<var;words=LO-HI>>`` stands for LO to HI words of any kind (a holder's name, a version).  It is compiled into a token
automaton over the words of a text: a state per word, an exit past every optional region, HI states that take any word per
replaceable region.  A text holds the license if a run of its words is accepted, so the mandatory wording has to match word
for word.  Words are compared in lower case (A-Z only) without punctuation and white space.

Every word sequence between regions is mandatory, so a text without one of them is passed over by a byte search; that test
is exact, and only the remaining texts go through the automaton.  An automaton holds at most one entry per state, the
earliest start of a run in that state, so memory is bounded by the template and time is linear in the text.  Nothing is shuffled.

Base phrases (``PHRASES``) are found beside the templates at every place where their words stand consecutively.  ``score`` is 1 for a text that
holds a whole template, 0.5 for one that only names a license by a base phrase, else 0.

Defined cases: a null or empty text, or one without words, has no words, places and labels, and score 0; every row is scanned on
its own, so repeated rows, null ids and extra columns change nothing; very long texts are scanned whole; of overlapping runs of one template the
leftmost and then longest counts; an empty table gives an empty result; a template without mandatory words or with unbalanced regions is refused.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.functions.shipping import ship_by_value
from recspark.llm.common import col

ship_by_value(__name__)

RESULT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, spans string")

# Base phrases and their labels (fixed values).
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

_OPT, _END = "<<beginOptional>>", "<<endOptional>>"
_AS_IS = ('is provided "as is", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, '
          "fitness for a particular purpose and noninfringement.")
_BSD_HEAD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
             f"are met: {_OPT}1.{_END} Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
             f"disclaimer. {_OPT}2.{_END} Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
             "following disclaimer in the documentation and/or other materials provided with the distribution.")
_BSD_TAIL = ("THIS SOFTWARE IS PROVIDED BY <<var;words=1-20>> \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED "
             "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<var;words=1-20>> BE LIABLE FOR ANY "
             "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES")
_GPL_HEAD = (f"<<var;words=1-8>> is free software{_OPT}:{_END} you can redistribute it and/or modify it under the terms of the GNU General Public License as "
             "published by the Free Software Foundation")
_GPL_TAIL = f"{_OPT}of the License,{_END} or (at your option) any later version"

# Wording of public licenses and of the notices that name them (fixed values), as template markup.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of <<var;words=1-8>> (the \"Software\"), to deal in the Software "
            "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
            f"of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
            f"notice and this permission notice {_OPT}(including the next paragraph){_END} shall be included in all copies or substantial portions of the "
            f"Software. The Software {_AS_IS} In no event shall <<var;words=1-20>> be liable for any claim, damages or other liability"),
    ("mit", f"{_OPT}This <<var;words=1-3>> is{_END} released under the <<beginOptional>>terms of the<<endOptional>> MIT License"),
    ("mit", f"licensed under the {_OPT}terms of the{_END} MIT License"),
    ("isc", f"Permission to use, copy, modify, and{_OPT}/or{_END} distribute this software for any purpose with or without fee is hereby granted, provided that "
            "the above copyright notice and this permission notice appear in all copies"),
    ("0bsd", f"Permission to use, copy, modify, and{_OPT}/or{_END} distribute this software for any purpose with or without fee is hereby granted. "
             'The software is provided "as is"'),
    ("bsd-2-clause", f"{_BSD_HEAD} {_BSD_TAIL}"),
    ("bsd-3-clause", f"{_BSD_HEAD} {_OPT}3.{_END} Neither the name of <<var;words=1-20>> nor the names of <<var;words=1-8>> may be used to endorse or promote "
                     f"products derived from this software without specific prior written permission. {_BSD_TAIL}"),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will <<var;words=1-8>> be held liable for any damages "
             "arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, "
             "and to alter it and redistribute it freely"),
    ("apache-2.0", f"Licensed under the Apache License, Version 2.0 {_OPT}(the \"License\"); you may not use <<var;words=1-6>> except in compliance with the "
                   f"License{_END}"),
    ("gpl-3.0-or-later", f"{_GPL_HEAD}, {_OPT}either{_END} version 3 {_GPL_TAIL}"),
    ("gpl-2.0-or-later", f"{_GPL_HEAD}; {_OPT}either{_END} version 2 {_GPL_TAIL}"),
    ("gpl-3.0", f"licensed under the {_OPT}terms of the{_END} GNU General Public License{_OPT},{_END} version 3 {_OPT}.0{_END}"),
    ("gpl-2.0", f"licensed under the {_OPT}terms of the{_END} GNU General Public License{_OPT},{_END} version 2 {_OPT}.0{_END}"),
    ("cc-by-4.0", f"licensed under {_OPT}a{_END} {_OPT}the{_END} Creative Commons Attribution 4.0 {_OPT}International{_END} {_OPT}Public{_END} License"),
    ("cc-by-4.0", f"licensed under {_OPT}the{_END} CC BY 4.0"),
    ("cc-by-sa-4.0", f"licensed under {_OPT}the{_END} CC BY-SA 4.0"),
    ("cc-by-nc-4.0", f"licensed under {_OPT}the{_END} CC BY-NC 4.0"),
    ("unlicense", f"This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
                  "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial"),
)

#: Bytes of a UTF-8 text that belong to words stay (A-Z lowered), all others become spaces.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_MARK = re.compile(r"<<(beginOptional|endOptional|var;words=(\d+)-(\d+))>>")


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8").translate(_TABLE).split()


def parts_of(markup: str):
    """The pieces of a template in order: ``("word", w)``, ``("open",)``, ``("close",)``, ``("var", lo, hi)``."""
    at = depth = 0
    for m in [*_MARK.finditer(markup), None]:
        yield from (("word", w) for w in words_of(markup[at:m.start() if m else len(markup)]))
        if m is None:
            break
        at = m.end()
        if m[2]:
            lo, hi = int(m[2]), int(m[3])
            if not 0 <= lo <= hi or hi < 1:
                raise ValueError(f"bad word bounds in {m[0]}")
            yield "var", lo, hi
        else:
            depth += 1 if m[1] == "beginOptional" else -1
            if depth < 0:
                raise ValueError("endOptional without beginOptional")
            yield ("open",) if m[1] == "beginOptional" else ("close",)
    if depth:
        raise ValueError("beginOptional without endOptional")


class TokenAutomaton:
    """A compiled template.

    ``takes[s]`` is the word that leads from state s to s + 1 (None: any word), ``after[s]`` the states that hold once s
    is reached (s itself and what the exits of regions add), ``runs`` the mandatory word sequences as bytes to search for.
    """

    def __init__(self, markup: str):
        takes, exits, opened, run, runs = [], {}, [], [], []
        for kind, *args in [*parts_of(markup), ("end",)]:
            if kind == "word":
                takes.append(args[0])
                if not opened:
                    run.append(args[0])
                continue
            if run:
                runs.append(b" " + b" ".join(run) + b" ")
                run = []
            if kind == "var":
                lo, hi = args
                end = len(takes) + hi
                for k in range(lo, hi):
                    exits.setdefault(len(takes) + k, []).append(end)
                takes += [None] * hi
            elif kind == "open":
                opened.append(len(takes))
            elif kind == "close":
                exits.setdefault(opened.pop(), []).append(len(takes))
        if not runs:
            raise ValueError("a template needs mandatory words")
        self.takes, self.runs, self.end = takes, runs, len(takes)
        self.after = [()] * (self.end + 1)
        for s in range(self.end, -1, -1):  # exits lead forward
            self.after[s] = tuple(sorted({s, *(x for e in exits.get(s, ()) for x in self.after[e])}))
        first = [self.takes[s] for s in self.after[0]]
        self.first = None if None in first else frozenset(first)

    def may_match(self, joined: bytes) -> bool:
        return all(run in joined for run in self.runs)

    def _leftmost(self, words: list[bytes], at: int):
        """The accepted run with the smallest start from ``at`` on, and of those the longest: (start, end), or None."""
        takes, after, end, first = self.takes, self.after, self.end, self.first
        states: dict[int, int] = {}  # state -> smallest start of a run that is in it
        best = None
        for k in range(at, len(words)):
            w = words[k]
            if best is None and (first is None or w in first):
                for s in after[0]:
                    states.setdefault(s, k)
            if not states:
                if best is not None:
                    break
                continue
            reached: dict[int, int] = {}
            for s, start in states.items():
                if s < end and (takes[s] is None or takes[s] == w):
                    for x in after[s + 1]:
                        if reached.get(x, start) >= start:
                            reached[x] = start
            if end in reached and (best is None or reached[end] <= best[0]):
                best = (reached[end], k + 1)
            states = reached if best is None else {s: b for s, b in reached.items() if b <= best[0]}
        return best

    def find(self, words: list[bytes]) -> list[tuple[int, int]]:
        """Runs of words that the template accepts, leftmost first and then longest, without overlaps."""
        out, at = [], 0
        while (m := self._leftmost(words, at)) is not None:
            out.append(m)
            at = m[1]
        return out


def phrase_places(joined: bytes, phrase: bytes) -> list[int]:
    """Numbers of the words at which a phrase stands; ``joined`` is the words with a space before and after each."""
    out, at, words, seen = [], joined.find(phrase), 0, 0
    while at >= 0:
        words += joined.count(b" ", seen, at)
        out.append(words)
        seen, at = at, joined.find(phrase, at + 1)
    return out


def scan_words(words: list[bytes], phrases, automata):
    """(places of base phrases as (word, label), accepted runs as (label, first word, end))."""
    joined = b" " + b" ".join(words) + b" "
    base = [(k, label) for phrase, label in phrases for k in phrase_places(joined, phrase)]
    spans = sorted({(label, a, b) for label, auto in automata if auto.may_match(joined) for a, b in auto.find(words)}, key=lambda s: (s[1], s[2], s[0]))
    return base, spans


def _scanner(phrases, templates):
    def scan(batches):
        known = [(b" " + b" ".join(words_of(p)) + b" ", label) for p, label in phrases]
        automata = [(label, TokenAutomaton(markup)) for label, markup in templates]
        for batch in batches:
            rows = []
            for text in batch["text"].tolist():
                words = words_of(text) if text else []
                base, spans = scan_words(words, known, automata) if words else ([], [])
                own = {label for _, label in base}
                at = [k for k, _ in base]
                rows.append((len(words), len(base), min(at, default=None), max(at, default=None), ",".join(sorted(own)),
                             ",".join(sorted(own | {s[0] for s in spans})), 1.0 if spans else 0.5 if base else 0.0,
                             ",".join(f"{label}:{a}:{b}" for label, a, b in spans)))
            out = pd.DataFrame(rows, columns=["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])
            out[["first_word", "last_word"]] = out[["first_word", "last_word"]].astype("Int64")
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy(object, na_value=None))
            yield out

    return scan


def scan_licenses(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the columns of ``RESULT``; ``spans`` lists accepted runs as label:first word:end (end exclusive)."""
    for _, markup in templates:
        TokenAutomaton(markup)  # a bad template fails here and not in a task
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    return rows.mapInPandas(_scanner(tuple(phrases), tuple(templates)), RESULT)


def _pattern(markup: str) -> str:
    """A template as a regular expression over words that have a space on both sides each."""
    show = {"word": lambda w: f" {w.decode()} ", "open": lambda: "(?:", "close": lambda: ")?", "var": lambda lo, hi: f"(?: [^ ]+ ){{{lo},{hi}}}"}
    return "".join(show[kind](*args) for kind, *args in parts_of(markup))


def _sql() -> str:
    """The query in SQL: base phrases by splitting, templates as regular expressions."""
    place = []
    for phrase, label in PHRASES:
        p, n = "".join(f" {w} " for w in phrase.split()), len(phrase.split())
        place.append(f"""SELECT row, '{label}' AS label, len(p) - 1 AS places, length(p[1]) - length(replace(p[1], ' ', '')) AS low,
            n_words * 2 - {2 * n} - (length(p[-1]) - length(replace(p[-1], ' ', ''))) AS high
            FROM (SELECT row, n_words, string_split(s, '{p}') AS p FROM spaced) WHERE len(p) > 1""")
    found = [f"SELECT row, '{label}' AS label FROM spaced WHERE regexp_matches(s, '{_pattern(markup)}')" for label, markup in TEMPLATES]
    return f"""
    WITH words AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
    spaced AS (SELECT row, doc_id, len(w) AS n_words, CASE WHEN len(w) > 0 THEN ' ' || array_to_string(w, '  ') || ' ' ELSE '' END AS s FROM words),
    base AS ({' UNION ALL '.join(place)}),
    whole AS ({' UNION ALL '.join(found)}),
    base_rows AS (SELECT row, sum(places) AS n_base, min(low) // 2 AS first_word, max(high) // 2 AS last_word,
                         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY row),
    all_rows AS (SELECT row, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(full_text) AS full_text
                 FROM (SELECT row, label, 0 AS full_text FROM base UNION ALL SELECT row, label, 1 FROM whole) GROUP BY row)
    SELECT doc_id, n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
           coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
           CAST(CASE WHEN full_text = 1 THEN 1 WHEN n_base > 0 THEN 0.5 ELSE 0 END AS DOUBLE) AS score
    FROM spaced LEFT JOIN base_rows USING (row) LEFT JOIN all_rows USING (row)"""


SQL = _sql()
