"""License scan: marked-up license templates compiled to token automata.

Markup: ``<<beginOptional>> ... <<endOptional>>`` may be left out;
``<<var;name=x;match=REGEX;words=a..b>>`` is a replaceable region, a to b words
(1..1 by default) that each match REGEX in full; every other word is mandatory
and must stand in the text exactly (lower case, words as in :data:`WORD`).  A
template is compiled into an automaton over words; a place of the text is
accepted if a run of the automaton from there reaches its end, and the longest
accepted stretch is the match.

Texts are scanned whole, one Arrow batch after the other, no shuffle: a document
is tokenised into a list of words only if it holds a mandatory word of some
template (a byte search), words are otherwise only counted.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import byte_chunks

WORD = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: fixed values: label -> markup
BASE_TEMPLATES = {
    "cc-by": "cc by",
    "gpl": "general public license",
    "reserved": "all rights reserved",
}
NOTICE_TEMPLATES = {
    "apache-notice": "licensed under the apache license <<beginOptional>>version <<var;name=major;match=[0-9]+>>"
                     " <<beginOptional>><<var;name=minor;match=[0-9]+>><<endOptional>><<endOptional>>",
    "cc-notice": "licensed under <<beginOptional>>a creative commons<<endOptional>> cc by"
                 " <<beginOptional>>nc<<endOptional>> <<beginOptional>>sa<<endOptional>> <<beginOptional>>nd<<endOptional>>"
                 " <<var;name=version;match=[0-9]+;words=1..2>>",
    "gpl-notice": "licensed under the <<beginOptional>>terms of the<<endOptional>> <<beginOptional>>gnu<<endOptional>>"
                  " general public license <<beginOptional>>version <<var;name=version;match=[0-9]+>><<endOptional>>",
    "mit-notice": "released under the <<beginOptional>>terms of the<<endOptional>> mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of"
                 " <<var;name=work;match=[a-z0-9]+;words=1..6>> to deal in the software without restriction",
    "rights-notice": "<<beginOptional>>copyright <<beginOptional>>c<<endOptional>> <<var;name=year;match=[0-9]{4}>>"
                     " <<var;name=holder;match=[a-z0-9]+;words=1..6>><<endOptional>> all rights reserved",
}

_TAG = re.compile(r"<<(.*?)>>", re.S)


@dataclass
class Automaton:
    """States 0..n; ``end`` accepts.  words[s]: word -> states, tests[s]: (regex, state), free[s]: states for no word."""

    label: str
    words: list[dict[bytes, list[int]]] = field(default_factory=list)
    tests: list[list[tuple[re.Pattern, int]]] = field(default_factory=list)
    free: list[list[int]] = field(default_factory=list)
    end: int = 0
    needed: bytes = b""

    def state(self) -> int:
        self.words.append({})
        self.tests.append([])
        self.free.append([])
        return len(self.words) - 1

    def closure(self, states: Iterable[int]) -> set[int]:
        out, todo = set(), list(states)
        while todo:
            s = todo.pop()
            if s not in out:
                out.add(s)
                todo += self.free[s]
        return out

    def step(self, states: set[int], word: bytes) -> set[int]:
        new = [t for s in states for t in self.words[s].get(word, ())]
        new += [t for s in states for test, t in self.tests[s] if test.fullmatch(word)]
        return self.closure(new)

    def first_words(self) -> set[bytes]:
        start = self.closure([0])
        if any(self.tests[s] for s in start):
            raise ValueError(f"{self.label}: a template may not start with a replaceable region")
        return {w for s in start for w in self.words[s]}

    def longest(self, words: list[bytes], at: int) -> int:
        """End of the longest match from word ``at``, or -1."""
        states, best, i = self.closure([0]), -1, at
        while states and i < len(words):
            states = self.step(states, words[i])
            i += 1
            if self.end in states:
                best = i
        return best


def compile_template(label: str, markup: str) -> Automaton:
    """Automaton of a marked-up template (raises on unbalanced or empty markup)."""
    a = Automaton(label)
    here, opened, mandatory, last = a.state(), [], [], 0
    for tag in [*_TAG.finditer(markup), None]:
        for w in re.findall(WORD, markup[last: tag.start() if tag else len(markup)].encode().lower()):
            new = a.state()
            a.words[here].setdefault(w, []).append(new)
            here = new
            if not opened:
                mandatory.append(w)
        if tag is None:
            break
        last = tag.end()
        kind, *rest = tag[1].split(";")
        if kind == "beginOptional":
            opened.append(here)
        elif kind == "endOptional":
            if not opened:
                raise ValueError(f"{label}: endOptional without beginOptional")
            a.free[opened.pop()].append(here)
        elif kind == "var":
            opts = dict(x.split("=", 1) for x in rest)
            least, most = map(int, opts.get("words", "1..1").split(".."))
            test, ends = re.compile(opts.get("match", ".+").encode()), [here] if least == 0 else []
            for i in range(1, most + 1):
                new = a.state()
                a.tests[here].append((test, new))
                here = new
                if i >= least:
                    ends.append(here)
            new = a.state()
            for s in ends:
                a.free[s].append(new)
            here = new
        else:
            raise ValueError(f"{label}: unknown tag {kind}")
    if opened or not mandatory:
        raise ValueError(f"{label}: unbalanced optional region, or no mandatory word")
    a.end, a.needed = here, max(mandatory, key=len)
    return a


def places(words: list[bytes], automaton: Automaton) -> Iterator[tuple[int, int]]:
    """(first word, end) of every place where the template matches, overlapping ones too."""
    for w in automaton.first_words():
        i = -1
        while True:
            try:
                i = words.index(w, i + 1)
            except ValueError:
                break
            if (end := automaton.longest(words, i)) > 0:
                yield i, end


_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[:0x30] = _IS_WORD[0x3A:0x61] = _IS_WORD[0x7B:0x80] = False


def _lower_word_counts(texts: pa.Array) -> np.ndarray:
    """Words of each text of a binary array (already lower case or not: A-Z count as letters)."""
    is_word = _IS_WORD.copy()
    is_word[0x41:0x5B] = True
    ends = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
    data = texts.buffers()[2]
    if data is None or ends[-1] == ends[0]:
        return np.zeros(len(texts), np.int64)
    w = is_word[np.frombuffer(data, np.uint8)[ends[0]: ends[-1]]]
    starts = w.copy()
    starts[1:] &= ~w[:-1]
    off = ends - ends[0]
    inner = off[:-1][off[:-1] < len(w)]
    starts[inner] = w[inner]
    sums = np.concatenate([[0], np.cumsum(starts)])
    return sums[off[1:]] - sums[off[:-1]]


SCHEMA = ("key {key}, n_words long, matches array<struct<label:string,first_word:long,end_word:long>>")


def scan_licenses(docs: DataFrame, templates: dict[str, str], key: str = "doc_id", text: str | Column = "text") -> DataFrame:
    """(key, n_words, matches) per row: every place of every template, as label, first word and end word.

    NULL and empty texts have no word and no match; repeated rows are scanned as
    rows of their own; a NULL key is kept; other columns are not read."""
    t = F.col(text) if isinstance(text, str) else text
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(t, F.lit("")).cast("binary").alias("text"))
    autos = [compile_template(k, v) for k, v in templates.items()]
    schema = SCHEMA.format(key=rows.schema["key"].dataType.simpleString())
    match_type = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x.slice(c.start, c.stop - c.start) for x in batches for c in byte_chunks(x.column("text"))):
            texts = b.column("text")
            counts, found = _lower_word_counts(texts), []
            for value in texts:
                low = value.as_py().lower()
                hits = [a for a in autos if a.needed in low]
                words = re.findall(WORD, low) if hits else []
                found.append([{"label": a.label, "first_word": i, "end_word": end} for a in hits for i, end in sorted(places(words, a))])
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(counts), pa.array(found, match_type)],
                                             names=["key", "n_words", "matches"])

    return rows.mapInArrow(scan, schema)
