"""License scan: exact phrases, and short notices found in spite of a few edits.

A notice with at most k edits holds at least one of its k + 1 pieces unchanged.
All pieces of all notices are looked up in one pass of an Aho-Corasick automaton;
around each hit the regex library's bounded-error matching looks for the best
match of the whole notice.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import extend, map_texts, plus
from .memo import per_process

#: Phrases whose words must stand as they are, with their labels: fixed values.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Label and short notice, as words. Words in capitals name the license or its version: they must be there unchanged.
NOTICES = (
    ("mit", "released under the MIT license"),
    ("mit", "licensed under the MIT license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "licensed under the APACHE license version 2 0"),
    ("gpl-2", "gnu GENERAL public license version 2"),
    ("gpl-3", "gnu GENERAL public license version 3"),
    ("lgpl-2.1", "gnu LESSER general public license version 2 1"),
    ("lgpl-3", "gnu LESSER general public license version 3"),
    ("agpl-3", "gnu AFFERO general public license version 3"),
    ("mpl-2", "subject to the terms of the MOZILLA public license v 2 0"),
    ("epl-2", "made available under the terms of the ECLIPSE public license 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc0", "to the public domain under CC0 1 0 universal"),
    ("cc-by", "licensed under CC BY 4 0"),
    ("cc-by-sa", "licensed under CC BY SA 4 0"),
    ("cc-by-nc", "licensed under CC BY NC 4 0"),
    ("cc-by-nc-sa", "licensed under CC BY NC SA 4 0"),
    ("cc-by-nd", "licensed under CC BY ND 4 0"),
    ("cc-by", "creative commons ATTRIBUTION 4 0 international license"),
    ("cc-by-sa", "creative commons attribution SHAREALIKE 4 0 international license"),
    ("cc-by-nc", "creative commons attribution NONCOMMERCIAL 4 0 international license"),
    ("proprietary", "all rights reserved"),
    ("proprietary", "unauthorized copying of this file via any medium is strictly prohibited"),
)
#: Characters of a notice, its outer spaces included, for each edit that it may have.
CHARS_PER_EDIT = 12

_FOLD = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def fold(text: str) -> tuple[str, int]:
    """The words with A-Z lower-cased, one space before, between and after them, and their number."""
    words = text.encode().translate(_FOLD).split()
    return (b" " + b" ".join(words) + b" ").decode() if words else " ", len(words)


class Notice:
    """A notice as it stands in folded text, the edits it may have, and its pieces as (offset, piece)."""

    def __init__(self, label: str, text: str, chars_per_edit: int):
        import regex

        self.label, self.keys = label, {w.lower() for w in text.split() if w.isupper() or w.isdigit()}
        self.text = f" {text.lower()} "
        self.edits = max(1, len(self.text) // chars_per_edit)
        cuts = [len(self.text) * i // (self.edits + 1) for i in range(self.edits + 2)]
        self.pieces = [(a, self.text[a:b]) for a, b in zip(cuts, cuts[1:])]
        self.pattern = regex.compile(f"(?b)(?:{regex.escape(self.text, literal_spaces=True)}){{e<={self.edits}}}")


class Scanner:
    """Finds notices in folded text. Made once a worker."""

    def __init__(self, notices=NOTICES, chars_per_edit: int = CHARS_PER_EDIT):
        import ahocorasick

        self.notices = [Notice(*n, chars_per_edit) for n in notices]
        held: dict[str, list[tuple[int, int]]] = {}
        for i, notice in enumerate(self.notices):
            for at, piece in notice.pieces:
                held.setdefault(piece, []).append((i, at + len(piece) - 1))
        self.seeds = ahocorasick.Automaton()
        for piece, found in held.items():
            self.seeds.add_word(piece, found)
        self.seeds.make_automaton()

    def candidates(self, folded: str) -> dict[int, list[int]]:
        """By notice: where it would start, by its unchanged pieces, in order."""
        found: dict[int, set[int]] = {}
        for end, uses in self.seeds.iter(folded):
            for i, back in uses:
                found.setdefault(i, set()).add(end - back)
        return {i: sorted(starts) for i, starts in found.items()}

    def matches(self, folded: str) -> list[tuple[int, int, int, int]]:
        """(start, end, notice, edits) of the best match around each candidate; those of one notice do not overlap."""
        out = []
        for i, starts in self.candidates(folded).items():
            notice, best = self.notices[i], []
            for start in starts:
                m = notice.pattern.search(folded, max(0, start - notice.edits), min(len(folded), start + len(notice.text) + notice.edits))
                if m is None:
                    continue
                hit = (m.start(), m.end(), i, sum(m.fuzzy_counts))
                if best and hit[0] < best[-1][1] - 1:  # neighbours may share the space between them
                    if hit[3] < best[-1][3]:
                        best[-1] = hit
                else:
                    best.append(hit)
            out += best
        return sorted(out)

    def find(self, folded: str) -> list[tuple[int, int, str, int, float]]:
        """(start, end, label, edits, score) of matches with all their key words; of overlapping ones the one with the greatest score, then the longest, then the first."""
        good = []
        for start, end, i, edits in self.matches(folded):
            notice = self.notices[i]
            if notice.keys <= set(folded[start:end].split()):
                good.append((start, end, notice.label, edits, 1.0 - edits / len(notice.text)))
        kept: list[tuple] = []
        group: list[tuple] = []
        reach = -1
        for hit in [*good, None]:
            if hit is None or hit[0] >= reach - 1:
                # matches that hang together: best first, each that overlaps no better one
                taken: list[tuple] = []
                for h in sorted(group, key=lambda h: (-h[4], h[0] - h[1], h[0], h[2])):
                    at = bisect_left(taken, h)
                    if (at == 0 or h[0] >= taken[at - 1][1] - 1) and (at == len(taken) or taken[at][0] >= h[1] - 1):
                        taken.insert(at, h)
                kept += taken
                group, reach = [], -1
            if hit:
                group.append(hit)
                reach = max(reach, hit[1])
        return kept


def base_places(folded: str, phrases: dict[str, str]) -> list[tuple[int, int, str]]:
    """(start, end, label) in folded text of every place where a phrase's words stand one after the other, in order."""
    out = []
    for phrase, label in phrases.items():
        sought = f" {phrase} "
        at = folded.find(sought)
        while at >= 0:
            out.append((at, at + len(sought), label))
            at = folded.find(sought, at + 1)
    return sorted(out)


class _Places:
    """Word numbers of rising places in folded text."""

    def __init__(self, folded: str):
        self.folded, self.at, self.n = folded, 0, 0

    def __call__(self, at: int) -> int:
        """The number of the word that holds the character before `at` or, at a space, the word after it."""
        self.n += self.folded.count(" ", self.at, at)
        self.at = at
        return self.n


def _judge(text: str | None, scanner: Scanner, phrases: dict[str, str]) -> dict:
    import regex

    folded, n_words = fold(text or "")
    base, near = base_places(folded, phrases), scanner.find(folded)
    spans = [(s, e, label, 0, 1.0, True) for s, e, label in base] + [(*h, False) for h in near]
    if not spans:
        return {"n_words": n_words, "n_base": 0, "first_word": None, "last_word": None, "base_labels": "", "labels": "", "score": 0.0, "notices": []}
    spans.sort(key=lambda s: (s[0], s[1], s[2], not s[5]))
    edges = {s if folded[s] != " " else s + 1 for s, *_ in spans} | {e if folded[e - 1] != " " else e - 1 for _, e, *_ in spans}
    place = _Places(folded)
    number = {at: place(at) - 1 for at in sorted(edges)}
    wanted, where = set(number.values()), {}
    for k, m in enumerate(regex.finditer(_WORD, text)):
        if k in wanted:
            where[k] = m.span()
    notices = []
    for s, e, label, edits, score, is_base in spans:
        a, b = number[s if folded[s] != " " else s + 1], number[e if folded[e - 1] != " " else e - 1]
        notices.append({"label": label, "start": where[a][0], "end": where[b][1], "first_word": a, "last_word": b, "edits": edits, "score": score, "base": is_base})
    starts = [n["first_word"] for n in notices if n["base"]]
    return {
        "n_words": n_words,
        "n_base": len(starts),
        "first_word": min(starts, default=None),
        "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted({n["label"] for n in notices if n["base"]})),
        "labels": ",".join(sorted({n["label"] for n in notices})),
        "score": max(n["score"] for n in notices),
        "notices": notices,
    }


_NOTICE = "struct<label: string, start: long, end: long, first_word: long, last_word: long, edits: int, score: double, base: boolean>"
_FIELDS = f"n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, notices array<{_NOTICE}>"
_ARROW = {
    "n_words": pa.int64(),
    "n_base": pa.int64(),
    "first_word": pa.int64(),
    "last_word": pa.int64(),
    "base_labels": pa.string(),
    "labels": pa.string(),
    "score": pa.float64(),
    "notices": pa.list_(
        pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int32()), ("score", pa.float64()), ("base", pa.bool_())])
    ),
}


def scan_licenses(docs: DataFrame, text_col: str = "text", notices=NOTICES, phrases: dict[str, str] | None = None, chars_per_edit: int = CHARS_PER_EDIT) -> DataFrame:
    """All columns of docs with n_words, n_base, first_word, last_word, base_labels, labels, score and `notices`.

    `notices` lists every place: label, code points of the whole words it covers
    (end exclusive), numbers of its first and last word, edits, score (one less
    the edits over the notice's length; a base place has 1) and whether it is a
    base phrase. A notice may have one edit for each `chars_per_edit` of its
    characters, but its key words must stand. n_base, first_word and last_word
    count base places alone; the document's score is its best place's, 0 without
    one. Whole texts are read; a null text has no words; repeated rows get equal
    results; an empty table stays empty; columns already named so are replaced.
    """
    names, sought = docs.columns, dict(BASE if phrases is None else phrases)
    key = f"notice scanner {hash((tuple(notices), chars_per_edit))}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = per_process(key, lambda: Scanner(notices, chars_per_edit))
        for batch in batches:
            found = [_judge(t.as_py(), scanner, sought) for t in batch.column(names.index(text_col))]
            yield extend(batch, names, {c: pa.array([f[c] for f in found], t) for c, t in _ARROW.items()})

    return map_texts(docs, run, plus(docs.schema, _FIELDS))
