"""License scans: fuzzy search for short notices.

A notice may occur with a few edits. Cut into one piece more than the edits allowed, at least one piece
must occur unchanged (pigeonhole), so an exact search for all pieces at once finds every place worth a
look. There the ``regex`` library matches the notice with a bounded number of edits, which verifies the
place and gives its span.
"""

from __future__ import annotations

import bisect
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyload.llm.texts import Words, map_texts


@dataclass(frozen=True)
class Notice:
    """Words in lower case with single blanks, and how many characters of them may be edited."""

    label: str
    words: str
    edits: int = 0

    @property
    def base(self) -> bool:
        return self.edits == 0


# Fixed phrases of the base search.
BASE = (
    Notice("mit", "mit license"),
    Notice("apache", "apache license"),
    Notice("gpl", "general public license"),
)

# Short notices as their publishers word them; about one edit for nine characters.
NOTICES = (
    Notice("mit", "released under the mit license", 3),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 8),
    Notice("apache", "licensed under the apache license version 2 0", 5),
    Notice("gpl", "licensed under the gnu general public license", 5),
    Notice("lgpl", "gnu lesser general public license", 3),
    Notice("agpl", "gnu affero general public license", 3),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification", 8),
    Notice("mpl", "subject to the terms of the mozilla public license", 5),
    Notice("cc-by", "creative commons attribution", 3),
    Notice("cc-by", "licensed under cc by 4 0", 1),
    Notice("cc-by-sa", "licensed under cc by sa", 1),
    Notice("cc-by-nc", "licensed under cc by nc", 1),
    Notice("cc0", "creative commons zero", 2),
    Notice("unlicense", "free and unencumbered software released into the public domain", 6),
    Notice("all-rights-reserved", "all rights reserved", 1),
)

FIELDS = {
    "n_words": "bigint",
    "n_base": "bigint",
    "first_word": "bigint",
    "last_word": "bigint",
    "base_labels": "string",
    "labels": "string",
    "score": "double",
    "spans": "array<struct<label:string,first:bigint,last:bigint,edits:int,base:boolean>>",
}


def seeds(notice: Notice) -> list[tuple[str, int]]:
    """``edits + 1`` pieces of a notice and where they start in it."""
    cuts = np.linspace(0, len(notice.words), notice.edits + 2).round().astype(int)
    return [(notice.words[a:b], int(a)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


class Scanner:
    """Finds notices in one text of words with single blanks."""

    def __init__(self, notices: tuple[Notice, ...]):
        self.notices = notices
        self.patterns = [
            regex.compile(rf"(?<![^ ])(?:{regex.escape(n.words, special_only=True)}){{e<={n.edits}}}(?![^ ])", regex.BESTMATCH if n.edits else 0)
            for n in notices
        ]
        self.seeds = ahocorasick.Automaton()
        places: dict[str, list[tuple[int, int]]] = {}
        for i, notice in enumerate(notices):
            for piece, at in seeds(notice):
                places.setdefault(piece, []).append((i, at))
        for piece, where in places.items():
            self.seeds.add_word(piece, (len(piece), where))
        self.seeds.make_automaton()

    def scan(self, text: str) -> list[tuple[int, int, int, int]]:
        """Matches as (notice, start, end, edits): those of fewest edits first, without any of the same notice that overlap them.

        A piece tells, but for the edits, where its notice starts; only words there are tried, so the time is linear in the text.
        """
        out: list[tuple[int, int, int, int]] = []
        starts: dict[int, set[int]] = {}
        for end, (size, where) in self.seeds.iter(text):
            here = end + 1 - size
            for i, at in where:
                edits = self.notices[i].edits
                if edits:
                    starts.setdefault(i, set()).update(self._word_starts(text, here - at - edits, here - at + edits))
                elif self._apart(text, here, end + 1):
                    out.append((i, here, end + 1, 0))
        for i, tried in starts.items():
            found = [m for s in tried if (m := self._match(i, text, s, len(text)))]
            heapq.heapify(found)
            taken: list[tuple[int, int, int]] = []
            while found:
                edits, start, end = heapq.heappop(found)
                place = bisect.bisect(taken, (start,))
                if place and taken[place - 1][1] > start:
                    continue
                if place == len(taken) or end <= taken[place][0]:
                    taken.insert(place, (start, end, edits))
                elif shorter := self._match(i, text, start, taken[place][0] - 1):
                    heapq.heappush(found, shorter)
            out += [(i, *match) for match in taken]
        return out

    def _match(self, i: int, text: str, start: int, limit: int) -> tuple[int, int, int] | None:
        """The match of fewest edits from ``start`` on as (edits, start, end)."""
        notice = self.notices[i]
        m = self.patterns[i].match(text, start, min(limit, start + len(notice.words) + notice.edits + 1))
        return (sum(m.fuzzy_counts), start, m.end()) if m and self._apart(text, start, m.end()) else None

    @staticmethod
    def _word_starts(text: str, low: int, high: int) -> Iterator[int]:
        low = max(0, low)
        start = low if not low or text[low - 1 : low] == " " else text.find(" ", low, high + 1) + 1
        while low <= start <= high and start < len(text):
            yield start
            low, start = start + 1, text.find(" ", start, high + 1) + 1

    @staticmethod
    def _apart(text: str, start: int, end: int) -> bool:
        return (start == 0 or text[start - 1] == " ") and (end == len(text) or text[end] == " ")


def license_scan(documents: DataFrame, id: str = "doc_id", text: str = "text", base: tuple[Notice, ...] = BASE, notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """For each document: n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    Words are lower-cased runs of digits, letters and characters beyond ASCII, counted from 0. ``base``
    phrases count wherever their words stand one after the other; ``notices`` may be edited and add labels.
    ``spans`` holds all matches in words, the last one included. ``score`` is the share of a notice that its best
    match left unedited: 1 for a base phrase, 0 without any. NULL and empty texts have no words; repeated rows give a row
    each; a NULL id is kept; other columns are not looked at.
    """
    known = base + notices

    def compute(texts: pa.Array) -> list[pa.Array]:
        words, scanner, out = Words(texts), Scanner(known), []
        for row in range(len(texts)):
            first, count = int(words.first[row]), int(words.counts[row])
            body = words.run(first, count)
            found = []
            if matches := scanner.scan(body):
                blanks = np.flatnonzero(np.frombuffer(body.encode("utf-32-le"), np.uint32) == 0x20)
                for i, start, end, edits in matches:
                    left, right = np.searchsorted(blanks, [start, end - 1], side="right").tolist()
                    found.append((known[i].label, left, right, edits, i < len(base), 1 - edits / len(known[i].words)))
            exact = [x for x in found if x[4]]
            starts = [x[1] for x in exact]
            labels = sorted({x[0] for x in found})
            spans = sorted(x[:5] for x in found)
            out.append(
                (count, len(exact), min(starts, default=None), max(starts, default=None), ",".join(sorted({x[0] for x in exact})), ",".join(labels),
                 max((x[5] for x in found), default=0.0), spans)
            )
        span = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("edits", pa.int32()), ("base", pa.bool_())]))
        types = (pa.int64(),) * 4 + (pa.string(), pa.string(), pa.float64(), span)
        return [pa.array([row[i] for row in out], kind) for i, kind in enumerate(types)]

    return map_texts(documents, compute, FIELDS, text, [F.col(f"`{id}`")])
