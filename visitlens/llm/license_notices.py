"""Short licence notices in texts, found with a bounded number of typing errors.

A text is lower-cased (A-Z only) and reduced to its words, joined by single spaces. A notice of which at
most k characters may differ is cut into k + 1 pieces: wherever it occurs, one piece at least is intact
(pigeonhole). One automaton over the pieces of all notices walks each text once; around every hit a
window that holds any possible occurrence is searched with the ``regex`` library's bounded-error
matching, which keeps the key words of a notice (``*mit*``) exact, and reports edits and span.

What is found: inside a window the match of fewest edits is taken first, then what lies left and right of
it. So a notice is found in a text if and only if some run of whole words lies within its number of edits.
Phrases that must match exactly (``BASE``) are notices of no edits: every place is reported.

Defined cases: a null or empty text has no words and no finds; equal rows are treated alike; other
columns are carried in the struct ``doc`` and cannot clash; an empty table gives an empty one. Whole texts
are searched, however long: windows are cut into overlapping blocks, so the cost of a place is bounded.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from visitlens.llm.common import on_workers

#: One edit is allowed for so many characters of a notice.
CHARS_PER_EDIT = 10
#: A block holds about so many times the longest occurrence of its notice.
BLOCK = 8

# Phrases that count only as they stand, with their labels.
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

# Short notices as their licences recommend them; words in asterisks allow no edit.
NOTICES = (
    ("agpl-3", "gnu affero general public license version *3*"),
    ("apache-2", "licensed under the *apache* license version *2*"),
    ("apache-2", "apache license version *2* *0*"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "released under the *bsd* license"),
    ("cc-by", "creative commons attribution *4* *0* international license"),
    ("cc-by", "licensed under *cc* *by* *4* *0*"),
    ("cc-by-nc", "creative commons attribution noncommercial *4* *0* international license"),
    ("cc-by-nc", "licensed under *cc* *by* *nc*"),
    ("cc-by-sa", "creative commons attribution sharealike *4* *0* international license"),
    ("cc-by-sa", "licensed under *cc* *by* *sa*"),
    ("gpl-2", "gnu general public license version *2*"),
    ("gpl-3", "gnu general public license version *3*"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose"),
    ("lgpl-2", "gnu lesser general public license version *2*"),
    ("lgpl-3", "gnu lesser general public license version *3*"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "released under the *mit* license"),
    ("mit", "under the *mit* license"),
    ("mpl-2", "mozilla public license version *2* *0*"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)

_TO_SPACES = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_LOWER = {c: c + 32 for c in range(65, 91)}
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

FOUND = (
    "array<struct<label: string, notice: string, exact: boolean, edits: int, score: double,"
    " first_word: bigint, n_words: bigint, begin: bigint, end: bigint>>"
)


@dataclass(frozen=True)
class Notice:
    """A notice: its label, its words (key words in asterisks), and the edits it allows."""

    label: str
    marked: str
    edits: int

    @property
    def text(self) -> str:
        return self.marked.replace("*", "")

    def pattern(self) -> str:
        """Key words with the spaces around them match as they are, everything between within the edits."""
        parts = re.split(r"( ?(?:\*[^*]+\*)(?: \*[^*]+\*)* ?)", self.marked)
        keys = [re.escape(p.replace("*", "")) if "*" in p else f"(?:{re.escape(p)}){{e<={self.edits}}}" for p in parts if p]
        return "(?b)(?<= )" + "".join(keys) + "(?= )"

    def pieces(self) -> list[tuple[int, str]]:
        """``edits + 1`` pieces of about equal length, with their places."""
        cuts = [len(self.text) * i // (self.edits + 1) for i in range(self.edits + 2)]
        return [(a, self.text[a:b]) for a, b in zip(cuts, cuts[1:])]


def notices(
    phrases: Iterable[tuple[str, str]] = BASE,
    fuzzy: Iterable[tuple[str, str]] = NOTICES,
    chars_per_edit: int = CHARS_PER_EDIT,
) -> list[Notice]:
    """Exact phrases and notices with an edit for every ``chars_per_edit`` characters."""
    exact = [Notice(label, text, 0) for label, text in phrases]
    return exact + [Notice(label, text, len(text.replace("*", "")) // chars_per_edit) for label, text in fuzzy]


def normalised(text: str | None) -> tuple[str, int]:
    """The words between single spaces, with a space at either end, and their number."""
    words = (text or "").encode("utf-8", "replace").lower().translate(_TO_SPACES).split()
    return f" {b' '.join(words).decode('utf-8', 'replace')} ", len(words)


class Scanner:
    """The automaton over all pieces and the compiled patterns."""

    def __init__(self, wanted: Sequence[Notice]):
        import ahocorasick
        import regex

        self.notices = list(wanted)
        self.patterns = [regex.compile(n.pattern()) for n in self.notices]
        places: dict[str, list[tuple[int, int]]] = {}
        for i, notice in enumerate(self.notices):
            for offset, piece in notice.pieces():
                places.setdefault(piece, []).append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()
        self.empty = not places

    def windows(self, words: str) -> Iterator[tuple[int, int, int]]:
        """(notice, from, to): every possible occurrence lies wholly inside one of them."""
        open_: dict[int, tuple[int, int]] = {}
        for end, (length, where) in self.automaton.iter(words):
            for i, offset in where:
                notice = self.notices[i]
                size, k = len(notice.text), notice.edits
                start = end + 1 - length - offset - k - 1
                stop = start + size + 3 * k + 2
                known = open_.get(i)
                if known and known[0] <= start <= known[1] and stop - known[0] <= BLOCK * (size + 3 * k):
                    open_[i] = (known[0], max(known[1], stop))
                    continue
                if known:
                    yield (i, *known)
                open_[i] = (start, stop)
        for i, known in open_.items():
            yield (i, *known)

    def find(self, words: str) -> list[tuple[int, int, int, int]]:
        """(from, to, notice, edits) in order of place; finds of a notice with edits do not overlap."""
        if self.empty:
            return []
        finds: dict[int, set[tuple[int, int, int]]] = {}
        for i, start, stop in self.windows(words):
            pattern, known = self.patterns[i], finds.setdefault(i, set())
            todo = [(max(start, 0), min(stop, len(words)))]
            if not self.notices[i].edits:
                low, high = todo.pop()
                known.update((0, low + m.start(), low + m.end()) for m in pattern.finditer(words[low:high], overlapped=True))
            while todo:
                low, high = todo.pop()
                match = pattern.search(words[low:high])
                if match is None or (edits := sum(match.fuzzy_counts)) > self.notices[i].edits:
                    continue
                a, b = low + match.start(), low + match.end()
                known.add((edits, a, b))
                todo += [(low, a), (b, high)]
        out = []
        for i, known in finds.items():
            taken: list[tuple[int, int]] = []
            for edits, a, b in sorted(known):
                at = bisect(taken, (a, b))
                clash = at > 0 and taken[at - 1][1] > a or at < len(taken) and taken[at][0] < b
                if self.notices[i].edits == 0 or not clash:
                    taken.insert(at, (a, b))
                    out.append((a, b, i, edits))
        return sorted(out)

    def scan(self, text: str | None) -> tuple[int, list[dict]]:
        """Number of words, and the finds with word and character positions."""
        words, n_words = normalised(text)
        finds = self.find(words)
        if not finds:
            return n_words, []
        spans = [m.span() for m in _WORD.finditer(text.translate(_LOWER))]
        out, at, seen = [], 0, -1
        for a, b, i, edits in finds:
            seen += words.count(" ", at, a)
            at = a
            notice, n = self.notices[i], words.count(" ", a, b) + 1
            out.append(
                {
                    "label": notice.label, "notice": notice.text, "exact": notice.edits == 0, "edits": edits,
                    "score": 1 - edits / len(notice.text), "first_word": seen, "n_words": n,
                    "begin": spans[seen][0], "end": spans[seen + n - 1][1],
                }
            )
        return n_words, out


def scan(docs: DataFrame, wanted: Sequence[Notice] | None = None, carry: Sequence[str] | None = None) -> DataFrame:
    """Per document ``doc`` (its columns, or those of ``carry``), ``n_words`` and the array ``found``."""
    wanted = notices() if wanted is None else list(wanted)
    packed = docs.select(F.struct(*(carry or ["*"])).alias("doc"), F.col("text").alias("text"))
    schema = StructType([packed.schema["doc"], *StructType.fromDDL(f"n_words bigint, found {FOUND}")])

    def rows(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        scanner, kind = Scanner(wanted), to_arrow_type(schema["found"].dataType)
        for batch in batches:
            counts, found = zip(*[scanner.scan(t.as_py()) for t in batch.column("text")]) if len(batch) else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(counts, pa.int64()), pa.array(list(found), kind)], names=["doc", "n_words", "found"]
            )

    return on_workers(packed).mapInArrow(rows, schema)


def digest(docs: DataFrame, wanted: Sequence[Notice] | None = None) -> DataFrame:
    """Per document: words, places and labels of exact phrases, labels of all finds, and the best score."""
    found = F.col("found")
    exact = F.filter(found, lambda x: x["exact"])
    starts = F.transform(exact, lambda x: x["first_word"])
    labels = lambda finds: F.array_join(F.array_sort(F.array_distinct(F.transform(finds, lambda x: x["label"]))), ",")
    return scan(docs, wanted, ["doc_id"]).select(
        F.col("doc.doc_id").alias("doc_id"),
        "n_words",
        F.size(exact).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(exact).alias("base_labels"),
        labels(found).alias("labels"),
        F.coalesce(F.array_max(F.transform(found, lambda x: x["score"])), F.lit(0.0)).alias("score"),
        F.size(found).cast("bigint").alias("n_found"),
    )
