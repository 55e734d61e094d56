"""SentencePiece BPE encoding with a table of last tokens, and decoding.

Every prefix of a text has exactly one last token in its BPE encoding. An automaton over the
pieces gives all pieces that end at a position; the one whose predecessor (the last token of
the prefix before it) and itself stay apart when merged side by side is that last token. Ids
are then read backwards from the end, so encoding takes one pass.

Two neighbouring tokens stay apart unless, at some time of the merging, the piece at the end of
the left one and the piece at the start of the right one can merge at a better rank than
either of them merges inward. On equal ranks the place further left wins.

No piece of the model has a word mark behind another character, so a text is cut in front of
word marks (and around line breaks if no piece holds one) and the parts are remembered in a bounded
memory; results do not depend on it.

Defined cases: a null text is empty and has no ids; characters outside the vocabulary become
bytes; equal rows are treated alike; other columns are ignored or, in ``encode``, kept.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from visitlens.llm.common import on_workers

MARK = "▁"
REMEMBERED = 300_000
PAIRS = 300_000
NEVER = 1 << 60
UNKNOWN = " ⁇ "


class PieceModel:
    """The vocabulary of a model file and the merge rules that follow from it."""

    def __init__(self, model_file: str):
        import ahocorasick
        import sentencepiece

        reader = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.text: list[str] = [reader.id_to_piece(i) for i in range(reader.get_piece_size())]
        special = {i for i in range(len(self.text)) if reader.is_control(i) or reader.is_unknown(i)}
        self.byte_of = {i: int(self.text[i][3:5], 16) for i in range(len(self.text)) if reader.is_byte(i)}
        self.id_of_byte = {b: i for i, b in self.byte_of.items()}
        self.silent = {i for i in special if reader.is_control(i)}
        usable = [i for i in range(len(self.text)) if i not in special and i not in self.byte_of and not reader.is_unused(i)]
        self.ids = {self.text[i]: i for i in usable}
        self.plain = {i: self.text[i].replace(MARK, " ") for i in usable}
        order = sorted(usable, key=lambda i: -reader.get_score(i))
        self.rank = {self.text[i]: r for r, i in enumerate(order)}
        # what stands at either end of a piece while it forms, with the rank of its merge inward
        self.left_spine: dict[str, list[tuple[str, int]]] = {}
        self.right_spine: dict[str, list[tuple[str, int]]] = {}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if self._derive(piece):
                self.automaton.add_word(piece, (i, len(piece), piece))
        self.automaton.make_automaton()
        marked = [p for p in self.ids if MARK in p.lstrip(MARK)]
        broken = [p for p in self.ids if "\n" in p]
        if marked:
            self.parts = re.compile(r"(?s).+")
        elif broken:
            self.parts = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        else:
            self.parts = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
        self.apart: dict[int, bool] = {}  # by pair of ids
        self.known = Known(self)

    def _derive(self, piece: str) -> bool:
        """Merge the characters of a piece; keep what stood at its ends over time. False if it never forms."""
        symbols, left, right = list(piece), [piece[0]], [piece[-1]]
        while len(symbols) > 1:
            pairs = [(self.rank.get(a + b, NEVER), k) for k, (a, b) in enumerate(zip(symbols, symbols[1:]))]
            best, k = min(pairs)
            if best == NEVER:
                return False
            symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
            if symbols[0] != left[-1]:
                left.append(symbols[0])
            if symbols[-1] != right[-1]:
                right.append(symbols[-1])
        self.left_spine[piece] = list(zip(left, [*(self.rank[p] for p in left[1:]), NEVER]))
        self.right_spine[piece] = list(zip(right, [*(self.rank[p] for p in right[1:]), NEVER]))
        return True

    def _test_apart(self, ends: list[tuple[str, int]], starts: list[tuple[str, int]]) -> bool:
        rank, i, j = self.rank, 0, 0
        left, inward_left = ends[0]
        right, inward_right = starts[0]
        while True:
            across = rank.get(left + right, NEVER)
            if across < inward_left and across <= inward_right:
                return False
            if inward_left <= inward_right:
                if inward_left == NEVER:
                    return True
                i += 1
                left, inward_left = ends[i]
            else:
                j += 1
                right, inward_right = starts[j]

    def encode_part(self, part: str) -> list[int]:
        last: list[tuple[int, int, str] | None] = [None] * len(part)
        apart, size = self.apart, len(self.text)
        for end, match in self.automaton.iter(part):
            if last[end] is not None:  # there is only one
                continue
            begin = end - match[1]
            before = last[begin] if begin >= 0 else None  # also None behind a character without a piece
            if before is not None:
                key = before[0] * size + match[0]
                stays = apart.get(key)
                if stays is None:
                    stays = apart[key] = self._test_apart(self.right_spine[before[2]], self.left_spine[match[2]])
                if not stays:
                    continue
            last[end] = match
        if len(apart) > PAIRS:
            apart.clear()
        ids: list[int] = []
        at = len(part) - 1
        while at >= 0:
            match = last[at]
            if match is None:
                ids += [self.id_of_byte[b] for b in reversed(part[at].encode("utf-8", "replace"))]
                at -= 1
            else:
                ids.append(match[0])
                at -= match[1]
        ids.reverse()
        return ids

    def decode_ids(self, ids: list[int]) -> str:
        """Text of ids without the leading word mark's space being removed."""
        try:
            return "".join([self.plain[i] for i in ids])
        except KeyError:  # bytes or special ids
            pass
        out, raw = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                continue
            if raw:
                out.append(bytes_to_text(raw))
                raw = bytearray()
            if i not in self.silent:
                out.append(self.plain.get(i, UNKNOWN))
        if raw:
            out.append(bytes_to_text(raw))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        text = self.decode_ids(ids)
        return text.removeprefix(" ") if ids and self.text[ids[0]].startswith(MARK) else text

    def both(self, text: str) -> tuple[str, str, int]:
        """Ids joined by commas, decoded text, number of ids."""
        if not text:
            return "", "", 0
        parts = self.parts.findall(MARK + text.replace(" ", MARK))
        ids, texts = zip(*map(self.known.__getitem__, parts))
        joined = ",".join(ids)
        return joined, "".join(texts).removeprefix(" "), joined.count(",") + 1


class Known(dict):
    """Ids, joined, and decoded text of parts, remembered up to a bound."""

    def __init__(self, model: PieceModel):
        super().__init__()
        self.model = model

    def __missing__(self, part: str) -> tuple[str, str]:
        ids = self.model.encode_part(part)
        value = (",".join(map(str, ids)), self.model.decode_ids(ids))
        if len(part) <= 64:
            if len(self) > REMEMBERED:
                self.clear()
            self[part] = value
        return value


def bytes_to_text(raw: bytearray) -> str:
    """UTF-8, with one replacement character for each byte that is not part of a character."""
    out, at = [], 0
    while at < len(raw):
        for n in range(1, 5):
            try:
                out.append(raw[at : at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


@lru_cache(maxsize=2)
def load(model_file: str) -> PieceModel:
    return PieceModel(model_file)


def _others(docs: DataFrame, name: str, read: str = "text") -> list[str]:
    """All columns but the one to be made, which may not be the one that is read."""
    if name == read:
        raise ValueError(f"{name} is read and cannot be replaced")
    return [f"`{c}`" for c in docs.columns if c != name]


def encode(docs: DataFrame, model_file: str, name: str = "ids") -> DataFrame:
    """The documents with an array of ids, null texts with an empty one; a column of that name is replaced."""
    docs = docs.select(*_others(docs, name))

    def add(batches):
        model = load(model_file)
        for pdf in batches:
            ids = [[int(x) for x in model.both(t or "")[0].split(",") if x] for t in pdf["text"]]
            yield pdf.assign(**{name: ids})

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return on_workers(docs).mapInPandas(add, f"{columns}, `{name}` array<int>")


def decode(docs: DataFrame, model_file: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """The rows with the text of an array of ids, null ids with a null text; a column of that name is replaced."""
    docs = docs.select(*_others(docs, name, ids))

    def add(batches):
        model = load(model_file)
        for pdf in batches:
            texts = [None if i is None else model.decode([int(x) for x in i]) for i in pdf[ids]]
            yield pdf.assign(**{name: pd.Series(texts, dtype=object)})

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return on_workers(docs).mapInPandas(add, f"{columns}, `{name}` string")


def digest(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, n_tokens and the hashes of ids and decoded text."""

    def rows(batches):
        model = load(model_file)
        for batch in batches:
            counts, ids, decoded = [], [], []
            for scalar in batch.column("text"):
                joined, text, n = model.both(scalar.as_py() or "")
                counts.append(n)
                ids.append(hashlib.sha256(joined.encode()).hexdigest())
                decoded.append(hashlib.sha256(text.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return on_workers(docs).select("doc_id", "text").mapInArrow(rows, schema)
