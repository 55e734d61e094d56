"""Alignment of tokenizers against brute force over the libraries' own tokens."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest

from visitlens.llm import alignment as al

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(FILES[0])
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=FILES[1])


def _tokens(text, libraries):
    """(id, bytes) of either tokenizer, or None where the bytes differ from space + text."""
    first, second = libraries
    if not text:
        return None
    alphabet = al.byte_alphabet()
    a = [(i, bytes(alphabet[c] for c in first.id_to_token(i))) for i in first.encode(f" {text}", add_special_tokens=False).ids]
    b = []
    for i in second.encode(text):
        piece = second.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = b" " + text.encode()
    return (a, b) if all(b"".join(x for _, x in side) == whole for side in (a, b)) else None


def _spans(tokens):
    at, out = 0, []
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def _brute(texts, libraries):
    sides = [_tokens(t, libraries) for t in texts]
    links, groups = [], []
    for side in sides:
        if side is None:
            links.append([])
            groups.append(None)
            continue
        a, b = map(_spans, side)
        found, start = [], 0
        for x, lo, hi in a:
            while start < len(b) and b[start][2] <= lo:
                start += 1
            j = start
            while j < len(b) and b[j][1] < hi:
                found.append((x, b[j][0]))
                j += 1
        links.append(found)
        cuts = {hi for _, _, hi in a} & {hi for _, _, hi in b}
        parts = []
        rest = [list(a), list(b)]
        for side_ in rest:
            side_.reverse()
        for cut in sorted(cuts):
            ids = [[], []]
            for taken, side_ in zip(ids, rest):
                while side_ and side_[-1][2] <= cut:
                    taken.append(str(side_.pop()[0]))
            parts.append("|".join(",".join(taken) for taken in ids))
        groups.append(parts)
    count = Counter(p for found in links for p in found)
    highest = Counter()
    for (_, y), n in count.items():
        highest[y] = max(highest[y], n)
    out = []
    for side, found, parts in zip(sides, links, groups):
        if side is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        digest = hashlib.sha256(";".join(parts).encode()).hexdigest()
        best = sum(count[p] == highest[p[1]] for p in found)
        out.append((len(side[0]), len(side[1]), len(parts), len(found), best, sum(count[p] for p in found), digest))
    return out


TEXTS = [
    None, "", " ", "a", "  two  spaces\n\nand\tlines ", "naïve café 漢字 😀 ß́ end", "▁ mark", "a▁b", "\x00\x01 nul", "<|endoftext|> </s> <s> <unk>",
    "Hello world, don't stop: it's 12345.67!", "x" * 3_000, " " * 6_000 + "b", "\n" * 2_500, "Hello world, don't stop: it's 12345.67!", "tail   sep nb　wide",
    "ab c " * 4_000, "Straße " * 50, "\r\n\r\n", "﻿bom", "é́́", "Hello world, don't stop: it's 12345.67!",
]


def _random(n, seed):
    rng = random.Random(seed)
    letters = "etaoinshrdlu ETAOIN  .,'\n0123456789éß漢😀▁-_"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 120))) for _ in range(n)]


def _aligned(spark, texts):
    rows = [(i, t, "k", 1, "p") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, copies long, pair string")
    return [tuple(r)[1:] for r in sorted(al.digest(docs, *FILES).collect())]


def test_equals_brute_force(spark, libraries):
    texts = TEXTS + _random(120, 4) + TEXTS[4:12]
    assert _aligned(spark, texts) == _brute(texts, libraries)


def test_chunks_and_copies_do_not_matter(spark, libraries):
    texts = _random(60, 6) + ["one text with very many copies"] * 90 + [None] * 80
    rows = [(i, t, "k") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    out, counts = al.align(docs, *FILES, chunk_bytes=200)
    names = [*al.MEASURES, "n_best", "count_sum", "groups_sha256"]
    got = [tuple(r[n] or 0 for n in names[:-1]) for r in sorted(out.collect(), key=lambda r: r["doc_id"])]
    assert got == [w[:-1] for w in _brute(texts, libraries)]
    assert counts.agg({"total": "sum"}).first()[0] == sum(w[3] for w in _brute(texts, libraries))


def test_fast_and_slow_encoders_agree(libraries):
    tokens = al.ByteTokens(FILES[0])
    assert tokens.fast is not None
    for text in [t for t in TEXTS if t] + _random(300, 9) + [f" a{chr(c)}b 1{chr(c)} .{chr(c)}" for c in range(0x20, 0x3000, 7)]:
        assert tokens.encode(f" {text}") == libraries[0].encode(f" {text}", add_special_tokens=False).ids


def test_empty_table_and_awkward_rows(spark, docs, empty, libraries):
    assert al.digest(empty, *FILES).count() == 0
    got = sorted((tuple(r) for r in al.digest(docs, *FILES).collect()), key=repr)
    source = docs.select("doc_id", "text").collect()
    want = _brute([r.text for r in source], libraries)
    assert got == sorted(((r.doc_id, *w) for r, w in zip(source, want)), key=repr)
