"""Licence notices against brute force: exact phrases by words, edits by dynamic programming."""

import random
import re

import pytest

from visitlens.llm import license_notices as ln

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
FAR = 99


def _edits(notice, span):
    """Edits between a notice and a run of words, with its key words untouched."""
    parts = re.split(r"( ?(?:\*[^*]+\*)(?: \*[^*]+\*)* ?)", notice.marked)
    letters = [(c, "*" in p, "*" in p and i > 0) for p in parts for i, c in enumerate(p.replace("*", ""))]
    row = [j if not letters[0][1] else (0 if j == 0 else FAR) for j in range(len(span) + 1)]
    for i, (c, exact, _) in enumerate(letters, 1):
        inner = i < len(letters) and letters[i][2]
        new = []
        for j in range(len(span) + 1):
            best = row[j] + (FAR if exact else 1)
            if j:
                best = min(best, row[j - 1] + (0 if c == span[j - 1] else FAR if exact else 1))
                best = min(best, new[j - 1] + (FAR if inner else 1))
            new.append(min(best, FAR))
        row = new
    return row[-1]


def _brute(text, notices):
    words = [w.group() for w in WORD.finditer((text or "").translate(LOWER))]
    labels = set()
    for notice in notices:
        sizes = range(1, len(notice.text.split()) + notice.edits + 1)
        spans = (" ".join(words[i : i + n]) for i in range(len(words)) for n in sizes if i + n <= len(words))
        fitting = (s for s in spans if abs(len(s) - len(notice.text)) <= notice.edits)
        if any(_edits(notice, s) <= notice.edits for s in fitting):
            labels.add(notice.label)
    return len(words), labels


def _damaged(rng, text, edits):
    letters = list(text)
    for _ in range(edits):
        i, kind = rng.randrange(len(letters)), rng.randrange(3)
        if kind == 0:
            letters[i] = rng.choice("abelrst -.")
        elif kind == 1:
            del letters[i]
        else:
            letters.insert(i, rng.choice("abelrst -."))
    return "".join(letters)


def test_labels_equal_brute_force():
    rng = random.Random(5)
    wanted = ln.notices()
    scanner = ln.Scanner(wanted)
    found = 0
    for _ in range(250):
        marked = rng.choice(wanted).text
        filler = " ".join(rng.choice(["the", "license", "under", "mit", "released", "gnu", "and", "2", "version"]) for _ in range(5))
        text = f"{filler}. {_damaged(rng, marked.title(), rng.randrange(8))}; {filler}"
        n_words, finds = scanner.scan(text)
        assert (n_words, {f["label"] for f in finds}) == _brute(text, wanted), text
        found += bool(finds)
    assert 80 < found < 250


def test_least_edits_and_spans():
    text = "Zz. Relesed under the\tMIT  Licence! Under the MIT license, then; released under the MIT license"
    scanner = ln.Scanner(ln.notices())
    _, finds = scanner.scan(text)
    whole = [f for f in finds if f["notice"] == "released under the mit license"]
    assert [(f["edits"], text[f["begin"] : f["end"]], f["first_word"], f["n_words"]) for f in whole] == [
        (2, "Relesed under the\tMIT  Licence", 1, 5),
        (0, "released under the MIT license", 11, 5),
    ]
    assert sum(f["exact"] for f in finds) == 2
    assert scanner.scan("released under the BIT license")[1] == []


def test_repeated_places_and_long_texts():
    scanner = ln.Scanner(ln.notices())
    text = "cc by nc " * 3_000 + "x" * 50_000 + " under the MIT license"
    n_words, finds = scanner.scan(text)
    assert n_words == 9_005 and sum(f["exact"] for f in finds) == 3_001
    overlapping = ln.Scanner([ln.Notice("a", "a b a", 0)])
    assert [f["first_word"] for f in overlapping.scan("a b a b a")[1]] == [0, 2]
    assert ln.Scanner([]).scan("a b")[1] == []


@pytest.fixture(scope="module")
def awkward(spark):
    line = "Licensed under CC BY-NC 4.0."
    rows = [(1, None, "a"), (2, "", "b"), (3, line, None), (3, line, None), (4, f"É{line} apache license, VERSION 2.0 {line}", "c")]
    rows += [(5, "under the mit LICENSE " + "w " * 60_000 + line, "d"), (None, "Under THE Mit License", None), (6, "undr the mit license", "e")]
    return spark.createDataFrame(rows, "doc_id long, text string, doc string")


def test_base_equals_brute_force(awkward):
    got = sorted((tuple(r)[:6] for r in ln.digest(awkward).collect()), key=repr)
    want = []
    for r in awkward.collect():
        words = [w.group() for w in WORD.finditer((r.text or "").translate(LOWER))]
        places = [(i, label) for label, p in ln.BASE for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        starts = [i for i, _ in places]
        want.append((r.doc_id, len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))))
    assert got == sorted(want, key=repr)


def test_other_columns_and_empty_tables(spark, awkward, docs, empty):
    out = ln.scan(awkward)
    assert out.columns == ["doc", "n_words", "found"] and out.select("doc.*").columns == awkward.columns
    assert ln.digest(empty).count() == 0
    assert ln.digest(docs).count() == docs.count()
    scores = {r.doc_id: (r.labels, r.score) for r in ln.digest(awkward).collect()}
    assert scores[1] == ("", 0.0) and scores[4] == ("apache-2,cc-by-nc", 1.0) and 0 < scores[6][1] < 1
