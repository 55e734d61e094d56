"""Each stage of the pipeline on its own input, and on awkward rows and empty tables."""

import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from visitlens.llm import near_dups


@pytest.fixture(scope="module")
def inputs(spark, data, tmp_path_factory):
    docs, out = spark.read.parquet(f"{data}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / f"{name}.parquet")
        stage(spark, docs, data).write.parquet(path)
        out.append((docs, spark.read.parquet(path)))
        docs = out[-1][1]
    return out


def test_columns_stay(inputs):
    for before, after in inputs[:-1]:
        assert after.columns == inputs[0][0].columns


def test_languages_keep_clean_documents(inputs):
    before, after = inputs[0]
    assert after.count() >= 0.99 * before.count()


def test_copies_go(inputs):
    before, after = inputs[1]
    lower = lambda t: t.encode().lower()
    best = {}
    for r in before.collect():
        best[lower(r["text"])] = max(best.get(lower(r["text"]), -1), r["doc_id"])
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(best.values())


def test_near_copies_go(inputs):
    before, after = inputs[2]
    classes = near_dups.classes(before).collect()
    assert sorted(r["doc_id"] for r in after.collect()) == sorted({r["class_id"] for r in classes})


def test_mix_is_about_half_as_large_again(inputs):
    before, after = inputs[3]
    size = lambda df: sum(len(r["text"].encode().split()) for r in df.collect())
    assert 1.3 * size(before) <= size(after) <= 1.8 * size(before)


def test_tokens(inputs):
    before, after = inputs[4]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = sorted((r["doc_id"], len(library.encode(r["text"]))) for r in before.collect())
    assert sorted((r["doc_id"], r["n_tokens"]) for r in after.collect()) == want


def test_awkward_rows_and_empty_tables(spark, docs, empty, data):
    """Nulls, ties, repeated rows and clashing names: whole rows of every stage are read and held against its input."""
    key = lambda r: (r["doc_id"], r["text"])
    stages = dict(corpus_pipeline.STAGES)
    rows = [r.asDict() for r in docs.collect()]
    letters = [r for r in rows if any(c.isalpha() for c in r["text"] or "")]
    got = {name: [r.asDict() for r in stages[name](spark, docs, data).collect()] for name in stages}
    for name in list(stages)[:-1]:
        assert all(r in rows for r in got[name]), name
    assert all(r in letters for r in got["known_language"])
    lower = lambda r: (r["text"] or "").encode().lower()
    assert sorted(map(lower, got["without_copies"])) == sorted({lower(r) for r in rows})
    classes = {key(r): r["class_id"] for r in docs.join(near_dups.classes(docs).select("doc_id", "class_id").distinct(), "doc_id").collect()}
    assert len({r["doc_id"] for r in got["without_near_copies"]}) >= len(set(classes.values()))
    assert len(got["tokenized"]) == len(rows) and all(r["n_tokens"] == 0 for r in got["tokenized"] if r["doc_id"] in (3, 4))
    for name, stage in stages.items():
        assert stage(spark, empty, data).collect() == [], name
