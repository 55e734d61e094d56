"""Rules, lines, copies, mixing: SQL counterparts on the tables, brute force on awkward rows."""

import hashlib
import math
import random
import re
import string
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from oracle_check import difference
from visitlens.llm import exact_dedup, line_dedup, mixing, quality_rules
from visitlens.llm.queries import ORACLE, QUERIES

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, data, duck, name):
    assert difference(QUERIES[name](spark, data), ORACLE[name], duck) is None


@pytest.mark.parametrize("name", ["op1_quality_rules", "op4_exact_dedup", "op8_line_dedup"])
def test_native_plans_have_no_python(spark, data, name):
    plan = QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()
    for slow in ("Python", "InArrow", "InPandas", "CartesianProduct", "NestedLoopJoin"):
        assert slow not in plan


def _base(text):
    words = WORD.findall(text or "")
    seen = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if seen[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered),
    )


def test_base_counts_equal_brute_force(docs, labels, rows):
    out = quality_rules.digest(docs, labels).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = sorted(((r["doc_id"], *(r[n] for n in names), r["base_failed"]) for r in out), key=repr)
    want = []
    for row in rows:
        counts = _base(row[1])
        want.append((row[0], *counts, counts[0] < 50 or 100 * counts[4] > 50 * counts[0]))
    assert got == sorted(want, key=repr)
    assert not any(r["kept"] and r["base_failed"] for r in out)


def test_rules_find_planted_thresholds(spark):
    rows = []
    for i in range(900):
        bad = int(i % 3 == 0)
        words = [f"w{(i * 31 + k * k) % 5_000}" for k in range(80)]
        if bad:
            words = [w + "!!" for w in words]
        rows.append((i, " ".join(words), bad))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - b) for i, _, b in rows], "doc_id long, quality int")
    out = {r["doc_id"]: r for r in quality_rules.judge(docs, labels).collect()}
    assert all(out[i]["kept"] == (b == 0) for i, _, b in rows)
    stats = quality_rules.statistics(docs)
    learner = quality_rules.RuleLearner(quality_rules.labelled_statistics(stats, labels))
    rules = learner.learn()
    assert len(rules) == 1 and len(rules[0]) == 1
    assert quality_rules.judge(docs, labels.limit(0)).where(~F.col("kept") & ~F.col("base_failed")).isEmpty()


def _brute_rules(rows, settings=quality_rules.Settings()):
    """The same covering over plain lists of (statistics, prune, bad), thresholds at every value."""
    covers = lambda rule, x: all((x[i] > b) == above for i, above, b in rule)
    tally = lambda part: (sum(r[2] for r in part), sum(1 - r[2] for r in part))

    def best(part):
        bad, good = tally(part)
        if not bad or not good:
            return None
        before, found = math.log2(bad / (bad + good)), []
        for i in range(len(quality_rules.STATISTICS)):
            for bound in sorted({r[0][i] for r in part})[:-1]:
                for above in (0, 1):
                    p, n = tally([r for r in part if (r[0][i] > bound) == bool(above)])
                    gain = round(quality_rules.foil_gain(p, n, before), 9)
                    if p + n >= settings.min_covered and gain > 0:
                        found.append(((-gain, i, bound, above), p, n))
        return min(found, default=None)

    rules, rest, growing = [], rows, rows
    while True:
        part, rule, p, n = [r for r in growing if not r[1]], [], 0, 0
        while (found := best(part)) is not None:
            (_, i, bound, above), p, n = found
            rule.append((i, bool(above), bound))
            part = [r for r in part if covers(rule[-1:], r[0])]
            if not n:
                break
        if not rule or p < settings.min_precision * (p + n):
            return rules
        values = []
        for k in range(1, len(rule) + 1):
            bad, good = tally([r for r in rest if r[1] and covers(rule[:k], r[0])])
            values.append((bad - good) / (bad + good) if bad + good else -1.0)
        rule = rule[: values.index(max(values)) + 1]
        growing = [r for r in growing if not covers(rule, r[0])]
        hit = [r for r in rest if covers(rule, r[0])]
        folds = [tally([r for r in hit if r[1] == side]) for side in (True, False)]
        if len(hit) >= settings.min_covered and all(b >= settings.min_precision * (b + g) for b, g in folds):
            rules.append(rule)
            rest = [r for r in rest if not covers(rule, r[0])]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rules_equal_a_brute_force_learner(spark, seed):
    """Few bad rows, ties, several causes of badness and noise; with bins so coarse that all must be searched."""
    rng = random.Random(seed)
    rows = []
    for i in range(600):
        x = [round(rng.gauss(0, 1), 1 if k else 2) for k in range(len(quality_rules.STATISTICS))]
        bad = int(x[0] > 1.3 or (x[1] < -0.5 and x[2] > 0.8) or x[3] > 1.7)
        rows.append((i, *x, bad ^ (rng.random() < 0.004)))
    labelled = spark.createDataFrame(rows, "doc_id long, " + ", ".join(f"{s} double" for s in quality_rules.STATISTICS) + ", bad int")
    learner = quality_rules.RuleLearner(labelled, quality_rules.Settings(bins=4))
    side = {r["doc_id"]: r["p"] for r in labelled.select("doc_id", (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("p")).collect()}
    want = _brute_rules([(r[1:-1], side[r[0]], r[-1]) for r in rows])
    got = learner.learn()
    assert len(want) >= 2
    assert [[(quality_rules.STATISTICS.index(c.statistic), c.above) for c in rule] for rule in got] == [[(i, above) for i, above, _ in rule] for rule in want]
    values = {i: sorted({r[i + 1] for r in rows}) for i in range(len(quality_rules.STATISTICS))}
    for rule, brute in zip(got, want):
        for c, (i, _, bound) in zip(rule, brute):
            after = [v for v in values[i] if v > bound]
            assert c.bound == pytest.approx((bound + after[0]) / 2 if after else bound)


def test_a_rare_defect_is_learned(spark):
    """One bad text in a hundred, told by a statistic that only these rows raise."""
    none = {s: 0.0 for s in quality_rules.STATISTICS}
    rows = [(i, *(none | {"digit_share": 0.5 if i % 100 == 0 else (i % 7) / 100, "log_words": i % 13 / 2}).values(), int(i % 100 == 0)) for i in range(4_000)]
    labelled = spark.createDataFrame(rows, "doc_id long, " + ", ".join(f"{s} double" for s in quality_rules.STATISTICS) + ", bad int")
    (rule,) = quality_rules.RuleLearner(labelled).learn()
    assert [(c.statistic, c.above) for c in rule] == [("digit_share", True)] and 0.06 < rule[0].bound < 0.5


def test_lines_equal_brute_force(docs, rows):
    keys = defaultdict(set)
    name = lambda i: -(1 << 63) if i is None else i
    clean = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    for row in rows:
        for line in (row[1] or "").split("\n"):
            if len(clean(line)) >= 20:
                keys[clean(line)].add(name(row[0]))
    want = []
    for row in rows:
        lines = (row[1] or "").split("\n")
        stay = [x for x in lines if len(clean(x)) < 20 or len(keys[clean(x)]) < 3 or max(keys[clean(x)]) == name(row[0])]
        want.append((row[0], len(lines), len(lines) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    got = [tuple(r) for r in line_dedup.digest(docs).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert any(w[2] for w in want)


def test_lines_of_one_document_only_fall_in_others(spark):
    texts = [(i, "\n".join(["a line that everybody has got"] * (1 + i))) for i in range(4)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    out = {r["doc"]["doc_id"]: (r["n_kept"], r["kept_text"]) for r in line_dedup.drop_lines(docs).collect()}
    assert out[3][0] == 4 and all(out[i] == (0, "") for i in range(3))


def test_copies_equal_brute_force(docs, rows):
    groups = defaultdict(list)
    for row in rows:
        groups[(row[1] or "").translate(LOWER)].append(-1 if row[0] is None else row[0])
    out = exact_dedup.digest_rows(docs).collect()
    assert len(out) == len(rows)
    by_hash = defaultdict(list)
    for r in out:
        by_hash[r["text_sha256"]].append(r)
    assert set(by_hash) == {hashlib.sha256(t.encode()).hexdigest() for t in groups}
    for text, ids in groups.items():
        found = by_hash[hashlib.sha256(text.encode()).hexdigest()]
        assert {(-1 if r["keep_id"] is None else r["keep_id"], r["group_size"]) for r in found} == {(max(ids), len(ids))}
        assert sum(r["kept"] for r in found) == 1


def test_weak_digest_is_caught_by_bytes(docs, rows):
    weak = exact_dedup.decide(docs.select("doc_id", "text", F.lit(1).alias("x")), digest=lambda t: (F.char_length(t) % 3).cast("string"))
    strong = exact_dedup.digest_rows(docs)
    get = lambda df: sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in df.collect()), key=repr)
    assert get(weak.select("doc_id", "keep_id", F.col("group_size").cast("long"), "kept")) == get(strong)


def test_state_goes_on_across_runs(spark, docs, tmp_path):
    folder, state = str(tmp_path / "prints"), str(tmp_path / "state")
    located = exact_dedup.located(docs, "doc_id", "text")
    for part in ("doc_id < 10", "doc_id >= 10 OR doc_id IS NULL"):
        exact_dedup.fingerprints(located.where(part)).write.mode("append").parquet(folder)
        exact_dedup.ingest(spark, spark.read.parquet(folder), folder, state)
    held = exact_dedup.held_groups(spark, state)
    want = docs.groupBy(exact_dedup.sha256_hex(exact_dedup.normalised(F.col("text"))).alias("digest")).agg(
        F.count(F.lit(1)).alias("group_size"), F.max("doc_id").alias("id")
    )
    got = held.select("digest", "group_size", F.col("keep.doc_id").alias("id"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_decide_goes_on_with_a_state(spark, docs, tmp_path):
    """Runs on one state see the documents of earlier runs, and compare with their bytes."""
    state, parts = str(tmp_path / "state"), ("doc_id < 10", "doc_id >= 10 OR doc_id IS NULL")
    get = lambda df: {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in df.collect()}
    first = exact_dedup.decide(docs.where(parts[0]), state=state)
    assert get(first) == get(exact_dedup.decide(docs.where(parts[0])))
    second = exact_dedup.decide(docs.where(parts[1]), state=state)
    late = docs.where(parts[1]).select("doc_id").collect()
    whole = {r for r in get(exact_dedup.decide(docs)) if (r[0],) in {tuple(x) for x in late}}
    assert get(second) == whole
    assert second.count() == len(late)

    weak, state = lambda t: (F.char_length(t) % 2).cast("string"), str(tmp_path / "weak")
    make = lambda *rows: spark.createDataFrame(rows, "doc_id long, text string")
    exact_dedup.decide(make((9, "four"), (1, "five")), weak, state).collect()
    later = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.decide(make((2, "FOUR"), (3, "nine"), (4, "nine")), weak, state).collect()}
    assert later[2][0] == 9 and not later[2][2]
    assert later[3] == (4, 2, False) and later[4] == (4, 2, True)


def test_keep_one_each_keeps_columns_and_names(docs):
    out = exact_dedup.keep_one_each(docs)
    assert out.columns == docs.columns
    assert out.count() == docs.select(exact_dedup.normalised(F.col("text"))).distinct().count()


def test_mix_meets_targets(docs, labels, rows):
    out = mixing.mix(docs, mixing.quality_weights(labels)).collect()
    assert len(out) == len(rows)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in out:
        assert 0 <= r["taken"] <= 2 * r["size"]
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 1 for s in sizes)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:  # the excess of full sources is shared again
        free = [s for s in order if s not in capped]
        level = (total - sum(2 * sizes[s] for s in capped)) / sum(weights[s] for s in free)
        full = {s for s in free if weights[s] * level >= 2 * sizes[s]}
        if not full:
            break
        capped |= full
    for s in order:
        assert target[s] == pytest.approx(2 * sizes[s] if s in capped else weights[s] * level)


def test_mix_takes_complete_epochs_first(docs):
    for r in mixing.mix(docs).where("size > 0").collect():
        epochs = r["target"] // r["source_size"]
        assert epochs * r["size"] <= r["taken"] <= (epochs + 1) * r["size"]


def test_mix_prefers_good_documents(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text"), (F.col("id") % 3).cast("string").alias("source"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    out = mixing.mix(docs, mixing.quality_weights(labels)).where("source = '2'")
    rate = {r["good"]: r["t"] for r in out.groupBy((F.col("doc_id") % 2).alias("good")).agg(F.avg("taken").alias("t")).collect()}
    assert rate[1] > rate[0]


def test_mix_rows_repeat_documents(docs, labels):
    out = mixing.mix_rows(docs, mixing.quality_weights(labels))
    assert out.columns == docs.columns
    want = mixing.mix(docs, mixing.quality_weights(labels)).where("taken > 0")
    assert out.where("doc_id <> 16").count() == want.where("doc_id <> 16").agg(F.sum(F.ceil(F.col("taken") / F.col("size")))).first()[0]


def test_empty_tables(empty, labels):
    assert quality_rules.digest(empty, labels).isEmpty()
    assert line_dedup.digest(empty).isEmpty()
    assert exact_dedup.digest_rows(empty).isEmpty()
    assert exact_dedup.keep_one_each(empty).isEmpty()
    assert mixing.digest(empty, labels).isEmpty()
    assert mixing.mix_rows(empty).isEmpty()
