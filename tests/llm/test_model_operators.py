"""Near-duplicates, language model, pieces, pages, languages, archives and the pipeline against brute force."""

import base64
import hashlib
import html
import math
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from visitlens.llm import html_text, kneser_ney, language, near_dups, pieces, warc
from visitlens.llm.components import connected_components, counted_components
from visitlens.llm.queries import QUERIES
from visitlens.llm.word_hashes import word_hashes

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def _words(text):
    return [w.decode() for w in (text or "").encode().lower().split()]


def test_word_hashes_are_those_of_words():
    texts = ["a bb\tCCC\x0b a", "", None, "  ", "x" * 9_000, "é É", "a" * 5_000 + "b" + "a" * 5_000]
    seen = {}
    for text in texts:
        got = word_hashes(text)
        assert len(got) == len(_words(text))
        for w, h in zip(_words(text), got):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


# --- near-duplicates


def _classes(texts, similarity=0.8):
    bags = [Counter(tuple(w[i : i + min(5, len(w))]) for i in range(len(w) - min(5, len(w)) + 1)) if w else None for w in map(_words, texts)]
    n = len(texts)
    df = Counter(k for b in bags if b for k in b)

    def weight(k, c):
        if df[k] < near_dups.RARE * n:
            return c
        share = math.log(n / df[k]) / math.log(1 / near_dups.RARE)
        return c * (1 - near_dups.SPREAD * (1 - min(max(share, 0), 1)))

    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            if bags[i] is None or bags[j] is None:
                continue
            common = sum(weight(k, min(c, bags[j][k])) for k, c in bags[i].items())
            total = sum(weight(k, c) for b in (bags[i], bags[j]) for k, c in b.items())
            if common >= similarity * (total - common) - 1e-9:
                parent[root(i)] = root(j)
    return [root(i) for i in range(n)]


def test_near_duplicates_equal_brute_force(docs, rows):
    roots = _classes([r[1] for r in rows])
    groups = defaultdict(list)
    for r, row in zip(roots, rows):
        groups[r].append(-1 if row[0] is None else row[0])
    want = sorted((i, min(g), len(g)) for g in groups.values() for i in g)
    out = near_dups.digest(docs).collect()
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], -1 if r["class_id"] is None else r["class_id"], r["class_size"]) for r in out)
    assert got == want
    assert any(n > 2 for _, _, n in want)


def test_a_chain_and_a_large_group_become_classes(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(10_000)}" for _ in range(400)]
    texts = []
    for i in range(150):  # near copies of one text, each with words of its own
        own = list(base)
        for _ in range(3):
            own[rng.randrange(400)] = f"own{i}"
        texts.append(" ".join(own))
    texts += [" ".join(f"v{rng.randrange(10_000)}" for _ in range(100)) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = near_dups.digest(docs).collect()
    assert {r["class_id"] for r in out if r["doc_id"] < 150} == {0}
    assert all(r["class_id"] == r["doc_id"] for r in out if r["doc_id"] >= 150)
    assert near_dups.keep_one_each(docs).count() == 151


def _chained(n, seed):
    """Near copies, each of an earlier one, so that most pairs of the group are not similar."""
    rng = random.Random(seed)
    texts = [[f"w{rng.randrange(5_000)}" for _ in range(120)]]
    while len(texts) < n:
        own = list(texts[rng.randrange(max(0, len(texts) - 40), len(texts))])
        for _ in range(rng.randrange(1, 4)):
            own[rng.randrange(120)] = f"w{rng.randrange(5_000)}"
        texts.append(own)
    return [" ".join(t) for t in texts]


def test_all_similar_pairs_of_a_bucket_are_linked(spark):
    texts = list(dict.fromkeys(t for seed in range(3) for t in _chained(250, seed)))
    bags = [near_dups.bag(t) for t in texts]
    keys, df = np.unique(np.concatenate([k for k, _ in bags]), return_counts=True)
    weights = near_dups.Weights(keys, df, len(texts))
    bags = [(k, weights.of(k, c)) for k, c in bags]
    samples = near_dups.Sampler().samples(bags)
    bands, short = near_dups.band_hashes(samples), samples.astype(np.uint16)
    edges = []
    for i in range(len(texts)):
        near = (bands[i] == bands[:i]).any(axis=1) & ((short[i] == short[:i]).sum(axis=1) >= near_dups.AGREEING)
        edges += [(int(j), i) for j in np.flatnonzero(near) if near_dups.weighted_jaccard(bags[i], bags[j]) >= 0.8]
    root = list(range(len(texts)))
    for _ in texts:
        before = list(root)
        for j, i in edges:
            root[i] = root[j] = min(root[i], root[j])
        if root == before:
            break
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"]: r["class_id"] for r in near_dups.digest(docs).collect()} == dict(enumerate(root))


def test_samples_asked_lose_few_similar_pairs():
    n = near_dups.SAMPLES
    assert sum(math.comb(n, k) * 0.8**k * 0.2 ** (n - k) for k in range(near_dups.AGREEING)) < 1 / 30_000
    n = near_dups.LONG
    assert sum(math.comb(n, k) * 0.8**k * 0.2 ** (n - k) for k in range(near_dups.LONG_AGREEING)) < 1 / 100_000


def test_long_words_that_differ_far_inside_differ_in_hash():
    word = "".join(chr(97 + i % 26) for i in range(9_000))
    swapped = word[:100] + word[4_196] + word[101:4_196] + word[100] + word[4_197:]
    first, second, other = (word_hashes(w)[0] for w in (word, swapped, word[:8_999]))
    assert word[100] != word[4_196] and first != second and first != other
    assert (word_hashes("ab " + word[:4_096])[1] == word_hashes(word[:4_096])[0])


def test_neighbours_meet_across_ranges(spark):
    rows = [(5, k, k, b"%03d" % k) for k in range(100)] + [(6, k, k, b"%03d" % (200 + k)) for k in range(100)]
    buckets = spark.createDataFrame(rows, "bucket long, then long, next long, node binary")
    got = {(int(bytes(r["a"])), int(bytes(r["b"]))) for r in near_dups.neighbours(buckets).collect()}
    assert got == {(s + k, s + k + 1) for s in (0, 200) for k in range(99)}


def test_clusters_in_one_bucket_are_compared_across_tiles(spark, monkeypatch):
    n = near_dups.TILE + 150  # every other member is like the one half the bucket away and none else
    words = [" ".join(f"w{k % (n // 2)}x{i}" for i in range(12)) for k in range(n)]
    words[3] = words[3 + n // 2] + " and a different end of it with so many words that little stays alike"
    rows = []
    for k in range(n):
        long = np.full(near_dups.LONG, k % (n // 2), np.uint16).tobytes()
        bands = [1, 0 if k % 2 == n // 2 % 2 else 7 + k] + [100 * k + j for j in range(10)]
        rows.append((b"%04d" % k, bands, words[k], long))
    sampled = spark.createDataFrame(rows, "node binary, bands array<long>, text string, long binary")
    buckets = sampled.select(F.inline(F.transform(F.slice("bands", 1, 2), lambda b: F.struct(b.alias("bucket")))), "node")
    weights = near_dups.Weights(np.zeros(0, np.uint64), np.zeros(0), n)
    alone = near_dups.Roots(spark.createDataFrame([], "node binary, root binary"), 0)
    members = near_dups.open_members(buckets, alone)
    want = {(k, k + n // 2) for k in range(n // 2) if k != 3}
    for tile_bytes in (near_dups.TILE_BYTES, 2_000):
        monkeypatch.setattr(near_dups, "TILE_BYTES", tile_bytes)
        links, count = near_dups.open_links(members, sampled, weights, 0.8)
        found = [(int(bytes(r["root_a"])), int(bytes(r["root_b"]))) for r in links.collect()]
        assert {tuple(sorted(f)) for f in found} == want and count == len(found) == len(want)
    linked = sampled.where("node > binary('0000')").select("node", F.lit(b"0000").alias("root"))
    assert near_dups.open_members(buckets, near_dups.Roots(linked, n - 1)).isEmpty()


def test_later_links_merge_known_components(spark):
    rows = [(b"b", b"a"), (b"d", b"c"), (b"e", b"c")]
    links = spark.createDataFrame([(b"c", b"a"), (b"x", b"y"), (b"x", b"c")], "root_a binary, root_b binary")
    roots = near_dups.Roots(spark.createDataFrame(rows, "node binary, root binary"), 3).after(links)
    got = {bytes(r["node"]).decode(): bytes(r["root"]).decode() for r in roots.table.collect()}
    assert got == {"b": "a", "c": "a", "d": "a", "e": "a", "x": "a", "y": "a"} and roots.count == 6


def test_samples_agree_as_often_as_weights_overlap():
    rng = np.random.default_rng(5)
    keys = np.sort(rng.integers(0, 1 << 63, 600, dtype=np.uint64))
    left = (keys[:450], rng.uniform(0.5, 3, 450))
    right = (keys[50:], rng.uniform(0.5, 3, 550))
    want = near_dups.weighted_jaccard(left, right)
    agree = []
    for seed in range(40):
        a, b = near_dups.Sampler(seed).samples([left, right])
        agree.append((a == b).mean())
    assert abs(np.mean(agree) - want) < 0.03


def test_frequent_shingles_are_exact(docs, rows):
    weights = near_dups.frequent_shingles(docs)
    df = Counter(k for r in rows for k in set(near_dups.bag(r[1])[0].tolist()))
    assert set(weights.keys.tolist()) == set(df)  # with fewer than 1,000 texts every shingle is frequent


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (102, 101), (103, 103)]
    named = spark.createDataFrame([(f"{a:04d}", f"{b:04d}") for a, b in edges], "a string, b string")
    want = {f"{i:04d}": "0000" for i in range(1, 61)} | {"0101": "0100", "0102": "0100"}
    assert {r["node"]: r["root"] for r in connected_components(named).collect()} == want
    for one_task in (0, 1_000):
        found, count = counted_components(named, one_task)
        assert {r["node"]: r["root"] for r in found.collect()} == want and count == len(want)
        assert counted_components(named.limit(0), one_task)[1] == 0


# --- language model


def _kneser_ney(training):
    pairs, unigrams = Counter(), Counter()
    for words in training:
        tokens = [*words, None]
        unigrams.update(tokens)
        pairs.update(zip([False, *tokens[:-1]], tokens))
    before, followers, total = Counter(), defaultdict(lambda: [0, 0, 0]), Counter()
    for (u, v), n in pairs.items():
        before[v] += 1
        followers[u][min(n, 3) - 1] += 1
        total[u] += n

    def d(counts):
        c = Counter(counts)
        return kneser_ney.discounts([c[k] for k in (1, 2, 3, 4)])

    d2, d1, types = d(pairs.values()), d(before.values()), len(unigrams)
    kinds = Counter(min(n, 3) for n in before.values())
    rest = sum(d1[k - 1] * kinds[k] for k in (1, 2, 3)) / max(len(pairs), 1) if pairs else 1.0
    cut = lambda n, ds: n - (0, *ds)[min(n, 3)]

    def probability(u, v):
        low = cut(before[v], d1) / max(len(pairs), 1) + rest / (types + 1)
        if not total[u]:
            return low
        return (cut(pairs[u, v], d2) + sum(a * b for a, b in zip(d2, followers[u])) * low) / total[u]

    return probability, unigrams


def _check_scores(out, rows):
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    probability, unigrams = _kneser_ney([_words(r[1]) for r in rows if not held(r[0])])
    n, types = sum(unigrams.values()), len(unigrams)
    want = []
    for row in rows:
        tokens = [*_words(row[1]), None]
        base = sum(math.log10((unigrams[t] + 1) / (n + types + 1)) for t in tokens)
        own = sum(math.log10(probability(u, v)) for u, v in zip([False, *tokens[:-1]], tokens))
        want.append((str(row[0]), held(row[0]), len(tokens), sum(unigrams[t] > 0 for t in tokens), n, base, own))
    got = [(str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in out]
    for a, b in zip(sorted(got), sorted(want)):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)
    assert len(got) == len(want)


def test_scores_equal_brute_force(docs, rows):
    _check_scores(kneser_ney.digest(docs).collect(), rows)


def test_scores_of_the_table_equal_brute_force(spark, data):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    _check_scores(QUERIES["op3_kneser_ney"](spark, data).collect(), rows)


def test_probabilities_sum_to_one():
    texts = [["a", "b", "a", "c"], ["a", "b"], ["d"] * 5, ["a", "b", "d"]]
    probability, unigrams = _kneser_ney(texts)
    for u in ("a", "b", "d", False, "never"):
        assert sum(probability(u, v) for v in [*unigrams, "unseen"]) == pytest.approx(1)


# --- pieces


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_pieces_equal_the_library(spark, data, docs, rows, library):
    table = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in table.collect()}
    for frame, known in ((table, texts.items()), (docs, [(r[0], r[1]) for r in rows])):
        want = []
        for i, t in known:
            ids = library.encode(t or "")
            joined = ",".join(map(str, ids))
            want.append((i, len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
        assert sorted(map(tuple, pieces.digest(frame, MODEL).collect()), key=repr) == sorted(want, key=repr)


def test_random_strings_equal_the_library(library):
    model, rng = pieces.load(MODEL), random.Random(11)
    letters = "aabbeett  ▁\n\t\r\x00hн漢字😀éß0019.,-_=AB "
    for k in range(8_000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 24)))
        if k % 2:
            text = "".join(rng.choice(model.text[259:]) for _ in range(rng.randint(1, 5)))
        ids = library.encode(text)
        assert model.both(text) == (",".join(map(str, ids)), library.decode(ids), len(ids))


def test_encoding_replaces_columns_of_its_name(spark, library):
    rows = spark.createDataFrame([(1, "a b", [7], "x"), (2, None, None, "y")], "doc_id long, text string, ids array<int>, decoded string")
    encoded = pieces.encode(rows, MODEL)
    assert sorted(encoded.columns) == ["decoded", "doc_id", "ids", "text"]
    back = {r["doc_id"]: (list(r["ids"]), r["decoded"]) for r in pieces.decode(encoded, MODEL).collect()}
    assert back == {1: (library.encode("a b"), "a b"), 2: ([], "")}
    with pytest.raises(ValueError):
        pieces.encode(rows, MODEL, "text")


def test_encode_and_decode_frames(docs, rows, library):
    out = pieces.decode(pieces.encode(docs.select("doc_id", "text"), MODEL), MODEL).collect()
    for r in out:
        assert r["ids"] == library.encode(r["text"] or "")
        assert r["decoded"] == library.decode(r["ids"])


# --- pages


def test_pages_give_their_articles(spark, data):
    out = {r["page_id"]: r for r in QUERIES["op6_html_text"](spark, data).collect()}
    import re

    for row in spark.read.parquet(f"{data}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", row["html"], re.DOTALL)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert out[row["page_id"]]["text"] == "\n\n".join(b for b in blocks if b)
        assert out[row["page_id"]]["n_chars"] == len(out[row["page_id"]]["text"])


def test_host_votes_decide_where_one_page_misleads(spark):
    page = "<body><div class=side{0}>{2}</div><div class='post body-{0}'><h1>T{0}</h1><p>{1} one</p><p>{1} two</p></div></body>"
    usual = [page.format(i, "words " * 30, "x") for i in range(9)]
    odd = page.format(9, "short", "<p>" + "chatter " * 50 + "</p>")
    rows = [(i, "http://a.example/x", h) for i, h in enumerate([*usual, odd])] + [(10, None, None), (11, None, ""), (12, "b", "<p>only")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = {r["page_id"]: r["text"] for r in html_text.digest(pages).collect()}
    assert out[9] == "T9\n\nshort one\n\nshort two"
    assert out[10] == out[11] == "" and out[12] == "only"
    assert html_text.digest(pages.limit(0)).isEmpty()


@pytest.mark.parametrize(
    "source, text",
    [
        ("<nav><a>x</a></nav><main><p>a &amp; b&nbsp; c<p>d <b>e</b>f</main><footer>z</footer>", "a & b c\n\nd ef"),
        ("<article><header><h1>T</h1></header><p>a</p><aside>s</aside><section class='comments'><p>c</p></section></article>", "T\n\na"),
        ("<script>var a='</p><p>';</script><style>p{}</style><!-- <p>no</p> --><p>yes", "yes"),
        ("<div class='cookie-notice'>n</div><form><p>f</p></form><div><p>a</p><ul><li>b<li>c</ul></div>", "a\n\nb\n\nc"),
        ("<p>1 < 2</p><a href='>'>l</a><p title=\"x>y\">q</p>", "1 < 2\n\nl\n\nq"),
    ],
)
def test_markup(source, text):
    assert html_text.Page(source).text_below(None) == text


@pytest.mark.parametrize(
    "source, text",
    [
        ('<p>see <a href="/hidden-valley">the valley</a>, <a href="/p?id=comment">this</a>', "see the valley, this"),
        ('<div data-hidden="false"><p>a</p><p title="class=ad role=menu">b</p></div>', "a\n\nb"),
        ("<div data-x=\"a='b' class='ad'\" class=text><p>a</p></div>", "a"),
        ('<main class="has-sidebar"><p>a</p></main>', "a"),
        ('<article class="post no-comments"><p>a</p></article>', "a"),
        ('<article class="comment"><p>a</p></article>', "a"),
        ('<div class="content with-sidebar"><p>a</p><div class="sidebar-left">s</div><div class="site-footer">f</div></div>', "a"),
        ('<div class="wrap has-header menu-open"><p>a</p><div class="page-header">h</div></div>', "a"),
        ('<div><p>a</p><p hidden>b</p><p CLASS = "x ad">c</p><p aria-hidden=true>d</p><p style="display: none">e</p></div>', "a"),
    ],
)
def test_only_real_boilerplate_is_dropped(source, text):
    assert html_text.Page(source).text_below(None) == text


# --- languages


ARTICLE = "<p>" + "The article tells a long story in plain words. " * 6 + "</p><p>" + "It goes on for a second part. " * 5 + "</p>"
TOLD = ("The article tells a long story in plain words. " * 6).strip() + "\n\n" + ("It goes on for a second part. " * 5).strip()


@pytest.mark.parametrize(
    "source",
    [
        f"<body><a name=top><div class=content>{ARTICLE}</div><div class=sidebar>side text here</div>",
        f"<body><form id=aspnetForm><div id=nav>Home Products</div><div>{ARTICLE}</div><footer>(c)</footer></form></body>",
        f"<body><div class='social-article'>{ARTICLE}</div><div class=footer>foot</div>",
        f"<body><nav>a b</nav><div class='comment-article-body'>{ARTICLE}</div>",
        f"<body><svg width=1><div>{ARTICLE}</div></body>",
        f"<body><object><canvas><div>{ARTICLE}</div></body>",
        f"<body><div class='sidebar-layout'><nav>menu</nav><div class=text>{ARTICLE}</div></div></body>",
        f"<body><p><a href='/x'>Unclosed link</p><div>{ARTICLE}</div></body>",
        f"<body><div>{ARTICLE}</div><div class=comments><p>{'A reader says much more than the article does. ' * 60}</p></div></body>",
        f"<body><div>{ARTICLE}</div><aside>{'A long side story. ' * 20}</aside><form>{'Your name please. ' * 30}</form></body>",
    ],
)
def test_whole_articles_of_common_markup(source):
    assert html_text.Page(source).text_below(None).endswith(TOLD)
    assert "says much" not in html_text.Page(source).text_below(None) and "side" not in html_text.Page(source).text_below(None)


def test_boilerplate_alone_is_no_text():
    for source in ("<nav>a b c</nav><div class=cookie>We use cookies.</div>", "<div class=comments><p>first!</p></div>", "<p hidden>x</p>"):
        assert html_text.Page(source).text_below(None) == ""


def test_votes_equal_brute_force(spark):
    """Hosts whose pages nest differently above a shared path, ties between paths, repeated rows, clashing names."""
    deep = lambda n, inner: "<div class=l0>" + "".join(f"<div class=l{i + 1}x>" for i in range(n)) + inner
    rows = []
    for h in range(3):
        for k in range(6):
            body = f"<main class=text>{ARTICLE}</main>" if k % 2 else f"<section class=a>{ARTICLE}</section><section class=b>{ARTICLE}</section>"
            rows.append((h * 10 + k, f"http://H{h}.org/{k}", f"<body>{deep(k * 3, body)}</body>", "x", "y", "z"))
    rows += [rows[0], (99, None, None, "x", "y", "z"), (98, "", "", "x", "y", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, host string, _host string")
    votes = Counter()
    for row in rows:
        at = (row[1] or "").lower().split("/")[2] if row[1] else ""
        page = html_text.Page(row[2] or "")
        best = max(page.scores().values(), default=1)
        shares = {}
        for e, score in page.scores().items():
            shares[page.path(e)] = max(shares.get(page.path(e), 0), score / best)
        for path, share in shares.items():
            votes[at, path] += round(share * 1_000) if share > 0 else 0
    want = {}
    for (at, path), n in votes.items():
        if at not in want or (-n, path) < want[at]:
            want[at] = (-n, path)
    got = {r["_host"]: r["path"] for r in html_text.winning_paths(pages).collect()}
    assert got == {at: path for at, (_, path) in want.items()} and len(got) == 3
    texts = sorted((r["page_id"], r["text"]) for r in html_text.digest(pages).collect())
    assert len(texts) == len(rows) and all(("It goes on" in t) == (i < 98) for i, t in texts)


def test_many_hosts_are_shuffled_with_large_ones_spread(spark, monkeypatch):
    rows = [(i, f"http://h{i % 3 if i < 60 else i}.org/a", f"<div class=c{i % 2}>{ARTICLE}</div>") for i in range(90)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    near = sorted(map(tuple, html_text.digest(pages).collect()))
    monkeypatch.setattr(html_text, "SMALL_ROWS", 2)
    assert sorted(map(tuple, html_text.digest(pages).collect())) == near


def test_languages_on_held_out_rows(spark, data):
    out = QUERIES["op7_language"](spark, data)
    truth = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "lang")
    held = out.where("held_out").join(truth, "doc_id")
    assert held.where("lang_pred = lang").count() >= 0.97 * held.count()
    assert out.where("score < 0 OR score > 1").isEmpty()
    assert out.where("rejected").count() <= 0.01 * out.count()


@pytest.mark.parametrize("left", ["de", "en", "es", "fr"])
def test_languages_left_out_are_rejected(spark, data, left):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    out = language.identify(docs, language.fit(docs, F.col("lang") != left)).select("doc.lang", "rejected")
    count = lambda where: out.where(where).count()
    assert count(f"lang = '{left}' AND NOT rejected") <= 0.2 * count(f"lang = '{left}'")
    assert count(f"lang <> '{left}' AND NOT rejected") >= 0.99 * count(f"lang <> '{left}'")


def test_one_odd_text_opens_no_language():
    rng = np.random.default_rng(1)
    rows = np.abs(rng.normal(size=(400, 64)))
    rows = np.concatenate([rows, np.eye(64)[:1]])
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    centers = language.cluster(rows[:400], 2)
    cosines = language.cosines_without_self(rows, centers)
    grams = np.full(401, 2_000.0)
    bound = language.bounds(cosines, grams, 0.005, 1.0)[language.length_class(2_000.0)]
    assert cosines[-1] < 0.3 < bound < np.median(cosines)
    assert not language.bounds(cosines[:4], grams[:4], 0.005, 1.0).any()  # too few to tell


def _peak_mb(made):
    tracemalloc.start()
    made()
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return peak


def test_learning_a_language_takes_little_more_than_its_rows():
    rng = np.random.default_rng(2)
    rows = rng.random((600, language.DIMENSION), dtype=np.float32)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    centers = language.cluster(rows, 1)
    want = rows.mean(axis=0)
    assert np.array_equal(centers[0], want / float(np.linalg.norm(want)))
    others = rows.sum(axis=0) - rows
    want = (others * rows).sum(axis=1) / np.linalg.norm(others, axis=1)
    assert np.array_equal(language.cosines_without_self(rows, centers), want)
    assert _peak_mb(lambda: language.cluster(rows, 1)) < 2  # rows are 20 MB
    assert _peak_mb(lambda: language.cosines_without_self(rows, centers)) < 8
    texts = [" ".join(f"w{chr(97 + k % 26)}{chr(97 + j % 26)}" for j in range(k % 7 + 1)) for k in range(512)]
    model = language.LanguageModel(np.ones(language.DIMENSION, np.float32), ["a"], centers, np.zeros((1, language.LENGTHS)))
    assert _peak_mb(lambda: model.predict(texts)) < 20  # counts of 256 texts alone are 17 MB
    held, places, grams = language.weighed_texts([None, *texts, "12"], model.idf)
    counts = np.stack([language.gram_counts(t) for t in texts])
    assert np.array_equal(held, language.weigh(counts, model.idf))
    assert places == list(range(1, 513)) and np.array_equal(grams, counts.sum(axis=1))


def test_texts_without_letters_and_foreign_ones(docs, empty, rows):
    out = language.digest(docs).collect()
    assert len(out) == len(rows)
    none = {i for i, t, *_ in rows if not any(c.isalpha() for c in t or "")}
    assert {r["doc_id"] for r in out if r["lang_pred"] == "und"} == none
    assert all(r["score"] == 0 and r["rejected"] for r in out if r["lang_pred"] == "und")
    assert {r["lang_pred"] for r in language.digest(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    twice = docs.union(docs).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b"))
    tied = language.fit(twice.select("doc_id", F.lit("same words in all of them").alias("text"), "lang"), F.lit(True))
    assert tied.predict(["same words in all of them"])[0] == ["a"]  # of equal cosines the first language wins
    model = language.fit(docs, F.lit(True))
    assert language.identify(docs, model).select("doc.*").columns == docs.columns
    assert model.predict(["漢字" * 400])[2] == [True]
    for query in (language.digest, near_dups.digest, kneser_ney.digest):
        assert query(empty).isEmpty()


# --- archives


@pytest.fixture(scope="module")
def pages(spark, tmp_path_factory):
    tricky = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(3, "http://a", "same é"), (1, "http://b", "same é"), (2, None, "same é"), (4, "http://c", None), (5, "http://d x\n", ""),
            (6, "http://e", tricky), (None, "http://f", "own"), (7, "http://g", "dup"), (7, "http://g", "dup"), (8, "http://h", "\r\n\n 😀\x00")]
    path = str(tmp_path_factory.mktemp("llm") / "pages.parquet")
    spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, carrier string").write.parquet(path)
    return spark.read.parquet(path)


def test_archives_round_trip(spark, pages, tmp_path):
    folder = str(tmp_path / "warc")
    warc.write_archives(pages, folder)
    out = warc.captures(warc.read_records(spark, folder)).collect()
    assert len(out) == pages.count()
    held = {r["response"]["id"]: bytes(r["response"]["payload"]) for r in out if r["response"]["type"] == "response"}
    got = sorted(
        (str(r["metadata"]["page_id"]), held[r["response"]["refers_to"] or r["response"]["id"]].decode()) for r in out
    )
    assert got == sorted((str(p["page_id"]), p["html"] or "") for p in pages.collect())
    assert all(r["request"]["id"] and r["request"]["target_uri"] == r["response"]["target_uri"] for r in out)


def test_archive_digest(pages):
    got = sorted(map(tuple, warc.digest(pages).collect()), key=repr)
    want = []
    first, seen = {}, set()
    rows = [(p["page_id"], p["html"] or "") for p in pages.collect()]
    for i, h in rows:
        first[h] = min(first.get(h, i), i, key=lambda x: -1 if x is None else x)
    for i, h in rows:
        new = first[h] == i and h not in seen
        seen |= {h} if new else set()
        want.append((i, len(h.encode()), base64.b32encode(hashlib.sha1(h.encode()).digest()).decode(), "response" if new else "revisit", None if new else first[h]))
    assert got == sorted(want, key=repr)


def test_reading_members_and_broken_archives(spark):
    import gzip

    record = "WARC/1.1\r\nWARC-Type: metadata\r\nWARC-Record-ID: <a>\r\nContent-Length: 4\r\n\r\n\r\n\r\n\r\n\r\n".encode()
    data = gzip.compress(record) + gzip.compress(record)
    assert len(list(warc.split_records(warc.unzip(data)))) == 2
    for step in (1, 7, 100):
        pieces = list(warc.unzip(data, step))
        assert b"".join(pieces) == record + record and max(map(len, pieces)) <= max(step, 1)
        assert len(list(warc.split_records(pieces))) == 2
        assert list(warc.split_records(warc.unzip(record, step)))[0][1] == b"\r\n\r\n"
    with pytest.raises(ValueError):
        list(warc.split_records([record[:-8].replace(b"Length: 4", b"Length: 400")]))
    with pytest.raises(ValueError):
        list(warc.split_records([b"no archive"]))
    assert list(warc.split_records([])) == []


def test_large_pages_go_to_files_of_bounded_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 4 << 20)
    rng = random.Random(4)
    big = [rng.randbytes(1_500_000).hex() for _ in range(3)]
    rows = [(i, f"http://h/{i}", big[i] if i < 3 else f"<p>{i}</p>") for i in range(40)]
    large = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    folder = str(tmp_path / "large")
    warc.write_archives(large, folder)
    sizes = [sum(map(len, warc.unzip(p.read_bytes()))) for p in (tmp_path / "large").glob("*.gz")]
    assert len(sizes) > 1 and sum(sizes) > 9_000_000
    got = {r["metadata"]["page_id"]: bytes(r["response"]["payload"]).decode() for r in warc.captures(warc.read_records(spark, folder)).collect()}
    assert got == {i: h for i, _, h in rows}


def test_no_pages(pages):
    assert warc.digest(pages.limit(0)).isEmpty()
