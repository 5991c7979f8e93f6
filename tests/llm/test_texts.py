"""Extraction, token files, packing, mixing and toxicity."""

import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from rows_of_text import DATA, docs  # noqa: F401

from spanlake.llm import html_extract, mixing, packing, token_files, toxicity
from spanlake.llm.queries import queries

public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

ARTICLE = "<article><h1>A  title</h1><p><b>First</b> para&shy;graph &amp; more<br>line<p>Second\n one</article>"
TEXT = "A title First para\xadgraph & more line Second one"


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("just text", "just text"),
        (f"<html><head><title>t</title></head><body><nav><a>x</a></nav>{ARTICLE}<footer>f</footer>", TEXT),
        (f"<body><div class='cookie-notice'>We use cookies</div>{ARTICLE}<div class=ad>Buy</div></body>", TEXT),
        (f"<aside>side</aside>{ARTICLE}<section id='comments'><p>Reader says</section><script>if (a<b) x()</script>", TEXT),
        ("<article><p>One</p><form><input name=q><button>Go</button></form><p>Two</p></article>", "One Two"),
        ("<article><div><p>in</div><div class='share-buttons'>Share</div></article><p>out</p>", "in"),
        ("<ul><li><a href=x>One</a></li><li><a href=y>Two</a></li></ul><p>" + "text " * 40, ("text " * 40).strip()),
        ("<p>a &lt;b&gt; c<!-- hidden > --></p><style>p{}</style>", "a <b> c"),
        ("<article></article>", ""),
    ],
)
def test_main_text(page, text):
    assert html_extract.main_text(page) == text


def test_extract_rows(spark, docs):
    rows = [(1, "u", ARTICLE, "old"), (1, "u", ARTICLE, "old"), (None, None, None, None)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = html_extract.extract(frame)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got.collect()) == [(0, "", 0), (1, TEXT, len(TEXT)), (1, TEXT, len(TEXT))]
    assert html_extract.extract(frame.limit(0)).count() == 0


def test_deep_and_long_pages():
    assert html_extract.main_text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    long = "<article>" + "<p>some words here</p>" * 20_000 + "</article>"
    assert len(html_extract.main_text(long)) == 20_000 * 16 - 1


ALPHABET = st.sampled_from(["a", "é", "B", " ", " ", "\n", ".", ",", "'s", "1", "²", "\t", "\xa0", "<|endoftext|>", "*", "日", "\r", "_"])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=14).map("".join), max_size=4))
def test_word_encoder(texts):
    coder = token_files.encoder(TOKENIZER)
    want = [np.array(e.ids, coder.kind).tobytes() for e in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert coder.encode(texts) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=40))
def test_rank_coding(ranks):
    control, data = token_files.pack_ranks(np.array(ranks, np.uint32))
    assert len(control) == -(-len(ranks) // 4)
    assert token_files.unpack_ranks(control, data, len(ranks)).tolist() == ranks


def test_token_files(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    texts = [(7, "The end. The end."), (3, None), (5, ""), (9, "long " * 30_000), (7, "The end. The end."), (1, "é\n\nß")]
    got = token_files.round_trip(docs(*texts), TOKENIZER).orderBy("start").collect()
    at = 0
    for r, (i, t) in zip(got, sorted(texts, key=lambda x: x[0])):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens, bytes(r.ids)) == (i, at, len(ids), np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert len(got) == len(texts)
    assert token_files.round_trip(docs((1, "x")).limit(0), TOKENIZER).count() == 0


def test_token_query(spark):
    rows = queries()["op4_token_files"](spark, DATA).orderBy("doc_id").collect()
    texts = dict(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect())
    coder = token_files.encoder(TOKENIZER).tokenizer
    at = 0
    for r in rows:
        ids = [*coder.encode(texts[r.doc_id], add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def check_packing(rows, sizes, lengths):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.seq, []).append(r)
    assert {i: sum(r.n_tokens for r in found) for i, found in by_doc.items()} == sizes
    for found in by_doc.values():
        starts = sorted((r.piece_start, r.n_tokens) for r in found)
        assert [s for s, _ in starts] == [sum(n for _, n in starts[:k]) for k in range(len(starts))]
    for found in by_seq.values():
        inside = sorted((r.seq_offset, r.n_tokens) for r in found)
        assert all(a + n <= b for (a, n), (b, _) in zip(inside, inside[1:]))
        used = sum(n for _, n in inside)
        assert {(r.seq_used, r.seq_length) for r in found} == {(used, min(n for n in lengths if n >= used))}


def test_packing(spark, docs):
    sizes = {i: (i * 37) % 90 for i in range(300)} | {900: 1000, 901: 100}
    rows = [(i, n, "x") for i, n in sizes.items()] + [(902, None, "x"), (903, -4, "x")]
    frame = spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint, seq string")
    for shard in (20_000, 50):
        got = packing.pack(frame, lengths=(32, 64, 100), overhead=3, shard_documents=shard).collect()
        check_packing(got, sizes | {902: 0, 903: 0}, (32, 64, 100))
    assert packing.pack(frame.limit(0)).count() == 0
    same = spark.createDataFrame([(None, 5), (None, 5), (1, 5)], "doc_id bigint, n_tokens bigint")
    assert packing.pack(same).count() == 3


def test_packing_keeps_ids_and_splits_hot_ones(spark, docs):
    large = [(2**53 + 1, 5), (None, 5), (2**53 + 5, 7), (-(2**63), 1), (2**63 - 1, 1)]
    got = packing.pack(spark.createDataFrame(large, "doc_id bigint, n_tokens bigint")).collect()
    assert sorted(((r.doc_id, r.n_tokens) for r in got), key=str) == sorted(large, key=str)
    hot = spark.createDataFrame([(1, 10)] * 3000 + [(None, 10)] * 1000 + [(2, 64 * 3000 + 7)], "doc_id bigint, n_tokens bigint")
    got = packing.pack(hot, lengths=(32, 64), shard_documents=500).collect()
    assert len(got) == 7001 and sum(r.n_tokens for r in got) == 40_000 + 64 * 3000 + 7
    shards = {}
    for r in got:
        shards[r.shard] = shards.get(r.shard, 0) + 1
    assert len(shards) == 15 and max(shards.values()) < 700


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50), max_size=40))
def test_joint_opening_is_no_dearer_than_one_length(sizes):
    sizes = sorted(sizes, reverse=True)
    *_, used, final = packing.pack_shard(sizes, (10, 25, 50), 2)
    _, _, one = packing._pack(sizes, (50,), 50)
    assert sum(final) + 2 * len(used) <= sum(next(n for n in (10, 25, 50) if n >= u) for u in one) + 2 * len(one)
    assert sum(used) == sum(sizes) and all(u <= f for u, f in zip(used, final))


def _labelled(spark, docs):
    word = lambda i: f"plain{i * i % 97} the of"
    texts = {i: " ".join(word(i + k) for k in range(20)) for i in range(200)}
    texts |= {i: t + " awful nasty" for i, t in texts.items() if i % 4 == 0}
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in texts], "doc_id bigint, quality int, toxic int")
    return texts, docs(*texts.items()), labels


def test_mixing_reaches_targets(spark, docs):
    texts, frame, labels = _labelled(spark, docs)
    targets = {"clean": 0.9, "toxic": 0.1, "low": 0.2}  # no document is low: the others are scaled up
    rows = mixing.rates(frame, mixing.domains(labels), targets).collect()
    total = sum(r.n_tokens for r in rows)
    clean = sum(r.n_tokens * r.rate * r.p_clean for r in rows)
    toxic = sum(r.n_tokens * r.rate * r.p_toxic for r in rows)
    assert abs(clean - 0.9 * total) < 0.01 * total and abs(toxic - 0.1 * total) < 0.01 * total
    assert all(r.rate >= 0 and abs(r.copies - r.rate) < 1 for r in rows)
    assert all((r.p_toxic > 0.5) == (r.doc_id % 4 == 0) for r in rows)


def test_mixing_floors_and_odd_rows(spark, docs):
    texts, frame, labels = _labelled(spark, docs)
    odd = docs((1000, None), (1001, ""), (None, "the of"), (3, texts[3]))
    both = frame.unionByName(odd)
    left = mixing.mix(both, mixing.domains(labels), {"clean": 0.95, "toxic": 0.05}, floors={"clean": 1.0}, keep="clean")
    assert left.columns == both.columns
    ids = [r.doc_id for r in left.collect()]
    assert all(i in ids for i in texts if i % 4)
    assert mixing.rates(frame.limit(0), mixing.domains(labels), {"clean": 1.0}).count() == 0
    none = mixing.rates(frame, mixing.domains(labels.limit(0)), {"clean": 0.5, "toxic": 0.5}).collect()
    assert all(r.rate == 1 and r.p_clean == 1 for r in none)


def plain_rates(tokens, p, floor, goal):
    """Accelerated projected gradient steps until nothing moves: (objective, rates)."""
    root = np.sqrt(tokens)[:, None] * p
    step = 1 / np.linalg.eigvalsh(root.T @ root)[-1]
    low = np.sqrt(tokens) * floor
    x = y = np.sqrt(tokens) * np.maximum(1, floor)
    t = 1.0
    for _ in range(60_000):
        after = np.maximum(low, y - step * (root @ (root.T @ y - goal)))
        if (y - after) @ (after - x) > 0:
            t = 1.0  # the momentum points uphill
        later = (1 + np.sqrt(1 + 4 * t * t)) / 2
        x, y, t = after, after + (t - 1) / later * (after - x), later
    off = root.T @ x - goal
    return off @ off / 2


@pytest.mark.parametrize("floors", ["none", "some", "all"])
@pytest.mark.parametrize("targets", [(0.85, 0.1, 0.05), (0.05, 0.05, 0.9), (1.0, 0.0, 0.0), (0.9, 0.06, 0.04)])
def test_rates_match_a_plain_solver(spark, docs, floors, targets):
    rng = np.random.default_rng(5)
    p = rng.dirichlet([0.4, 0.4, 0.4], 300)
    tokens = rng.integers(0, 50, 300).astype(float)
    floor = {"none": np.zeros(300), "some": (p[:, 0] < 0.4).astype(float), "all": np.full(300, 1.5)}[floors]
    rows = [(int(n), [float(x) for x in row], float(f)) for n, row, f in zip(tokens, p, floor)]
    members = spark.createDataFrame(rows, "n_tokens bigint, p array<double>, floor double").repartition(4)
    names = ["a", "b", "c"]
    found = mixing.solve(members, names, dict(zip(names, targets)), budget=tokens.sum())
    goal = np.array(targets) * tokens.sum()
    rate = found.rates(p, floor)
    off = (rate * tokens) @ p - goal
    assert found.reached and (rate >= floor).all()
    assert abs(off @ off / 2 - found.objective) <= 1e-6 * (goal @ goal)
    best = plain_rates(tokens, p, floor, goal)
    assert found.objective <= 1.001 * best + 1e-6 * (goal @ goal)


def test_toxicity(spark, docs):
    texts, frame, labels = _labelled(spark, docs)
    model = toxicity.fit(frame, labels, F.col("doc_id") < 150)
    odd = docs((1000, None), (1001, ""), (None, "nasty " * 5000), (7, texts[7]))
    rows = toxicity.score(frame.unionByName(odd).withColumn("score", F.lit("x")), model).collect()
    assert len(rows) == 204 and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.doc_id is not None and 150 <= r.doc_id < 1000]
    assert np.mean([r.predicted == (r.doc_id % 4 == 0) for r in held]) > 0.95
    assert len({r.score for r in rows if r.doc_id == 7}) == 1
    assert len({r.score for r in rows if r.doc_id in (1000, 1001)}) == 1
    assert toxicity.score(frame.limit(0), model).count() == 0
    assert {r.score for r in toxicity.score(frame, toxicity.fit(frame, labels.limit(0))).collect()} == {0.0}


def test_scores_do_not_depend_on_the_batch():
    texts = [np.array([1, 2, 3]), np.zeros(0, np.int64), np.array([5]), np.array([7, 8]), np.arange(9)]
    model = toxicity.train([t for t in texts if len(t)] * 6, np.tile([1.0, 0.0, 1.0, 0.0], 6))
    alone = np.concatenate([model.score([t]) for t in texts])
    assert np.allclose(alone, model.score(texts), atol=1e-6)


def _made_up(spark, docs):
    """Texts of words that hardly recur, toxic ones with two telling words; the first half and 600 have labels."""
    rng = np.random.default_rng(3)
    telling = [f"slur{i}" for i in range(10)]
    texts, domain = {}, {}
    for i in range(600):
        words = ["the", "of"] * 5 + [f"w{k}" for k in rng.integers(0, 8000, 150)]
        domain[i] = "toxic" if i % 5 == 0 else "clean"
        texts[i] = " ".join(words + ["%s %s" % tuple(rng.choice(telling, 2))] * (i % 5 == 0))
    texts[600], domain[600] = texts[0], "clean"
    rows = [(i, 1, int(domain[i] == "toxic")) for i in texts if i < 300 or i == 600]
    return docs(*texts.items()), domain, spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_mixing_keeps_clean_documents_without_label(spark, docs):
    frame, domain, labels = _made_up(spark, docs)
    targets = {"clean": 0.95, "toxic": 0.05}
    rows = mixing.rates(frame, mixing.domains(labels), targets, floors={"clean": 1.0}, keep="clean").collect()
    assert not [r.doc_id for r in rows if domain[r.doc_id] == "clean" and r.copies < 1]
    assert sum(r.copies == 0 for r in rows if domain[r.doc_id] == "toxic") > 40


@pytest.mark.parametrize(
    "attributes",
    [
        'style="overflow:hidden"', 'title="a hidden valley"', 'data-hidden="false"', "data-id=menu", 'title="class=ad"',
        'class="content with-sidebar"', "class='main sidebar-right'", 'class="layout__has-menu"', "aria-hidden=false",
    ],
)
def test_attributes_that_do_not_hide(attributes):
    assert html_extract.main_text(f"<div {attributes}><p>Kept words</p></div>") == "Kept words"


@pytest.mark.parametrize("link", ["/tips/hidden-gems", "/p?id=menu", "/a?class=ad"])
def test_links_keep_their_words(link):
    for more in ("", " class=share", " role=menu"):
        page = f'<article><p>See <a href="{link}"{more}>these words</a> here</p></article>'
        assert html_extract.main_text(page) == "See these words here"


@pytest.mark.parametrize(
    "attributes",
    ["hidden", 'hidden=""', "aria-hidden='true'", "class='box main-sidebar'", "id=site-nav", "ROLE=banner", "title='a > b' class=ad"],
)
def test_attributes_that_hide(attributes):
    assert html_extract.main_text(f"<p>Kept</p><div {attributes}><p>Gone</p></div>") == "Kept"


LONG = "long text " * 400


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<div><h2>Heading</h2></div><div><p>{LONG}</p></div><div><p>The end.</p></div>", f"Heading {LONG}The end."),
        (f"<body><div id=a><div><p>Short</p></div><div><div><p>{LONG}</p></div></div></div>", f"Short {LONG}".strip()),
        (f"<div><p>First.</p><div class=ad>Buy</div><p>{LONG}</p><aside>x</aside><svg></svg><p>Last.</p></div>", f"First. {LONG}Last."),
        (f"<nav>Menu</nav><div><p>Opening.</p><iframe></iframe><p>{LONG}</p></div><footer>f</footer>", f"Opening. {LONG}".strip()),
    ],
)
def test_short_parts_of_pages_built_of_divs(page, text):
    assert html_extract.main_text(page) == text


def test_added_tokens_as_the_library_encodes_them(docs):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(TOKENIZER)
    added = [t.content for t in plain.get_added_tokens_decoder().values()]
    assert "<|endoftext|>" in added
    texts = ["a <|endoftext|> b", "x<|endoftext|>", "<|endoftext", "the end", *(f"in{a}side it {a}\n{a} {a}." for a in added)]
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    coder = token_files.WordEncoder(TOKENIZER)
    for _ in range(2):
        assert [np.frombuffer(x, coder.kind).tolist() for x in coder.encode(texts)] == want
    got = token_files.round_trip(docs(*enumerate(texts)), TOKENIZER).orderBy("doc_id").collect()
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in got] == [[*ids, 2] for ids in want]


def test_lengths_are_opened_by_class():
    sizes = [49, 46, 46, 24, 23, 18, 13, 12, 10, 9, 6, 3, 3]
    *_, used, final = packing.pack_shard(sizes, (10, 25, 50), 2)
    assert sum(used) == sum(sizes) and all(u <= f for u, f in zip(used, final))
    assert sum(final) + 2 * len(used) == 284  # one way to open for all pieces costs 287 or more


def test_parts_of_texts_as_the_library_encodes_them(monkeypatch):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(TOKENIZER)
    pieces = ["don", "'s", "'", "×", "÷", "é", "Ж", "ж", "ß", "…", "“", "-", ".", ",%", "7", "٣", " ", "\n", " ", "\t", " ", "x", "é", "漢", "_", "ⅷ", "🙂", "ʼ"]
    rng = np.random.default_rng(3)
    texts = ["", *("".join(rng.choice(pieces, rng.integers(0, 12))) for _ in range(4000)), ""]
    want = [np.array(e.ids, "<u2").tobytes() for e in plain.encode_batch(texts, add_special_tokens=False)]
    coder = token_files.WordEncoder(TOKENIZER)
    assert coder.encode(texts) == want
    monkeypatch.setattr(token_files, "REMEMBERED", 50)  # words are forgotten all the time
    assert [coder.encode(texts[i : i + 37]) for i in range(0, len(texts), 37)] == [want[i : i + 37] for i in range(0, len(texts), 37)]


def test_remembered_parts_are_bounded_by_their_bytes(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "REMEMBERED_BYTES", 100_000, raising=False)
    rng = np.random.default_rng(5)
    texts = ["".join(map(chr, rng.integers(0x4E00, 0x9000, 1000))) for _ in range(200)]
    coder, found, held = token_files.WordEncoder(TOKENIZER), [], []
    for i in range(0, len(texts), 5):
        found += coder.encode(texts[i : i + 5])
        held.append(coder.known.nbytes + coder.ids.nbytes)
    assert max(held) <= 100_000
    assert found == [np.array(e.ids, "<u2").tobytes() for e in Tokenizer.from_file(TOKENIZER).encode_batch(texts, add_special_tokens=False)]


def test_words_met_before_cost_little():
    from tokenizers import Tokenizer

    rng = np.random.default_rng(4)
    letters = np.array(list("etaoinshrdlu"))
    pool = np.array(["".join(w) for w in rng.choice(letters, (60_000, 9))])
    texts = [" ".join(pool[(60_000 * rng.random(500) ** 2).astype(int)]) for _ in range(1500)]

    def took(encode):
        began = time.process_time()
        encode(texts)
        return time.process_time() - began

    coder = token_files.WordEncoder(TOKENIZER)
    plain = took(lambda texts: Tokenizer.from_file(TOKENIZER).encode_batch_fast(texts, add_special_tokens=False))
    assert took(lambda texts: [coder.encode(texts[i : i + 500]) for i in range(0, 1500, 500)]) < plain / 4


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=9), min_size=1, max_size=9))
def test_documents_are_packed_as_if_alone(rows):
    counts, ranks = np.array([len(r) for r in rows]), np.array([x for r in rows for x in r], np.uint32)
    control, data = token_files.pack_documents(ranks, counts)
    alone = [token_files.pack_ranks(np.array(r, np.uint32)) for r in rows]
    assert list(zip(control.to_pylist(), data.to_pylist())) == alone
    joined = (np.frombuffer(b"".join(column.to_pylist()), np.uint8) for column in (control, data))
    assert token_files.unpack_documents(*joined, counts).tolist() == ranks.tolist()
