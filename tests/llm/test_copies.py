"""Near copies, embeddings and repeated passages against brute force, with bounds small enough to reach every branch."""

import random

import numpy as np
import pytest
from brute import component_of, near_copies, without_repeats
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from rows_of_text import docs  # noqa: F401

from spanlake.llm import forest, minhash, suffix
from spanlake.llm.components import connected


def test_components(spark, docs):
    rng = random.Random(1)
    pairs = [(rng.randrange(80), rng.randrange(80)) for _ in range(50)] + [(i, i + 1) for i in range(100, 130)] + [(7, 7)]
    frame = spark.createDataFrame([*pairs, (None, 3)], "a bigint, b bigint")
    label, _ = component_of(sorted({x for p in pairs for x in p}), lambda a, b: (a, b) in pairs or (b, a) in pairs)
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert {r.id: r.component for r in connected(frame).collect()} == {i: label[i] for i in linked}
    assert connected(frame.limit(0)).count() == 0


def _edited(rng, words, share):
    return " ".join(f"x{rng.random()}" if rng.random() < share else w for w in words)


def _near_texts():
    """A large group of copies edited to all degrees, a chain, ties, and the odd cases."""
    rng = random.Random(2)
    base = [f"w{i}" for i in range(60)]
    texts = {i: _edited(rng, base, rng.choice([0.01, 0.04, 0.08, 0.12, 0.2])) for i in range(60)}
    chain = [f"c{i}" for i in range(70)]
    texts |= {100 + k: " ".join(chain[2 * k : 2 * k + 50]) for k in range(10)}
    texts |= {200: None, 201: "", 202: " \n", 203: "one", 204: "ONE", 205: "one two", 206: "É a", 207: "é a"}
    texts |= {208 + k: " ".join(["the end"] * (k + 1)) for k in range(4)}
    return texts


@pytest.mark.parametrize("block", [256, 4])
def test_near_copies(docs, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    texts = _near_texts()
    rows = {r.doc_id: r for r in minhash.mark(docs(*texts.items()), size=2).collect()}
    component, sizes = near_copies(texts, 2)
    assert {i: r.n_shingles for i, r in rows.items()} == sizes
    assert {i: r.component_id for i, r in rows.items()} == component
    assert all(r.kept == (r.component_id == i) for i, r in rows.items())


def test_near_copies_rows(docs):
    text = " ".join(f"w{i}" for i in range(30))
    frame = docs((5, text), (5, text), (None, text), (3, text.upper()), (9, None)).withColumn("n", F.lit("x"))
    got = sorted((r.doc_id or 0, r.component_id, r.kept) for r in minhash.mark(frame).collect())
    assert got == [(0, None, True), (3, 3, True), (5, 3, False), (5, 3, False), (9, 9, True)]
    left = minhash.drop_copies(frame)
    assert left.columns == frame.columns and sorted(r.doc_id or 0 for r in left.collect()) == [0, 3, 9]
    assert minhash.mark(frame.limit(0)).count() == 0


def test_min_and_max_estimate_similarity():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    a, b = np.sort(pool[:2000]), np.sort(pool[500:2500])
    shared = np.mean(minhash.signature(a) == minhash.signature(b))
    assert abs(shared - 1500 / 2500) < 0.15


def _vectors():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 16))
    rows = []
    for i in range(400):
        v = centres[i % 8] * rng.uniform(0.5, 2) + rng.normal(size=16) * rng.choice([0.05, 0.15, 0.3])
        rows.append((i, [float(np.float32(x)) for x in v], i % 3))
    rows += [(500 + k, rows[k][1], rows[k][2]) for k in range(20)] + [(530, rows[0][1], rows[0][2])] * 2
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [1.0, None], [float("inf")] * 16]
    rows += [(600 + k, v, 1) for k, v in enumerate(odd)] + [(700, rows[0][1], None), (None, rows[0][1], 0), (701, [1.0, 2.0], 1)]
    return rows


@pytest.mark.parametrize("options", [{}, {"part": 60, "leaf": 16}])
def test_embeddings(spark, options):
    rows = _vectors()
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").withColumn("rep", F.lit(1))
    good = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and None not in v and np.isfinite(v).all() and np.any(v):
            good[i] = (label, len(v), np.array(v) / np.linalg.norm(v))

    def linked(a, b):
        (la, na, x), (lb, nb, y) = good[a], good[b]
        return la == lb and na == nb and float(x @ y) >= 0.93

    component, pairs = component_of(sorted(good), linked)
    links = {i: sum(i in p for p in pairs) for i in good}
    got = forest.mark(frame, **options).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.n_links == links.get(r.vec_id, 0)
        assert r.component_id == component.get(r.vec_id, r.vec_id)
        assert r.kept == (r.vec_id == r.component_id or r.vec_id is None)
    assert forest.mark(frame.limit(0)).count() == 0


def test_smallest_reachable_id():
    rng = np.random.default_rng(9)
    ids = rng.permutation(60)
    near = rng.random((60, 60)) < 0.02
    near |= near.T
    label, _ = component_of(sorted(ids.tolist()), lambda a, b: near[np.flatnonzero(ids == a)[0], np.flatnonzero(ids == b)[0]])
    assert forest._smallest(ids, near).tolist() == [label[i] for i in ids]


def test_prefix_intervals():
    # banana$: suffix array order, common prefixes of neighbours 0 1 3 0 0 2
    assert sorted(suffix.intervals([0, 1, 3, 0, 0, 2])) == [(0, 0, 6), (1, 1, 3), (2, 5, 6), (3, 2, 3)]
    assert list(suffix.intervals([])) == []


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=12), st.binary(max_size=12), st.binary(max_size=6))
def test_common_prefix(a, b, shared):
    a, b = shared + a, shared + b
    want = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    assert suffix.common(a, b) == want


def _passages():
    rng = random.Random(6)
    letters = "abcdefghijklmnop é"
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    shared = [text(rng.randrange(15, 70)) for _ in range(12)]
    texts = {}
    for i in range(120):
        parts = [rng.choice([text(rng.randrange(0, 40)), rng.choice(shared), shared[0]]) for _ in range(rng.randrange(0, 6))]
        texts[i] = "".join(parts)
    whole = text(90)
    for i in range(200, 230):  # copies with one letter changed
        at = rng.randrange(90)
        texts[i] = whole[:at] + rng.choice(letters) + whole[at + 1 :]
    return texts | {300: None, 301: "", 302: "z" * 100, 303: "ab" * 60, 304: texts[205], 305: text(19)}


@pytest.mark.parametrize("group", [4096, 3])
def test_repeated_passages(docs, monkeypatch, group):
    texts = _passages()
    monkeypatch.setattr(suffix, "RANGES", (5, 2, 1))
    frame = docs(*texts.items(), (303, texts[303]))  # a repeated row is no second document
    monkeypatch.setattr(suffix.find_spans, "__defaults__", (suffix.LENGTH, suffix.CORE, group))
    rows = suffix.remove_repeats(frame, length=20, core=8).collect()
    want = without_repeats(texts, 20)
    import hashlib

    assert len(rows) == len(texts) + 1
    for r in rows:
        assert (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) == want[r.id], r.id


def test_passages_of_rows_without_id(docs):
    text = " ".join(str(i * i) for i in range(80))
    got = suffix.remove_repeats(docs((None, text), (1, text), (2, None))).collect()
    assert sorted((r.id or 0, r.n_removed) for r in got) == [(0, 0), (1, 0), (2, 0)]
    assert suffix.remove_repeats(docs((1, "x")).limit(0)).count() == 0


def test_vectors_whose_squares_leave_the_range(spark):
    v = [1.0, 2.0, -3.0]
    sizes = [1.0, 1e200, 1e-200, 1e308 / 3, 5e-324 * 1e10]
    frame = spark.createDataFrame([(i, [x * s for x in v], 1) for i, s in enumerate(sizes)], "vec_id bigint, embedding array<double>, label int")
    got = {r.vec_id: (r.component_id, r.n_links) for r in forest.mark(frame).collect()}
    assert got == {i: (0, len(sizes) - 1) for i in range(len(sizes))}
