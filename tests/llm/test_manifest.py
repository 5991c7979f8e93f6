"""Merkle manifest: leaves, roots and proofs against plain trees."""

import zlib

import pytest
from pyspark.sql import functions as F

from spanlake.llm import manifest
from spanlake.llm.common import lower_ascii
import brute
from rows_of_text import DOCUMENTS, docs  # noqa: F401

def lowered():
    return {"text": lower_ascii(F.col("text"))}


def is_tampered(id):
    return id is not None and zlib.crc32(str(id).encode()) % 5 == 0


def proofs(rows):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = manifest.climb(manifest.build(rows, lowered(), tampered))
    return sorted(map(tuple, found.collect()), key=str)


def row(i, source="s", text="Some Text", lang="en"):
    return (i, text, lang, source, None if text is None else len(text))


SMALL = {
    "none": [],
    "one": [row(1)],
    "one source": [row(i) for i in range(40)],
    "exactly a node": [row(i) for i in range(16)],
    "last run of one": [row(i) for i in range(17)],
    "single sources": [row(i, f"s{i}") for i in range(20)],
    "nulls": [row(None), row(None, None), row(3, None, None, None), row(4, ""), row(5, "top"), row(6, "s", ""), row(7, "é", "Ünï A\x00b")],
    "repeated": [row(2)] * 18 + [row(2, text="Other")] * 3,
    "deep": [row(i, "hot" if i % 3 else None, f"Text {i}") for i in range(600)] + [row(i, "cold") for i in range(700, 703)],
}


@pytest.mark.parametrize("name", SMALL)
def test_proofs_equal_plain_trees(spark, docs, name):  # noqa: F811
    docs()
    rows = spark.createDataFrame(SMALL[name], DOCUMENTS)
    assert proofs(rows) == sorted(brute.merkle_proofs(SMALL[name], is_tampered), key=str)


def test_copies_of_upper_nodes_give_the_same_proofs(spark, docs, monkeypatch):  # noqa: F811
    docs()
    monkeypatch.setattr(manifest, "GROUPS_PER_COPY", 2)
    rows = spark.createDataFrame(SMALL["deep"], DOCUMENTS)
    assert proofs(rows.repartition(7)) == sorted(brute.merkle_proofs(SMALL["deep"], is_tampered), key=str)


def test_other_columns_are_ignored_and_order_does_not_matter(spark, docs):  # noqa: F811
    docs()
    rows = spark.createDataFrame(SMALL["one source"], DOCUMENTS)
    clashing = rows.selectExpr("*", *(f"'x' AS {c}" for c in ("id", "tree", "digest", "start", "place", "n", "part", "row", "run")))
    assert proofs(clashing.orderBy(F.desc("doc_id"))) == proofs(rows)


def test_untouched_rows_verify_and_changed_ones_do_not(spark, docs):  # noqa: F811
    docs()
    rows = spark.createDataFrame(SMALL["deep"], DOCUMENTS)
    found = manifest.climb(manifest.build(rows, lowered(), F.col("doc_id").isin(5, 599)))
    assert {r.id for r in found.where("NOT verified").collect()} == {5, 599}
    assert found.where("verified").count() == 601
