"""Language identification: phrases against plain substring search, held-out accuracy, odd texts."""

import random
import zlib

from pyspark.sql import functions as F

from spanlake.llm import language, queries
import brute
from rows_of_text import DATA, docs  # noqa: F401

REFERENCES = {"de": " die der und schule haus häuser ", "en": " the of and house school ", "xx": " ☃ "}


def test_phrases_equal_plain_matching():
    rng = random.Random(3)
    words = ["haus", "the", "schoolhouse", "ß", "日本", "x", "dieder", "☃", "é" * 50]
    words += ["".join(rng.choice("dieruhasctø") for _ in range(rng.randint(1, 30))) for _ in range(300)]
    parser = language.Parser(REFERENCES)
    expected = [[brute.cross_parse(w, REFERENCES[name]) for name in parser.names] for w in words]
    assert parser.phrases(words).tolist() == expected
    assert [parser._long(w).tolist() for w in words] == expected


def test_long_texts_and_forgotten_words_count_whole(monkeypatch):
    text = "The house, die Schule " * 300 + "a" * 500 + " 12 und der"
    whole = language.Parser(REFERENCES).totals([text, None, "and"])
    monkeypatch.setattr(language, "PIECE", 100)
    monkeypatch.setattr(language, "REMEMBERED", 3)
    monkeypatch.setattr(language, "STEPPED", 2)
    monkeypatch.setattr(language, "ALONE", 6)
    cut = language.Parser(REFERENCES).totals([text, None, "and"])
    assert cut.tolist() == whole.tolist()
    assert whole[0, -1] == 17 * 300 + 500 + 6 and not whole[1].any()


def test_texts_without_letters_are_undetermined(spark, docs):  # noqa: F811
    rows = docs((1, None), (2, ""), (3, "12 _ ² !"), (4, "die Schule"), (4, "die Schule"), (5, "THE\x00school"), (None, "of the"))
    found = language.predict(rows.withColumn("score", F.lit("mine")), REFERENCES)
    got = sorted(((r.doc_id, r.lang_pred, r.score > 0) for r in found.collect()), key=str)
    expected = [(1, "und", False), (2, "und", False), (3, "und", False), (4, "de", True), (4, "de", True), (5, "en", True), (None, "en", True)]
    assert got == sorted(expected, key=str)
    assert {r.lang_pred for r in language.predict(rows, {}).collect()} == {"und"}
    assert language.predict(rows.limit(0), REFERENCES).count() == 0


def test_equal_costs_give_the_smaller_name():
    assert language.Parser({"b": " one ", "a": " one "}).predict(["one two"])[0] == ["a"]


def test_references_leave_out_words_of_wrongly_labelled_texts(spark, docs):  # noqa: F811
    rows = [(i, "the house of all") for i in range(20)] + [(100 + i, f"die schule und haus{'x' * i}") for i in range(20)]
    named = docs(*rows).withColumn("lang", F.expr("CASE WHEN doc_id < 100 THEN 'en' WHEN doc_id < 102 THEN 'en' WHEN doc_id < 119 THEN 'de' END"))
    # equal texts count once: other words make them different
    named = named.withColumn("text", F.concat_ws(" ", "text", F.format_string("only%s", F.translate(F.col("doc_id").cast("string"), "0123456789", "abcdefghij"))))
    found = language.fit(named)
    assert set(found) == {"de", "en"}
    assert " schule " in found["de"] and " schule " not in found["en"] and " house " in found["en"]
    assert language.fit(named, F.lit(False)) == {}
    few = language.fit(named, documents=3, languages=1, words=4)
    assert list(few) == ["en"] and len(few["en"].split()) == 4


def test_held_out_documents_are_told_apart(spark):
    found = queries.op13_language_id(spark, DATA)
    given = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang")
    rows = found.join(given, "doc_id").collect()
    assert len(rows) == given.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r.lang == r.lang_pred for r in rows if r.held_out and r.lang]
    assert len(held) > 100 and sum(held) >= 0.98 * len(held)
