"""Quality rules and line dedup: SQL on whole tables, small cases with defined results, plans without user functions."""

import random
from pathlib import Path

import duckdb
import pytest
from brute import without_frequent_lines
from pyspark.sql import functions as F
from rows_of_text import DATA, docs  # noqa: F401

from spanlake.llm import line_dedup, mixing, quality
from spanlake.llm.queries import oracle_sql, queries


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for path in Path(DATA).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    want = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in want.description]
    got = queries()[name](spark, DATA)
    assert sorted(got.columns) == sorted(columns)
    rows = sorted(tuple(r) for r in got.select(*columns).collect())
    assert rows and rows == sorted(want.fetchall())


def test_native_plans(spark, docs):
    for frame in (quality.judge(docs((1, "a"))), line_dedup.drop_lines(docs((1, "a")))):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


GOOD = " ".join(f"word{i} the thing{i} of" for i in range(20))


def judged(frame):
    return {r.doc_id: r for r in quality.judge(frame).collect()}


def test_quality_cases(docs):
    rows = judged(docs((1, GOOD), (2, None), (3, ""), (4, " \n\t "), (5, "a b c " * 30), (6, GOOD + " #" * 40), (6, GOOD)))
    assert rows[1].kept and not rows[1].base_failed and rows[1].n_words == 80
    assert all(rows[i].base_failed and rows[i].n_words == 0 and not rows[i].kept for i in (2, 3, 4))
    assert rows[5].n_repeat_words == 90 and rows[5].base_failed


def test_symbols_reject(docs):
    row = judged(docs((1, GOOD + " #" * 40)))[1]
    assert row.n_symbols == 40 and not row.base_failed and not row.kept and row.failed_rules == "symbols per word"


def test_repeated_words_by_brute_force(docs):
    rng = random.Random(4)
    texts = {i: " ".join(rng.choice("abcdef") for _ in range(rng.randrange(0, 60))) for i in range(60)}
    texts[99] = " ".join(f"w{i % 700}" for i in range(1500))  # many repeated hashes: all windows are sorted

    def covered(text):
        words = text.split()
        grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        return len({p for i, g in enumerate(grams) if grams.count(g) > 1 for p in (i, i + 1, i + 2)})

    got = {i: r.n_repeat_words for i, r in judged(docs(*texts.items())).items()}
    assert got == {i: covered(t) for i, t in texts.items()}


def test_filter_keeps_columns_with_clashing_names(docs):
    frame = docs((1, GOOD), (2, "short"), (1, GOOD)).withColumn("n_words", F.lit("x")).withColumn("kept", F.lit(3))
    left = quality.filter_documents(frame)
    assert left.columns == frame.columns
    assert [(r.doc_id, r.n_words, r.kept) for r in left.collect()] == [(1, "x", 3), (1, "x", 3)]


def test_empty_tables(docs):
    empty = docs((1, "x")).limit(0)
    assert quality.judge(empty).count() == 0 and quality.filter_documents(empty).count() == 0
    assert line_dedup.drop_lines(empty).count() == 0


LINE = "This line is long enough to be counted by the rule, é."


def test_lines_by_brute_force(docs):
    rng = random.Random(5)
    lines = [LINE, LINE.upper(), "  " + LINE.lower() + "\t", "É" * 45, "é" * 45, "short", "", *(f"line number {i} " * 4 for i in range(6))]
    texts = {i: "\n".join(rng.choice(lines) for _ in range(rng.randrange(0, 9))) for i in range(50)}
    texts |= {60: None, 61: "", 62: "\n\n", 63: LINE + "\n" + LINE}
    got = line_dedup.drop_lines(docs(*texts.items())).collect()
    assert {r.doc_id: r.text for r in got} == without_frequent_lines(texts)
    assert all(r._n_lines == len((texts[r.doc_id] or "").split("\n")) for r in got)
    assert all(r._n_dropped == r._n_lines - len(r.text.split("\n")) for r in got if r.text)


def test_rows_without_id_and_repeated_rows(docs):
    rows = [(i, LINE) for i in range(5)] + [(None, LINE), (3, LINE)]
    got = line_dedup.drop_lines(docs(*rows)).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.text) for r in got if r.doc_id is not None) == sorted(
        (False, i, LINE if i == 4 else "") for i in (0, 1, 2, 3, 3, 4)
    )
    assert [r.text for r in got if r.doc_id is None] == [LINE]
    # four documents and a repeated row are no five documents
    four = line_dedup.drop_lines(docs(*[(i, LINE) for i in range(4)], (0, LINE))).collect()
    assert all(r._n_dropped == 0 for r in four)


CLASHING = ["id", "_id", "row", "_row", "_text", "_lines", "_words", "lines", "kept", "drops", "t", "_n_lines", "_n_dropped", "n_words", "h1", "pos", "copy", "copies", "known", "own"]


def test_columns_with_clashing_names_stay(spark, docs):
    import corpus_pipeline

    text = " ".join(f"the word{i % 7} of{i}" for i in range(60))
    shared = "a line that is found in very many of the documents of this test"
    frame = docs(*((i, f"{text} {i}\n{shared}") for i in range(8)))
    extra = frame.select("*", *(F.concat(F.lit(f"{c}:"), "doc_id").alias(c) for c in CLASHING))

    def check(rows):
        assert rows.columns == extra.columns
        found = rows.collect()
        assert found and all(r[c] == f"{c}:{r.doc_id}" for r in found for c in CLASHING)
        return found

    check(quality.filter_documents(extra))
    judged = quality.judge(extra)
    assert all(r._text == f"_text:{r.doc_id}" and r.n_words > 100 for r in judged.collect())
    left = check(corpus_pipeline.dedup_lines(spark, extra, ""))
    assert [shared in r.text for r in sorted(left, key=lambda r: r.doc_id)] == [False] * 7 + [True]
    counted = line_dedup.drop_lines(extra).collect()
    assert {(r._n_lines, r._n_dropped) for r in counted} == {(2, 1), (2, 0)}
    check(corpus_pipeline.dedup_documents(spark, extra, ""))
    check(mixing.mix(extra, spark.createDataFrame([], "doc_id bigint, domain string"), {"clean": 1.0}))


def test_different_texts_of_one_id_lose_their_own_lines(docs):
    line = "a line that is found in very many of the documents of this test"
    rows = [(i, f"x\n{line}") for i in range(6)] + [(0, f"{line}\ny"), (0, f"{line}\ny")]
    left = line_dedup.drop_lines(docs(*rows)).collect()
    assert sorted(r.text for r in left) == sorted(["x"] * 5 + [f"x\n{line}"] + ["y"] * 2)
