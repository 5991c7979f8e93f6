"""The pipeline's stages one after the other against plain versions of them."""

import random
from collections import Counter

import corpus_pipeline
import numpy as np
from brute import near_copies, without_frequent_lines
from pyspark.sql import functions as F
from rows_of_text import docs  # noqa: F401

from spanlake.llm import mixing, quality
from spanlake.llm.common import table

LICENCE = "All rights to this text are held by nobody at all, and it may be copied."


def _corpus():
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = {}
    for i in range(60):
        lines = [" ".join(rng.choice(vocabulary) + " the" for _ in range(30)) + "." for _ in range(3)]
        texts[i] = "\n".join(lines + [LICENCE] * (i % 3 == 0))
    for i in range(100, 120):
        words = texts[i % 5].split(" ")
        words[rng.randrange(len(words))] = "changed"
        texts[i] = " ".join(words)
    return texts | {200: None, 201: "", 202: "too short", 203: "# $ % " * 40}


def test_stages(spark, docs, tmp_path):
    texts = _corpus()
    frame = docs(*texts.items())
    spark.createDataFrame([(i, 1, int(i % 10 == 7)) for i in range(60)], "doc_id bigint, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r.text for r in frame.collect()}
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, str(tmp_path))
        path = f"{tmp_path}/{name}"
        frame.write.parquet(path)
        frame = spark.read.parquet(path)
        seen[name] = frame
        if name != "packing":
            assert frame.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    kept = {r.doc_id for r in quality.judge(docs(*texts.items())).collect() if r.kept}
    assert {r.doc_id for r in seen["quality rules"].collect()} == kept and not kept & {200, 201, 202, 203}
    left = without_frequent_lines({i: rows[i] for i in kept})
    lines = seen["line dedup"].collect()
    assert {r.doc_id: r.text for r in lines} == left and all(r.n_chars == len(r.text) for r in lines)
    component, _ = near_copies(left, 5)
    assert {r.doc_id for r in seen["near dedup"].collect()} == set(component.values())
    mixed = [r.doc_id for r in seen["mixing"].collect()]
    assert set(mixed) <= set(component.values()) and len(set(mixed)) > 0.7 * len(set(component.values()))
    packed = seen["packing"].groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()
    assert {r.doc_id: r.n for r in packed} == {i: mixed.count(i) * (len(left[i].split()) + 1) for i in set(mixed)}
    again = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, seen["packing"].collect()))


def test_empty_corpus(spark, docs, tmp_path):
    docs((1, "x")).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert table(spark, str(tmp_path), "documents").count() == 0


def test_mixing_stage_keeps_clean_documents(spark, docs, tmp_path):
    rng = np.random.default_rng(3)
    texts, toxic = {}, {i for i in range(600) if i % 5 == 0}
    for i in range(600):
        words = ["the"] * 5 + [f"w{k}" for k in rng.integers(0, 8000, 150)]
        texts[i] = " ".join(words + [f"slur{k}" for k in rng.choice(10, 2)] * (i in toxic))
    labels = spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(300)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    frame = docs(*texts.items())
    mixed = Counter(r.doc_id for r in corpus_pipeline.mix_domains(spark, frame, str(tmp_path)).collect())
    lost = [i for i in texts if i not in toxic and not mixed[i]]
    assert not [i for i in lost if i < 300]
    assert len(lost) < 0.02 * 240  # without label, one below all of 240 held-out ones is rare but may be
    domains = mixing.domains(labels)
    rows = mixing.rates(frame, domains, corpus_pipeline.TARGETS, floors=corpus_pipeline.FLOORS, keep="clean").collect()
    assert all(abs(mixed[r.doc_id] - r.rate) < 1 for r in rows)
