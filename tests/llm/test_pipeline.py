"""The pipeline over small tables against brute force, and the registry's promises."""
import os
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sellthrough.llm.queries import ORACLES, QUERIES
from .helpers import components, prose, rng, with_clashes, word_words

EN, FR = "amber birch cedar delta ember frost grove heron inlet jetty".split(), "éclat rivière forêt château neige été hiver fleur".split()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r, path = rng(11), str(tmp_path_factory.mktemp("tables"))
    vocabulary = {"en": [a + b for a in EN for b in EN], "fr": [a + b for a in FR for b in FR]}
    item = prose(r, 30, vocabulary["en"])
    rows = []
    for i in range(80):
        lang = "fr" if i % 4 == 0 else "en"
        rows.append((i, f"{prose(r, 60, vocabulary[lang])}\nAll rights reserved here.\n{prose(r, 40, vocabulary[lang])}", lang, "ab"[i % 2], 0))
    rows += [(100 + i, rows[3][1], "en", "a", 0) for i in range(5)]                              # copies
    rows += [(110, rows[5][1].rsplit(" ", 1)[0], "en", "a", 0)]                                  # a near copy
    rows += [(120, f"{prose(r, 20, vocabulary['en'])} {item} {prose(r, 20, vocabulary['en'])}", "en", "b", 0)]   # contaminated
    rows += [(130, None, "en", "a", 0), (131, "", None, "a", 0), (132, "1 2 3 ...", "en", None, 0), (133, prose(r, 30, vocabulary["fr"]), None, None, 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "mixing":
            assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        seen[name] = {r.doc_id: r for r in docs.collect()}
    assert {130, 131, 132} & set(seen["language_id"]) == set() and {*range(80), 133} <= set(seen["language_id"])
    lines = seen["line_dedup"]
    assert set(lines) == set(seen["language_id"]) and not any("All rights" in lines[i].text for i in range(80))
    assert all(r.n_chars in (0, len(r.text)) for r in lines.values())
    want = {d for d, (_, c) in components([(d, r.text) for d, r in lines.items()], width=5).items() if c == d}
    assert set(seen["near_dedup"]) == want and {3, 5} <= want and not {100, 104, 110} & want
    assert set(seen["decontamination"]) == want - {120}
    mixed = seen["mixing"]
    assert set(mixed) <= set(seen["decontamination"]) and all(r.copies >= 1 and r.taken == r.copies * len(r.text.split()) for r in mixed.values())
    sizes = {s: sum(len(r.text.split()) for r in seen["decontamination"].values() if r.source == s) for s in ("a", "b", None)}
    taken = {s: sum(r.taken for r in mixed.values() if r.source == s) for s in sizes}
    total = sum(sizes.values())
    assert taken[None] == 3 * sizes[None] and abs(taken["a"] - (total - taken[None]) / 3) < 110 and abs(taken["b"] - (total - taken[None]) * 2 / 3) < 110


def test_columns_of_any_name_pass_and_empty_tables_work(spark, folder, tmp_path):
    docs = with_clashes(spark.read.parquet(f"{folder}/documents.parquet").limit(40)).withColumn("quality", F.lit("clash"))
    own = [c for c in docs.columns if c not in ("doc_id", "text", "lang", "source", "n_chars", "copies")]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() and docs.select(*own).distinct().collect() == [tuple("clash" for _ in own)], name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    for table in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{folder}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_run_is_the_stages_in_order(spark, folder):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "mixing"]
    found = corpus_pipeline.run(spark, folder)
    assert found.count() > 50 and {"doc_id", "text", "lang", "source", "n_chars", "copies"} <= set(found.columns)


def test_every_operator_has_one_query():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)


def test_nothing_else_imports_the_operators():
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    for folder, _, files in os.walk(os.path.join(root, "sellthrough")):
        if os.path.basename(folder) != "llm":
            for name in (f for f in files if f.endswith(".py")):
                assert not re.search(r"\bllm\b", open(os.path.join(folder, name)).read()), name
    assert word_words("Größe ABC_d") == ["größe", "abc", "d"]
