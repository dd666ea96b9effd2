import pytest
from pyspark.sql import functions as F

from sellthrough.llm.langid import LanguageModel, held_out, identify, train
from .helpers import documents, prose, rng

LANGS = {"xa": "brakto slimon trevu gandol prixa morten".split(), "xb": "élune oùvera çanti mérole péquis bôlan".split(),
         "xc": "schwugen därfel übermig tzöllen krachte wespel".split()}


@pytest.fixture(scope="module")
def table(spark):
    r = rng(6)
    rows = [(i, prose(r, r.randrange(3, 60), LANGS[lang]), lang, "s", 0) for i in range(300) for lang in [r.choice(sorted(LANGS))]]
    return rows, train(documents(spark, rows), LanguageModel(per_language=60))


def test_held_out_documents(spark, table):
    rows, model = table
    found = identify(documents(spark, rows).withColumn("held", held_out(F.col("doc_id"))), model).collect()
    lang = {r[0]: r[2] for r in rows}
    held = [r for r in found if r.held]
    assert len(held) > 40 and all(r.lang_pred == lang[r.doc_id] and 0.5 < r.score <= 1 for r in held)


def test_unseen_words_back_off_to_ngrams(spark, table):
    found = identify(documents(spark, [(1, "prixagandol MORTENSLIMON"), (2, "mérolecanti"), (3, "übermigtzöll")]), table[1]).collect()
    assert {r.doc_id: r.lang_pred for r in found} == {1: "xa", 2: "xb", 3: "xc"}


def test_odd_rows(spark, table):
    model = table[1]
    long = prose(rng(1), 100_000, LANGS["xb"])
    rows = [(1, None), (2, ""), (3, "12 ... – 34 €"), (4, long), (5, "日本語"), (None, "brakto"), (6, "brakto"), (6, "brakto"), (7, "x" * 600_000)]
    found = identify(documents(spark, rows), model)
    got = [(r.doc_id, r.lang_pred, r.score) for r in found.collect()]
    assert [g for g in got if g[0] in (1, 2, 3)] == [(i, "und", 0.0) for i in (1, 2, 3)]
    assert [g[1] for g in got if g[0] in (4, 6, None)] == ["xb", "xa", "xa", "xa"]
    assert all(0 <= g[2] <= 1 for g in got) and len(got) == len(rows)
    assert found.columns.count("score") == 1 and "key" in found.columns


def test_no_labels_and_no_rows(spark, table):
    nothing = train(documents(spark, [(1, "brakto"), (2, None, "xa")]))
    assert [tuple(r)[-2:] for r in identify(documents(spark, [(1, "brakto")]), nothing).collect()] == [("und", 0.0)]
    assert identify(documents(spark, []), table[1]).collect() == []
