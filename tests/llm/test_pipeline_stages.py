"""Stages of the pipeline on small tables made for them."""

import random

import corpus_pipeline
from seqprep.llm import ngram_join
from tests.llm.test_ngram_join import corpus, expected


def documents(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs.selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "1L AS n_chars").repartition(3)


def test_near_copies_by_five_words_and_four_fifths(spark):
    words = [f"w{i}" for i in range(70)]
    near = [words[:20] + ["x"] + words[21:], words[:10] + ["y"] + words[11:40] + ["z"] + words[41:]]
    rows = [(i, " ".join(text)) for i, text in enumerate([words, *near])] + [(10 + i, t) for i, t in enumerate(corpus(5))]
    smallest = [i for i, _, component in expected(rows, 80, 5) if i == component]
    assert len(smallest) < len([i for i, _, component in expected(rows) if i == component])
    kept = corpus_pipeline.one_of_each(spark, documents(spark, rows), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(smallest)


def test_unrelated_texts_of_few_words_are_not_compared(spark, monkeypatch):
    """Frequent shingles only; near copies and repeated rows among many texts that are neither."""
    monkeypatch.setattr(ngram_join, "PAIRED", 3)
    compared, compare = [], ngram_join._compare

    def counted(rows, percent):
        compared.append(rows.select("set_key").distinct().count())
        return compare(rows, percent)

    monkeypatch.setattr(ngram_join, "_compare", counted)
    random.seed(9)
    texts = [" ".join(random.choices("abcdef", k=60)) for _ in range(250)]
    rows = list(enumerate(texts)) + [(1000 + i, f"{texts[i]} a") for i in range(4)] + [(7, texts[7])] * 2 + [(2000, texts[9])]
    kept = corpus_pipeline.one_of_each(spark, documents(spark, rows), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(250))
    assert 8 <= sum(compared) < 20


def test_rows_of_one_id_and_rows_without_id(spark):
    one, two = " ".join(f"w{i}" for i in range(30)), " ".join(f"v{i}" for i in range(30))
    rows = [(1, one), (2, two), (3, one), (3, "alone in the table it stays"), (None, two), (None, "so does this one here"), (None, "so does this one here")]
    kept = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.one_of_each(spark, documents(spark, rows), "").collect()), key=str)
    assert kept == sorted([(1, one), (2, two), (3, rows[3][1]), (None, rows[5][1])], key=str)


def test_stages_on_empty_tables_long_texts_and_clashing_columns(spark, tmp_path):
    spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    extra = "*, 1 AS size, 2 AS digits, 3 AS copies, 4 AS row_key, 5 AS found, 6 AS quality_score, 7 AS ids, 8 AS decoded, 9 AS target"
    long = "The of and thing in a house. " * 150_000
    docs = documents(spark, [(1, "A thing of the and house in. " * 9), (2, "zzz ||| 000"), (3, long), (4, None), (5, "")]).selectExpr(extra.split(","))
    for _, stage in corpus_pipeline.STAGES:
        names = set(stage(spark, docs.filter("doc_id < 0"), str(tmp_path)).columns)
        found = stage(spark, docs, str(tmp_path)).collect()
        assert 3 in {r["doc_id"] for r in found} and {"doc_id", "lang", "source"} <= names
        assert stage(spark, docs.filter("doc_id < 0"), str(tmp_path)).collect() == []
