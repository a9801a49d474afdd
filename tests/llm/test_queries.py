"""Registered queries of the training-data operators: contract columns, SQL, brute force."""

import hashlib
import os
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as driver
from pyspark.sql import functions as F
from seqprep.llm import queries, url_filter
from tests.llm.test_ngram_join import expected as expected_components
from tests.llm.test_url_filter import expected_rule, parts
from tests.test_queries import _sorted_rows, duck  # noqa: F401

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
COLUMNS = {
    "op1_language_id": {"doc_id", "held_out", "lang_pred", "score"},
    "op2_main_text": {"page_id", "url", "text", "n_chars"},
    "op3_bpe": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op4_embedding_dedup": {"vec_id", "n_links", "component_id", "kept"},
    "op5_quality": {"doc_id", "held_out", "score", "predicted"},
    "op6_warc": {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"},
    "op7_topk": {"query_id", "rank", "vec_id", "score"},
    "op8_mixing": {"doc_id", "size", "source_size", "target", "taken"},
    "op9_ngram_join": {"doc_id", "n_shingles", "component_id"},
    "op10_lm_score": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op11_collocations": {"lang", "rank", "phrase", "a", "l", "r", "n", "score"},
    "op12_url_filter": {"page_id", "host", "path", "rule", "verdict"},
    "op13_ptolemaic": {"vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"},
}


def table(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def test_all_are_registered():
    assert set(COLUMNS) == set(queries.REGISTRY) and set(COLUMNS) | {"pipeline"} <= set(driver.queries())
    assert set(queries.ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, duck, name):  # noqa: F811
    result = queries.REGISTRY[name](spark, SF_DIR)
    assert COLUMNS[name] <= set(result.columns)
    cursor = duck.execute(queries.ORACLES[name])
    columns = [column[0] for column in cursor.description]
    actual = [tuple(row) for row in result.collect()]
    assert len(actual) > 0 and sorted(result.columns) == sorted(columns)
    assert _sorted_rows(result.columns, actual) == _sorted_rows(columns, cursor.fetchall())


def test_language_id(spark):
    rows = queries.op1_language_id(spark, SF_DIR).join(table(spark, "documents").select("doc_id", "lang"), "doc_id").collect()
    assert COLUMNS["op1_language_id"] <= set(rows[0].asDict())
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"] and r["lang"] is not None]
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97


def test_quality(spark):
    rows = queries.op5_quality(spark, SF_DIR).join(table(spark, "labels"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["quality"] == r["predicted"] for r in held) / len(held) > 0.95


def test_bpe(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, "documents").collect()}
    rows = queries.op3_bpe(spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        back = library.decode(ids, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()


def test_ngram_join(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, "documents").collect()]
    rows = queries.op9_ngram_join(spark, SF_DIR).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows), key=str) == expected_components(docs)


def test_main_text(spark):
    pages = {r["page_id"]: r["html"] for r in table(spark, "pages").collect()}
    rows = queries.op2_main_text(spark, SF_DIR).collect()
    assert sorted(r["page_id"] for r in rows) == sorted(pages)
    for r in rows:
        assert r["n_chars"] == len(r["text"]) and "<" not in r["text"].replace("< ", "")
        assert r["text"].split("\n")[0] in " ".join(pages[r["page_id"]].replace("&amp;", "&").split())


def test_url_filter(spark):
    pages = {r["page_id"]: r["url"] for r in table(spark, "pages").collect()}
    rows = queries.op12_url_filter(spark, SF_DIR).collect()
    assert COLUMNS["op12_url_filter"] <= set(rows[0].asDict()) and sorted(r["page_id"] for r in rows) == sorted(pages)
    for r in rows:
        rule = expected_rule(pages[r["page_id"]])
        assert (r["host"], r["path"]) == parts(pages[r["page_id"]]) and r["rule"] == (rule and rule.text)
        assert r["verdict"] == (rule.verdict if rule else "block" if r["block_score"] >= 0.5 else "allow")


def test_url_trees_agree_with_rules_on_urls_not_seen(spark):
    ruled = url_filter.with_rules(table(spark, "pages")).filter("ruled IS NOT NULL")
    ruled = ruled.withColumn("label", (F.col("ruled") == "block").cast("int"))
    unseen = queries.remainder("page_id", 4) == 2
    model = url_filter.train(ruled.filter(~unseen))
    judged = url_filter.judge(ruled.filter(unseen).drop("rule"), model, rules=()).collect()
    assert sum((r["verdict"] == "block") == r["label"] for r in judged) / len(judged) > 0.95
