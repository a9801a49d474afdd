"""The pipeline, stage by stage, each on what the stage before kept."""

from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from seqprep.sources.spool import spool
from tests.llm.test_mixing import expected_targets
from tests.llm.test_ngram_join import expected as expected_components

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """Rows that go in, and what each stage returns."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = spark.createDataFrame(
        [(9001, None, None, None, None), (9002, "", "en", "odd", 0), (9003, "123 456", "en", "odd", 7), (None, "The of and thing. " * 9, "en", "odd", 1)],
        docs.schema,
    )
    frames = [spool(docs.unionByName(odd).unionByName(docs.filter("doc_id = 3")), "pipeline-test")]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(spool(stage(spark, frames[-1], SF_DIR), "pipeline-test"))
    return frames


def test_stages_keep_the_columns_of_documents(kept):
    assert all(frame.columns == list(corpus_pipeline.COLUMNS) for frame in kept[:-1])
    assert {"doc_id", "n_tokens", "ids"} <= set(kept[-1].columns)


def test_quality_stage(spark, kept):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    before, after = ({r["doc_id"] for r in frame.collect()} for frame in kept[:2])
    wrong = sum((i in after) != bool(labels[i]) for i in before if i in labels)
    assert after < before and wrong / len(labels) < 0.05


def test_language_stage(kept):
    before, after = ({(r["doc_id"], r["text"]) for r in frame.collect()} for frame in kept[1:3])
    assert after == {(i, t) for i, t in before if t and any(c.isalpha() for c in t)}


def test_near_copy_stage(kept):
    """Brute force over distinct rows: numbers in order of ids, null ids last."""
    before = sorted({(r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in kept[2].collect()}, key=str)
    before.sort(key=lambda row: row[:2])
    numbered = [(place, row[2]) for place, row in enumerate(before)]
    found = expected_components(numbered, corpus_pipeline.NEAR_PERCENT, corpus_pipeline.NEAR_WORDS)
    first = [before[place] for place, _, component in found if place == component]
    after = [(r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in kept[3].collect()]
    assert sorted(after, key=str) == sorted(first, key=str)


def test_mixing_stage(kept):
    before, after = (Counter((r["doc_id"], r["source"], r["text"]) for r in frame.collect()) for frame in kept[3:5])
    assert set(after) <= set(before) and set(after.values()) <= {1, 2}
    sizes, taken = Counter(), Counter()
    for (_, source, text), copies in before.items():
        sizes[source] += copies * len((text or "").split())
    for (_, source, text), copies in after.items():
        taken[source] += copies * len(text.split())
    largest = max(len((text or "").split()) for _, _, text in before)
    for source, target in expected_targets(sizes).items():
        assert abs(taken[source] - target) <= largest / 2 + 1


def test_token_stage(kept):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r["doc_id"]: r["text"] for r in kept[4].collect()}
    rows = kept[5].collect()
    assert len(rows) == kept[4].count() and all(r["round_trip"] for r in rows)
    for r in rows:
        assert r["ids"] == library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(r["ids"])
