"""BPE against the tokenizers library."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seqprep.llm import bpe
from seqprep.sources.package import ship_package

PATH = public_tokenizers.path("byte_bpe_50k.json")
SPECIAL = "<|endoftext|>"


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_vocabulary(PATH))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts(count=600, seed=5):
    random.seed(seed)
    alphabet = "abcdeT  \n\t'slr漢字éßñ \x1c\x85\x00 　½٣1290!?.," + "🙂"
    made = ["".join(random.choice(alphabet) for _ in range(random.randrange(60))) for _ in range(count)]
    made += [word + random.choice(("", " ", "  ", "\n", SPECIAL)) + word for word in made[:200]]
    return made + ["", " ", "  ", " a", "a ", "a  b", SPECIAL, f" {SPECIAL} x{SPECIAL}{SPECIAL}", "don't WE'LL i'm", "a" * 3000]


def test_same_ids_as_the_library(encoder, library):
    made = texts()
    expected = [found.ids for found in library.encode_batch(made, add_special_tokens=False)]
    actual = [np.frombuffer(encoder.encode(text), np.int32).tolist() for text in made]
    assert actual == expected


def test_caches_that_start_again_change_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "WORD_CACHE", 3)
    monkeypatch.setattr(bpe, "PAIR_CACHE", 3)
    small = bpe.Encoder(bpe.read_vocabulary(PATH))
    for text in texts(100, seed=6):
        assert np.frombuffer(small.encode(text), np.int32).tolist() == library.encode(text, add_special_tokens=False).ids


def test_columns_round_trip(spark, library):
    ship_package(spark)
    made = [text for text in texts(100) if "\x00" not in text] + [None]
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    docs = docs.withColumn("ids", F.lit("x")).withColumn("decoded", F.lit(1)).withColumn("tokens", F.lit(2))
    rows = {row["doc_id"]: row for row in bpe.encode(docs, PATH, decoded="decoded").collect()}
    again = {row["doc_id"]: row for row in bpe.decode(bpe.encode(docs, PATH), PATH, text="back").collect()}
    for number, text in enumerate(made):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert rows[number]["ids"] == ids == again[number]["ids"]
        assert rows[number]["decoded"] == (text or "") == again[number]["back"]


def test_decode_partial_characters_unknown_tokens_and_nulls(spark, library):
    ship_package(spark)
    whole = library.encode("漢字🙂", add_special_tokens=False).ids
    lists = [whole[:1], whole[1:], [], None, [50256, 0], [-5, 99_999_999, 0], [None, 1]]
    frame = spark.createDataFrame(list(enumerate(lists)), "n long, ids array<int>")
    rows = {row["n"]: row["decoded"] for row in bpe.decode(frame, PATH).collect()}
    for number in (0, 1, 2, 4):
        assert rows[number] == library.decode(lists[number], skip_special_tokens=False)
    assert rows[3] is None
    assert rows[5] == library.decode([0]) and rows[6] == library.decode([1])


def test_empty_table(spark):
    ship_package(spark)
    assert bpe.encode(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
