"""State maps of chunks, their prefix scan in Spark, against the tokenizer's library."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

from clickloom.llm import tokcount
from clickloom.llm.store import Scratch

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["a", "the", "ing", " ", "  ", "\n", "\t", "'", "'s", "'re", "'r", "'v", "'ll", "é", "漢", "字", "1", "23", "!", "?!", " ", "　", "😀", "<|endoftext|>", "<|endo", "x" * 7, " " * 5, "\r\n"]


def _texts(n: int, seed: int, most: int) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice(ODD) for _ in range(r.randint(1, most))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(VOCABULARY)
    return lambda s: len(t.encode(s, add_special_tokens=False).ids)


def test_maps_applied_in_turn(library):
    c = tokcount.counter(VOCABULARY)
    for i, text in enumerate(_texts(1500, 1, 40)):
        want = library(text)
        for chunk in (1, 2, 3, 7, 1 + i % 64, 1 << 16):
            assert tokcount.count_tokens(c, text, chunk) == want, (text, chunk)


def test_maps_compose_in_any_grouping():
    """A chunk's map on a state is the map of its halves, one after the other."""
    c, r = tokcount.counter(VOCABULARY), random.Random(2)
    for text in _texts(300, 3, 30):
        if "<|" in text:
            continue
        at = tokcount.START
        for _ in range(3):
            i = r.randint(0, len(text))
            a, b, whole = (tokcount.chunk_map(c, t, False) for t in (text[:i], text[i:], text))
            middle, n = tokcount.apply_map(c, a, at)
            end, m = tokcount.apply_map(c, b, middle)
            assert (end, n + m) == tokcount.apply_map(c, whole, at)
            at = end


@pytest.mark.parametrize("chunk", [5, 64])
def test_scan_in_spark(spark, library, chunk):
    r = random.Random(4)
    texts = [*_texts(60, 5, 60), "漢字" * 200, " " * 333, "ab" * 400, "\n \n" * 90, "x", "", None, "don'" + "t" * 70]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(3, texts[3]), (None, texts[4]), (5, r.choice(texts[:60]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("clash"))
    out = tokcount.token_counts(docs, VOCABULARY, limit=50, chunk=chunk).collect()
    want = sorted((i if i is not None else -1, len((t or "").encode()), n := library(t or ""), n > 50) for i, t in rows)
    assert sorted((x.doc_id if x.doc_id is not None else -1, x.n_bytes, x.n_tokens, x.over_limit) for x in out) == want


def test_wrong_guesses_are_extended(spark, monkeypatch):
    """Where looking back names the wrong state, maps are extended until all states meet."""
    c = tokcount.counter(VOCABULARY)
    text = "abcdefgh" * 30
    parts = tokcount.cut(c, text, 16)
    rows = [("k", i, *tokcount.chunk_map(c, p, i == len(parts) - 1), tokcount.START if i else None) for i, p in enumerate(parts)]
    chunks = spark.createDataFrame(rows, "key string, seg long, head string, fixed long, out string, guess string")
    scratch = Scratch(spark)
    maps = tokcount.state_maps(chunks, VOCABULARY, scratch)
    assert maps.count() > len(parts)
    found = {x.seg: x for x in tokcount.prefix_scan(maps, scratch).filter(F.col("into") == tokcount.START).collect() if x.out == tokcount.END}
    assert found[len(parts) - 1].n == tokcount.count_tokens(c, text)
