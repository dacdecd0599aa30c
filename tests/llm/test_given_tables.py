"""Queries of the operators against their SQL on the smallest tables, and rows that repeat."""

from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from clickloom.llm import entry, packing, substring, tokcount, toxicity

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are absent")
@pytest.mark.parametrize("name", sorted(entry.ORACLES))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = con.execute(entry.ORACLES[name])
    columns = [c[0] for c in found.description]
    df = entry.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(str, df.select(*columns).collect())) == sorted(map(str, (spark_row(columns, r) for r in found.fetchall())))


def spark_row(columns, values):
    from pyspark.sql import Row

    return Row(**dict(zip(columns, values, strict=True)))


def repeated(spark):
    """Each row twice, an id with two texts, ids and texts that are null, and a column that operators use inside."""
    long = " ".join(f"w{i}" for i in range(40))
    rows = [(1, "first text here"), (1, "first text here"), (1, "another one"), (2, long), (2, long), (None, "no id"), (None, None), (3, ""), (3, "")]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("block", F.lit("x"))


def test_repeated_rows_are_counted_each(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok, d = Tokenizer.from_file(path), repeated(spark)
    want = sorted((r.doc_id or 0, len(tok.encode(r.text or "", add_special_tokens=False).ids)) for r in d.collect())
    assert sorted((r.doc_id or 0, r.n_tokens) for r in tokcount.token_counts(d, path).collect()) == want
    assert tokcount.token_counts(d.filter("false"), path).collect() == []
    pieces = packing.pack(d, path).collect()
    assert sorted((r.doc_id or 0, r.length - 1) for r in pieces) == want
    assert len({(r.sequence_id, r.offset) for r in pieces}) == len(pieces)


def test_repeated_rows_repeat_themselves(spark):
    out = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in substring.strip_repeats(repeated(spark)).collect())
    assert out == [(0, 0, 0), (0, 2, 0), (1, 2, 0), (1, 3, 0), (1, 3, 0), (2, 40, 40), (2, 40, 40), (3, 0, 0), (3, 0, 0)]


def test_repeated_rows_are_scored_alike(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (None, 1)], "doc_id long, toxic int")
    out = toxicity.with_scores(repeated(spark), labels).collect()
    assert len(out) == 9 and len({r.tox_score for r in out if r.doc_id == 2}) == 1 and all(0 <= r.tox_score <= 1 for r in out)
