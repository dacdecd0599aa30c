"""The thin queries opN_<name> over whole tables, with the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, langid, lines, neardup, quality, search, substring, suffix, toxicity, trie


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all texts; a null text is one end token."""
    from .ppm import lm_scores

    return lm_scores(_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of each text, also of null and empty ones; repeated rows are scored each."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.with_scores(docs, _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", (~toxicity.is_training()).alias("held_out"), F.col("tox_score").alias("score"), (F.col("tox_score") >= 0.5).cast("int").alias("predicted"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, hit words and items of each text; a null text has no words, items without id hit but are no items."""
    docs, bench = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontam.digest(decontam.scan(docs.select("doc_id", "text"), bench))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and removed words of each text; a null text has none, a repeated row repeats itself."""
    return substring.digest(substring.strip_repeats(_table(spark, sf_dir, "documents")))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, removed lines and what is left of each text; a null text has no lines and stays null."""
    found = lines.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.col("lines.n").alias("n_lines"), F.size("lines.gone").cast("long").alias("n_removed"), F.col("lines.text").alias("text"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of each text; a null or empty text has no words and fails the base rules."""
    return quality.judged(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of each text; null and empty texts have none, repeated rows are counted each."""
    import public_tokenizers

    from .tokcount import token_counts

    return token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all texts and their places; a null or empty text is its end id alone."""
    import public_tokenizers

    from .packing import pack

    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each text; `und` for null texts and those without a letter, repeated rows are judged each."""
    return langid.languages(_table(spark, sf_dir, "documents"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of each text; null and empty texts stand alone, rows of one id stay in one group."""
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item; null texts and items find nothing."""
    return search.ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations; turns without conv_id are left out."""
    return trie.prefix_trie(_table(spark, sf_dir, "conversations"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and removed bytes of each text; a null text has none, a repeated row repeats itself."""
    return suffix.digest(suffix.strip_repeats(_table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_lm_scoring, op2_line_dedup, op3_quality_rules, op4_token_counts, op5_toxicity, op6_decontamination, op7_substring_dedup, op8_best_fit_packing, op9_language_id, op10_minhash, op11_ranked_search, op12_prefix_trie, op13_suffix_dedup)}
ORACLES: dict[str, str] = {"op2_line_dedup": lines.ORACLE, "op10_minhash": neardup.ORACLE, "op6_decontamination": decontam.ORACLE, "op7_substring_dedup": substring.ORACLE, "op11_ranked_search": search.ORACLE, "op12_prefix_trie": trie.ORACLE, "op13_suffix_dedup": suffix.ORACLE}
