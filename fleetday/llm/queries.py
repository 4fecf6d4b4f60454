"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetday.llm import (
    best_fit_packing, html_consensus, hyperminhash, mixing, periodic_runs, pstable, quality_bayes, quality_rules,
    sentencepiece_viterbi, token_counts, toxicity_crf, url_filter, whitening,
)
from fleetday.llm.common import read
from fleetday.sources.tables import stage


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document, a token counting for the line of its first character."""
    return token_counts.count(read(spark, sf_dir, "documents"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = sentencepiece_viterbi.encoded(read(spark, sf_dir, "documents"), ["doc_id"], check=True)
    return encoded.select("doc_id", "ids", F.size("ids").alias("n_ids"), "restored")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(read(spark, sf_dir, "pages"), url_filter.default_rules(spark))
    site = F.when(F.col("priority") == 2, F.col("rule"))
    return judged.select("page_id", "host", "path", site.alias("rule"), "verdict")


def op4_toxicity_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity_crf.score(docs, *toxicity_crf.fit(docs, read(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", toxicity_crf.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"), "spans",
    )


def op5_pstable(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pstable.near_duplicates(read(spark, sf_dir, "embeddings"), threshold=0.95)
    return found.select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_rules.judge(docs, quality_rules.fit(docs, read(spark, sf_dir, "labels")))
    base = [F.col(f"_c.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return judged.select("doc_id", *base, "base_failed", "kept", "rule_no")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the training positions of its copies (two at most), range-sorted by the first;
    documents that the mix doesn't take come last."""
    mixed = mixing.curriculum(read(spark, sf_dir, "documents").select("doc_id", "text", "source"))

    def position(copy: int):
        at = (copy * F.col("source_size") + F.col("_before")) / F.col("target")
        return F.when(F.col("copies") > copy, F.round(mixing.training_time(at, F.col("_pieces")), 6))

    placed = mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
        position(0).alias("first_position"), position(1).alias("second_position"),
    )
    order = [F.col("first_position").asc_nulls_last(), "doc_id"]
    return placed.repartitionByRange(*order).sortWithinPartitions(*order)


def op8_quality_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' source serves as host, source and language as path."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    model = quality_bayes.fit(docs, read(spark, sf_dir, "labels"))
    # the text is read once: its evidence is a few numbers per document
    scored = stage(quality_bayes.evidence(docs, model).drop("text"), "evidence")
    host, path = F.col("source"), F.col("lang")
    table = quality_bayes.sites(scored, host, path)
    judged = quality_bayes.judge(scored, table, quality_bayes.priors(table), host, path)
    return judged.select("doc_id", F.col("_p").alias("p_text"), "host_rate", "site_rate", "p_good", "kept")


def op9_html_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_consensus.extract(read(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hyperminhash.near_duplicates(read(spark, sf_dir, "documents"), percent=85)
    return found.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"), components=8).withColumnRenamed("id", "vec_id")


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing.pack(read(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth document or so gets repeated words first; see `replanted`."""
    return periodic_runs.collapse(read(spark, sf_dir, "documents"), texts=False, places=periodic_runs.replanted).drop("collapsed")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_url_filter": op3_url_filter,
    "op4_toxicity_crf": op4_toxicity_crf,
    "op5_pstable": op5_pstable,
    "op6_quality_rules": op6_quality_rules,
    "op7_mixing": op7_mixing,
    "op8_quality_bayes": op8_quality_bayes,
    "op9_html_consensus": op9_html_consensus,
    "op10_hyperminhash": op10_hyperminhash,
    "op11_whitening": op11_whitening,
    "op12_best_fit_packing": op12_best_fit_packing,
    "op13_periodic_runs": op13_periodic_runs,
}
