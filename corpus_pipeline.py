"""The training-data pipeline: five operators of `fleetday.llm`, one after the other, over all documents.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. The first
four return the columns of documents; the last returns the encoded mix. Null ids, empty texts, repeated
rows and empty tables are handled as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetday.llm import hyperminhash, mixing, quality_bayes, quality_rules, sentencepiece_viterbi
from fleetday.llm.common import read
from fleetday.sources.tables import stage


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the site-aware classifier accepts. The source serves as host, the language as path."""
    model = quality_bayes.fit(docs, read(spark, sf_dir, "labels"))
    scored = quality_bayes.evidence(docs, model)
    host, path = F.col("source"), F.col("lang")
    table = quality_bayes.sites(scored, host, path)
    return quality_bayes.judge(scored, table, quality_bayes.priors(table), host, path).where("kept").select(docs.columns)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the learned decision list."""
    learned = quality_rules.fit(docs, read(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, learned).where("kept").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that with the smallest id, of every group of near-duplicates.

    Rows are told apart by id and text: rows that share an id but not the text are judged each by its own
    text, a row without an id stays only if no row with an id is in its group, of equal rows one stays.
    """
    noded = _nodes(docs)
    found = hyperminhash.near_duplicates(noded, doc_id="_node").distinct()
    ids = noded.select(F.col("_node").alias("id"), "doc_id").distinct()
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "id")
    first = found.join(ids, "id").groupBy("component").agg(F.min(order)["id"].alias("first"))
    gone = found.join(first, "component").where("id <> first").select(F.col("id").alias("_node"))
    # both steps work on one partitioning by row
    kept = noded.join(gone, "_node", "left_anti").dropDuplicates(["_node"])
    return kept.select(docs.columns)


def _nodes(docs: DataFrame) -> DataFrame:
    """`docs` with `_node`, a number per id and text: the id itself where it has one text, else a hash above all ids.

    Originals tend to have smaller ids than their copies; the search starts from the smallest.
    """
    text = F.xxhash64("text")
    several = docs.where("doc_id is not null").groupBy("doc_id").agg(F.min(text).alias("a"), F.max(text).alias("b")).where("a <> b")
    several = stage(several.select(F.col("doc_id").alias("_shared")), "shared-ids")
    above = 1 << 62
    hashed = F.lit(above) + F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2)
    plain = F.col("doc_id") < above
    if several.isEmpty():
        return docs.withColumn("_node", F.when(plain, F.col("doc_id")).otherwise(hashed))
    joined = docs.join(several, F.col("doc_id") == F.col("_shared"), "left")
    return joined.withColumn("_node", F.when(plain & F.col("_shared").isNull(), F.col("doc_id")).otherwise(hashed)).drop("_shared")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies that the mix takes, in training order."""
    taken = mixing.positions(mixing.curriculum(docs))
    sent = list(dict.fromkeys([*docs.columns, "position", "_key", "copy"]))  # the plan's columns stay behind
    return mixing.in_training_order(taken.select(sent)).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, part, row, ids, n_ids) of every copy in the mix; sorted by (part, row) it is the training order.

    The mix was written range by range, so a row's file and its place there are its place in the mix. Both are
    empty if `docs` wasn't read from files.
    """
    place = {"part": F.col("_metadata.file_name"), "row": F.col("_metadata.row_index")}
    try:
        placed = docs.withColumns(place)
    except AnalysisException:
        placed = docs.withColumns({"part": F.lit(None).cast("string"), "row": F.lit(None).cast("long")})
    return sentencepiece_viterbi.encoded(placed, ["doc_id", "source", "part", "row"]).withColumn("n_ids", F.size("ids"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", rules),
    ("near_duplicates", near_duplicates),
    ("mixing", mix),
    ("sentencepiece", encode),
]

#: The classifiers are learned and the encoder is a search; no SQL gives these rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
