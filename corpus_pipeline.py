"""Corpus pipeline over ``documents``: language identification, n-gram Jaccard
join, pseudonyms, packing. Each stage takes what its predecessor kept, as
Parquet, and all but the last return the columns of ``documents``.

Defined results: the language stage drops texts whose language can't be told
(null texts and texts without a letter) and nothing else; of each group of near
duplicates the document of least id stays (of several texts of that id one),
documents without words have no group and stay, and repeated rows of one id and
text stay once; in texts that change, ``n_chars`` is counted anew. Rows without
an id come last in their group and are told apart by their text. Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from bizlens.llm import jaccard, langid, packing, pii
from bizlens.llm.common import documents, perhaps_in, stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: keeps the documents whose language can be told. The
    labelled text to learn from is that of the documents at hand."""
    told = langid.identify(docs, langid.learn(docs))
    return told.where(F.col("lang_pred") != "und").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2 on shingles of five words at a Jaccard similarity of 0.8 or
    more: one document of each group stays."""
    found = stored(jaccard.jaccard_components(docs, shingle=5, percent=80, keys=True), "groups")
    texts = found.groupBy("doc_id", "text_key").agg(F.count("*").alias("rows"), F.first("component").alias("component"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key", "rows")).alias("first")
    keep = (texts.where("component is null").select("doc_id", "text_key", "rows")
            .unionByName(texts.where("component is not null").groupBy("component").agg(first).select("first.doc_id", "first.text_key", "first.rows"))
            .withColumnsRenamed({"doc_id": "kept_id", "text_key": "kept_key"}))
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("text_key") == F.col("kept_key"))
    told = stored(texts.join(keep.drop("rows"), same, "left").select("doc_id", "text_key", "rows", F.col("kept_key").isNotNull().alias("kept")), "kept")
    # texts that stay as they are take no part in the joins
    asked = perhaps_in(told.where("not kept or rows > 1").select(F.xxhash64("doc_id", "text_key")))(F.xxhash64(F.col("doc_id").cast("long"), F.xxhash64("text")))
    clear, docs = docs.where(~asked), docs.where(asked)
    keep = told.where("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_key").alias("kept_key"), "rows")
    kept = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.xxhash64("text") == F.col("kept_key"))
    once = clear.unionByName(docs.join(keep.where("rows = 1"), kept, "left_semi"))
    repeated = keep.where("rows > 1")
    if repeated.isEmpty():
        return once
    more = docs.join(repeated, kept, "left_semi")
    return once.unionByName(more.dropDuplicates(["doc_id", "text"]))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: validated personal data is replaced by pseudonyms."""
    made = pii.pseudonyms(docs)
    changed = F.col("pii_count") > 0
    return made.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: the pieces of every document and their places in sequences."""
    import public_tokenizers as vocabularies

    return packing.pack_documents(docs, vocabularies.path("word_bpe_49k.json"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("pseudonyms", pseudonyms), ("packing", packed)]

#: SQL can't express the stages' methods; tests hold each stage against a plain form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
