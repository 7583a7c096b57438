"""The corpus pipeline: toxicity, near-duplicates, decontamination, personal data, packing.

Each stage reads its documents from the Parquet files that the stage before it
wrote. run() writes those files to the shared scratch folder. Very long texts are
handled whole in all stages, one at a time in a worker's memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridlode.llm import bagminhash, decontamination, packing, pii, toxicity
from gridlode.llm.common import written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic. The model learns from the stage's own labelled documents.

    A null text is empty and, like empty texts, scored by its all-zero features;
    null and repeated ids and rows are all judged, each by its own text; equal
    texts get equal scores; without documents or labels nothing is dropped;
    columns of any name pass through.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.fit(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class: the smallest doc_id's, null ids last, then the smallest row hash.

    Only texts decide: null or shared ids alone remove nothing, null and empty
    texts are one class; rows that are equal in all columns are one; no
    documents give none; columns of any name pass through, as the helper's name
    is none of theirs.
    """
    helper = "row"
    while helper in docs.columns:
        helper += "_"
    firsts = bagminhash.Duplicates(docs, columns=docs.columns).firsts()
    kept = docs.withColumn(helper, bagminhash.row_hash(docs.columns)).join(firsts.withColumnRenamed("row", helper), helper, "left_semi")
    return kept.select(*docs.columns).distinct()  # a row that is there twice stays once


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items.

    Null and empty texts hold no item and stay; every row is judged by its own
    text, whatever its id, repeated rows too; empty items and an empty benchmark
    drop nothing; columns of any name pass through.
    """
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind and n_chars by the new length.

    Null texts stay null, empty ones empty; spans that overlap are replaced by
    the first one's kind; repeated rows stay; columns of any name pass through.
    """
    return pii.redact(docs, pii.trained())


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2,048 tokens and their places in sequences.

    Null and empty texts are the end token alone; repeated rows are packed as
    often as they occur; pieces of equal length are interchangeable; no
    documents give no pieces; other columns play no part.
    """
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

#: Training, signatures and tokenization are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = written(docs)
    return docs
