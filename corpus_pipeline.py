"""Corpus pipeline over ``documents``: toxic documents go, one document of each
group of near copies stays, documents with benchmark passages go, the rest is
encoded. Each stage's rows are written and read again as the next one's
``docs``; all but the last return the columns they were given.

Null text has no words: such rows pass the filters. Where rows repeat or lack a doc_id,
near-dedup takes each row for a document of its own: different texts of one doc_id
all pass, of equal ones one does. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import hyperminhash, pair_index_bpe, suffix_decontamination, toxicity_cnn
from ledgerlens.llm.common import read_table, written


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier, trained on ``labels``, does not reject."""
    return toxicity_cnn.remove_toxic(docs, toxicity_cnn.fit(docs, read_table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of five-word similarity 0.8: that of the smallest doc_id."""
    return hyperminhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no window of ten words of a ``benchmark`` item."""
    return suffix_decontamination.remove_contaminated(docs, suffix_decontamination.blocks(read_table(spark, sf_dir, "benchmark")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row left."""
    import public_tokenizers
    return pair_index_bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", toxicity), ("near dedup", near_dedup), ("benchmark decontamination", decontaminate), ("BPE", encode)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name.replace(" ", "_"))
    return docs
