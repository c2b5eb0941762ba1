"""The corpus pipeline: stages over documents, each written as Parquet and read again as the next one's input.

identify   rows whose language the models reject go (null texts, texts without a letter, texts unlike any language), the others take the predicted one; models of other rows judge each
dedupe     one document of each group of texts with a five-word similarity of 0.8 or more stays
clean      documents that overlap a benchmark item go
redact     spans of personal data in the texts give way to their kinds
encode     the texts' tokens: doc_id, lang, source, n_tokens and the digests of ids and decoded bytes

All but the last return the columns of documents. Rows with a null doc_id pass; a null lang isn't learned from, and every
kept row takes the predicted language. Empty tables give empty results; repeated rows are one document from the second
stage on, of ties the least doc_id stays; very long texts are read whole; other columns of documents are carried along,
whatever their names, but for those that begin with two underscores.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tariffa.llm import bpe, common, decontaminate, langid, minhash, pii


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.identified(docs)


def dedupe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.one_of_each_group(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, common.table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path, pattern = bpe.vocabulary()
    return bpe.tokenise(docs, path, pattern, keep=("doc_id", "lang", "source"))


STAGES = [("language_id", identify), ("ngram_jaccard_join", dedupe), ("decontaminate", clean), ("pii", redact), ("byte_bpe", encode)]
#: SQL can't express the language models, MinHash or BPE; tests/llm checks the stages against brute force.
ORACLE_SQL = None


def _finished(spark: SparkSession, path: str) -> bool:
    """Whether a write below path has been committed."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    marker = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(conf).exists(marker)


def run(spark: SparkSession, sf_dir: str, run_id: str | None = None) -> DataFrame:
    """The last stage's rows; each stage before it is written below the shared folder and read again.

    A run that is given the id of one that broke off goes on behind its last finished stage. The stages' outputs stay in
    `pipeline-<run_id>`, as the returned rows are computed from the last of them when they are used.
    """
    docs = common.table(spark, sf_dir, "documents")
    folder = f"{common.shared_folder(spark)}/pipeline-{run_id or uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        path = f"{folder}/{name}"
        if not _finished(spark, path):
            stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
