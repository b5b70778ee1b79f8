"""The training-text pipeline: rejected documents go, one of each near-duplicate group stays, personal data is
masked, and what is left is packed into token sequences. Each stage's result is written and read again."""

import uuid

from pyspark import cloudpickle
from pyspark.sql import functions as F

import hubbub
from hubbub.llm import ngram_join, packing, pii, quality
from hubbub.llm.shared import table
from hubbub.session import shared_dir

cloudpickle.register_pickle_by_value(hubbub)


def quality_classifier(spark, docs, sf_dir):
    """Documents that the classifier does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def ngram_jaccard_join(spark, docs, sf_dir):
    """One document, the one with the smallest id, of each group of near copies."""
    return ngram_join.keep_one(docs)


def mask_personal_data(spark, docs, sf_dir):
    """All documents, with personal data replaced by its kind; n_chars follows the new text."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def best_fit_packing(spark, docs, sf_dir):
    """The token pieces of all documents, each with its sequence and place."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("personal data", mask_personal_data),
    ("best-fit packing", best_fit_packing),
]

# A fitted classifier and a tokenizer are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply the stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
