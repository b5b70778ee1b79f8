"""Registered queries over the given tables, with SQL where SQL can say the same."""

from pyspark.sql import functions as F

from hubbub.llm import ann, chat, fingerprints, languages, licenses, negatives, ngram_join, packing, pieces, pii, quality, structure, token_counts
from hubbub.llm.shared import table

QUERIES, ORACLES = {}, {}


def query(sql=None):
    def register(run):
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


@query()
def op1_pii(spark, sf_dir):
    """Personal data in every document."""
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


@query()
def op4_best_fit_packing(spark, sf_dir):
    """Every document's token pieces, packed into sequences of 2048."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query()
def op7_quality_classifier(spark, sf_dir):
    """A quality score for every document."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(ngram_join.SQL)
def op10_ngram_jaccard_join(spark, sf_dir):
    """Groups of documents linked by Jaccard similarity of five-word shingles."""
    return ngram_join.join(table(spark, sf_dir, "documents"))


@query()
def op8_simhash(spark, sf_dir):
    """Fingerprints of every document and of its edited text."""
    return fingerprints.fingerprint_edited(table(spark, sf_dir, "documents"))


@query()
def op2_nearest_neighbours(spark, sf_dir):
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    return ann.search(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)


@query(chat.SQL)
def op6_chat_formatting(spark, sf_dir):
    """Maximal logged conversations, rendered."""
    return chat.collapse(table(spark, sf_dir, "conversations"))


@query()
def op3_license_scan(spark, sf_dir):
    """License notices in every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@query()
def op5_sentencepiece(spark, sf_dir):
    """Every document as subword pieces, and whether they decode to the same text."""
    return pieces.encode(table(spark, sf_dir, "documents"))


def edited(docs):
    """Documents with three edits each: words replaced by the source, the language put in, the end cut off."""
    n = F.length("text")
    change = lambda start, end, new: F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), new.alias("new"))
    quarter, half = F.floor(n / 4), F.floor(n / 2)
    return docs.withColumn("edits", F.array(
        change(quarter, quarter + 12, F.col("source")), change(half, half, F.concat(F.lit(" "), "lang", F.lit(" "))), change(n - 20, n, F.lit("")),
    ))


@query()
def op9_token_counts(spark, sf_dir):
    """Token counts of every document before and after edits."""
    return token_counts.count(edited(table(spark, sf_dir, "documents")), "edits")


@query()
def op11_language_id(spark, sf_dir):
    """The language of every document."""
    return languages.identify(table(spark, sf_dir, "documents"))


@query(negatives.SQL)
def op12_hard_negatives(spark, sf_dir):
    """Hard negatives of every vector whose id is divisible by 50, labels of every seventh vector being wrong."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.col("label").cast("long")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return negatives.mine(rows, lambda i: i % 50 == 0)


@query(structure.SQL)
def op13_conversation_repair(spark, sf_dir):
    """Faults of every damaged conversation, the cheapest edits that mend it, and the hash of the result."""
    rows = table(spark, sf_dir, "conversations")
    return structure.repair(rows, structure.damage(rows))
