"""The corpus pipeline: quality, near duplicates, secrets, mixing, encoding.

Each stage takes the session, the documents that the stage before kept, and the
data folder. All but the last return the columns of documents. The stages pass
their results on as Parquet.

- quality: documents that the classifier rejects go;
- near_duplicates: one document of each group of near duplicates stays, the one
  with the smallest id; of several rows of one id every text is judged for itself
  and stays once; rows without id stay;
- secrets: live-looking secrets are replaced by a mark, copied examples stay;
  n_chars follows the text;
- mixing: rows are repeated as their source's target asks for;
- encoding: the pieces of every row, as digests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keptvisit.llm import jaccard, mixing, queries, quality, secrets
from keptvisit.llm import pieces as sentencepieces
from keptvisit.session import scratch_path, work_tables, write_out

FEW_IDS = 1_000_000


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, queries.read(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = write_out(jaccard.join(docs), "joined").filter("doc_id is not null")
    rows = found.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("kept"), 1)).alias("n_kept"))
    dropped = rows.filter("n_kept = 0").select("doc_id")
    repeated = rows.filter("n > 1 and n_kept > 0").select("doc_id")
    kept = with_ids(docs, dropped, "left_anti")
    if repeated.isEmpty():
        return kept
    # Several rows of one id: each text goes by its own row of the join, and stays once.
    texts = found.filter("kept").select("doc_id", "text_key").distinct().select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    rows = jaccard.with_key(with_ids(kept, repeated, "left_semi"))
    again = rows.join(
        texts, (F.col("doc.doc_id") == F.col("_id")) & F.col("text_key").eqNullSafe(F.col("_key")), "left_semi")
    same = F.when(F.col("text_key").isNull(), F.coalesce("doc.text", F.lit("")))
    again = again.withColumns({"_id": F.col("doc.doc_id"), "_same": same}).dropDuplicates(
        ["_id", "text_key", "_same"]).select("doc.*")
    return with_ids(kept, repeated, "left_anti").unionByName(again)


def with_ids(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """A semi or anti join by id; few ids are broadcast, more are shuffled."""
    if ids.count() <= FEW_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, "doc_id", how).select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs, secrets.scan(docs), chars="n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.sample(docs, chars="n_chars")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = queries.public_tokenizers.path(queries.PIECES_FILE)
    return sentencepieces.digests(sentencepieces.encode(docs, model))


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_each),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("encoding", encode),
]

# The classifier and the encoding have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a data folder.

    A stage's work tables are dropped once its own result is written.
    """
    docs = queries.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        with work_tables(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
