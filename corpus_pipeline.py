"""A corpus from documents to packed sequences, in five stages; each is written and read again as the next one's input."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqcurate.llm import language_id
from seqcurate.llm.common import shared_folder, word_count
from seqcurate.llm.mixing import mix_sources
from seqcurate.llm.near_dedup import near_duplicates
from seqcurate.llm.packing import pack
from seqcurate.llm.substring_dedup import remove_repeats
from seqcurate.operators.order import kept, placed

#: Five-word shingle sets this similar (percent) make near-duplicates of the corpus.
SIMILAR = 80
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the models accept; those without letters (null and empty texts, too), or unlike anything learned, go. Very long texts count whole."""
    found = language_id.identify(docs, language_id.fit(docs), list(COLUMNS))
    return found.where(~F.col("rejected")).select(*COLUMNS)


def told_apart(named: DataFrame) -> tuple[DataFrame, bool]:
    """named (rows with an id) with row, a number that only rows of equal id and text share: the id, but for the other texts of an id that has several, numbers above all ids. And whether ids repeat."""
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    again = kept(named.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"))
    if again.isEmpty():
        return named.withColumn("row", F.col("doc_id")), False
    texts = named.join(again, "doc_id", "left_semi").select("doc_id", digest.alias("digest")).distinct()
    first = texts.groupBy("doc_id").agg(F.min("digest").alias("digest"))
    most = named.agg(F.max("doc_id")).first()[0]
    others = placed(texts.join(first, ["doc_id", "digest"], "left_anti"), [F.col("doc_id"), F.col("digest")], "place")
    others = others.select("doc_id", "digest", (F.col("place") + most).alias("row"))
    joined = named.withColumn("digest", digest).join(others, ["doc_id", "digest"], "left")
    return joined.withColumn("row", F.coalesce("row", "doc_id")).drop("digest"), True


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id. Of rows that agree in id and text one stays, whichever; an id's other texts are documents of their own, that
    come after all ids. Documents without an id stay."""
    named, repeat = told_apart(docs.select(*COLUMNS).where(F.col("doc_id").isNotNull()))
    kept_rows = near_duplicates(named, doc_id="row", percent=SIMILAR).where("kept").select(F.col("doc_id").alias("row")).distinct()
    rest = docs.where(F.col("doc_id").isNull()).select(*COLUMNS)
    left = named.join(kept_rows, "row", "left_semi")
    if not repeat:
        return left.select(*COLUMNS).unionByName(rest)
    left = kept(left)
    again = left.groupBy("row").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("row")
    once = left.join(again, "row", "left_anti")
    one = left.join(again, "row", "left_semi").groupBy("row").agg(F.min(F.struct(*COLUMNS)).alias("r")).select("r.*")  # pre-aggregated, however many agree
    return once.select(*COLUMNS).unionByName(one).unionByName(rest)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that recur; a text may end up empty, a null one stays null, and no document goes."""
    return remove_repeats(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it. Rows are told apart by id and text, so rows without an id are as many documents as they have texts; of rows that
    agree in both, too, the first ones take what is left over."""
    row = F.xxhash64("doc_id", "text")
    taken = mix_sources(docs.withColumn("doc_id", row)).groupBy(F.col("doc_id").alias("row"), "source", "size").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows")).where("copies > 0")
    left = docs.select(*COLUMNS, word_count(F.col("text")).alias("size"), row.alias("row")).alias("l")
    same = (F.col("l.row") == F.col("r.row")) & F.col("l.source").eqNullSafe(F.col("r.source")) & (F.col("l.size") == F.col("r.size"))
    joined = left.join(taken.alias("r"), same).select(*(f"l.{c}" for c in COLUMNS), "l.row", "copies", "rows")
    nth = F.row_number().over(Window.partitionBy("row", "source").orderBy("lang"))
    times = F.floor(F.col("copies") / F.col("rows")) + F.when(F.col("rows") > 1, (nth <= F.col("copies") % F.col("rows")).cast("int")).otherwise(0)
    return joined.withColumn("times", times.cast("int")).where("times > 0").withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times")))).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in which sequence; a document without words has no piece."""
    return pack(docs)


STAGES = [("language ID", by_language), ("near-dedup", one_of_each), ("substring dedup", without_repeats), ("mixing", mixed), ("packing", packed)]

#: SQL can't express language models, and so not the rows of run(); tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over sf_dir's documents; the others' are Parquet in the shared folder. An empty table gives no rows; columns besides COLUMNS are left out."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
