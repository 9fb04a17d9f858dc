"""The corpus pipeline: from ``documents`` to token ids, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next stage's ``docs``. All but the last return the columns of ``documents``, whatever they are called; the last leaves
out ``text`` and adds ``ids``, ``decoded`` and ``n_tokens`` in place of columns named so.

1. quality: documents that the classifier rejects go.
2. near_duplicates: of documents that 5-word shingles with a similarity of 0.8 or more connect, the one with the smallest id stays.
3. repeats: strings of 400 bytes that stand anywhere else go; so do documents of which nothing is left.
4. decontaminate: documents go of whose words at least one in 20 stands in a 13-word window of a benchmark item.
5. encode: the texts as token ids, and as decoded again from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, decontaminate, jaccard, quality, repeats
from tessera.llm.common import crc_of_id, scratch, set_aside, small_batches, table
from tessera.llm.queries import tokenizer


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    held = F.coalesce(crc_of_id() % 5 == 0, F.lit(False))
    model = quality.fit(docs, table(spark, sf_dir, "labels").filter(~held))
    return quality.accepted(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs, words=5, percent=80)


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(docs, size=400)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    plain, own = set_aside(docs, "doc_id", "text")
    found = decontaminate.find_items(plain, table(spark, sf_dir, "benchmark"), keep_text=True)
    return found.filter(~decontaminate.contaminated()).select(*own.values()).toDF(*docs.columns)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = bpe.encode_decode(docs, tokenizer("byte_bpe_50k.json"))
    return coded.withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeats", repeats_stage),
    ("decontaminate", decontaminate_stage),
    ("encode", encode_stage),
]

#: The classifier and the tokenizer can't be stated in SQL; the tests run brute-force versions of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
