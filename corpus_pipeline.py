"""From raw documents to token files, in five stages.

Every stage works on all that the one before it kept, written as Parquet and read again: quality rules drop what they
reject, near-duplicate groups keep their first document, documents that hold a benchmark item go, the rest is laid out
in the order of the mix, and the token files are written in that order.

The order of the mix is that of the rows in the files of its stage: file by file, and row by row in a file. Documents
that do not come from files are written by ascending ``doc_id``.

Defined cases: a document with a null or empty text is rejected by the quality rules; one with a null ``doc_id`` passes all
stages, since it is a copy of none, and is dropped only for what its own text holds; very long texts are handled whole;
rows that repeat count as copies, of which the mix and the files get what the near-duplicate stage keeps (rows of one id
are kept or dropped together); a null source is a source of its own; ties are decided as the stages say; all but the
last stage keep extra columns, whatever their names; an empty table gives no rows, and so does an empty benchmark
drop none.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pingloom.llm import decontaminate, mixing, near_dedup, rules, token_files
from pingloom.llm.frames import block_count
from pingloom.session import scratch_path

TOKENIZER = "byte_bpe_50k.json"
MIX_FILE_BYTES = 32 << 20


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_first_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_first(docs, width=5, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.in_order(mixing.mix(docs), block_count(docs, MIX_FILE_BYTES))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, order = docs, ("doc_id", "text")
    if _from_files(docs):
        rows = docs.select(
            "doc_id", "text",
            F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long").alias("__file"),
            F.col("_metadata.row_index").alias("__row"), F.lit(0).alias("__last"),
        )
        order = ("__file", "__row", "__last")
    return token_files.round_trip(rows, public_tokenizers.path(TOKENIZER), order=order)


def _from_files(docs: DataFrame) -> bool:
    try:
        return "row_index" in docs.select("_metadata.row_index").columns
    except AnalysisException:
        return False


STAGES = [
    ("quality rules", keep_good),
    ("near duplicates", keep_first_of_group),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("token files", write_tokens),
]
# No SQL: the ids of the tokenizer and most stages are beyond it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        done = stage(spark, docs, sf_dir)
        path = scratch_path(spark, name.replace(" ", "-"))
        done.write.parquet(path)
        docs = spark.read.schema(done.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
