"""Corpus pipeline: quality rules, line dedup, near-duplicates, decontamination, encoding.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir).
Each stage's rows are written as Parquet to the shared scratch folder and read
again as the next one's ``docs``.  All but the last return the columns of
``documents``.

Defined results: a null or empty text fails the quality rules and goes in the
first stage; rows without ``doc_id`` neither count as documents nor lose lines,
and near-dedup leaves them; of rows that repeat an id near-dedup keeps one; an
empty table stays empty in every stage; further columns pass through all
stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.llm import bpe, decontaminate, lines, quality, simhash
from parcelspark.llm.common import materialize, table
from parcelspark.llm.queries import tokenizer_path


#: Smaller than an encoder's own: here an executor's heap is full of the earlier stages.
MEMO = 60_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the base rules or the trees reject go."""
    model = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.keep(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; a text that loses lines gets its new length in ``n_chars``."""
    out, name = lines.dedup(docs)
    r, changed = F.col(name), F.col(name)["n_dropped"] > 0
    new = {
        "text": r["text"],
        "n_chars": F.when(changed, F.length(r["text"])).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType),
    }
    return out.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text that is left, with the digests of ids and decoded text."""
    return bpe.digest(bpe.encode_documents(docs, tokenizer_path(), memo=MEMO))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("BPE encoding", bpe_encoding),
]

#: The trees of the first stage and the hashes of the third have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline")
    return docs
