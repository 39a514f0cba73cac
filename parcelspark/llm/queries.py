"""Registered queries of the training-data operators: ``opN_<name>`` and ``pipeline``.

Each applies its operator, with production parameters, to the whole table
named in its contract and derives the digest columns from the operator's
output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.llm import (
    bpe, decontaminate, langid, lines, oracle, pii, quality, runs, shards, simhash, substrings, tokenfile, toxicity, trie,
)
from parcelspark.llm.common import broadcast_if_small, crc_fold, materialize, table
from parcelspark.session import scratch_dir


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(bpe.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path()))


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(crc_fold(F.col("doc_id")) != 1))
    found = langid.identify(docs, model)
    return found.select("doc_id", (crc_fold(F.col("doc_id")) == 1).alias("held_out"), "lang_pred", "score")


SHARD_NAMES = tuple(f"shard-{i:03d}" for i in range(64))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, name = shards.place(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", SHARD_NAMES)
    return out.select("doc_id", f"{name}.*")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.extract(table(spark, sf_dir, "documents")))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learn = crc_fold(F.col("doc_id")) != 1
    model = toxicity.train(docs.where(learn), labels.where(learn))
    found = toxicity.score_documents(docs, model)
    return found.select(
        "doc_id", (crc_fold(F.col("doc_id")) == 1).alias("held_out"), "score",
        (F.col("score") >= toxicity.FLAG_AT).cast("int").alias("predicted"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    judged, name = quality.judge(docs.select("doc_id", "text"), quality.train(docs, labels))
    return judged.select("doc_id", f"{name}.*")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out, name = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    r = F.col(name)
    ids = F.array_join(r["items"], ",")
    return out.select(
        "doc_id", r["n_words"].alias("n_words"), r["n_hit"].alias("n_hit"),
        F.size(r["items"]).cast("long").alias("n_items"),
        F.sha2(ids.cast("binary"), 256).alias("items_sha256"), r["contaminated"].alias("contaminated"))


def op8_tokenfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "token-files")
    tokenfile.write(table(spark, sf_dir, "documents"), folder, tokenizer_path())
    return tokenfile.digest(spark, folder)


def op9_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, name = lines.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    r = F.col(name)
    kept = F.coalesce(r["text"], F.lit(""))
    return out.select("doc_id", r["n_lines"].alias("n_lines"), r["n_dropped"].alias("n_dropped"),
                      F.sha2(kept.cast("binary"), 256).alias("kept_sha256"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) as the contract of operator 11 rebuilds them from ``trie.turn_codes``.

    A conversation starts with the first ``h`` turns of the first one of its
    hundred (all if it has fewer), then come its own after its first ``h``.
    """
    values = ["x1", "x2", "chars"]
    first = turns.where((F.col("conv_id") % 100 == 0) & (F.col("at") < 5)).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("at", *values))).alias("first"))
    first = broadcast_if_small(materialize(first, "first-turns")).select(F.col("conv_id").alias("base"), "first")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    # One row per conversation and part of the sorted turns: a hot conversation has many parts.
    parts = turns.select("conv_id", "part").distinct().withColumn("h", h)
    parts = parts.join(first, parts["conv_id"] - parts["conv_id"] % 100 == F.col("base"), "left")
    taken = F.coalesce(F.slice("first", 1, F.col("h").cast("int")), F.array().cast(first.schema["first"].dataType))
    parts = materialize(parts.select("conv_id", "part", "h", taken.alias("taken")), "rebuilt-parts")
    own = turns.where(F.col("at") >= h).join(
        broadcast_if_small(parts.select("conv_id", "part", "h", F.size("taken").alias("n"))), ["conv_id", "part"])
    own = own.select("conv_id", (F.col("at") - F.col("h") + F.col("n")).alias("at"), *values)
    conversations = parts.groupBy("conv_id").agg(F.first("taken").alias("taken"))
    heads = conversations.select("conv_id", F.explode("taken").alias("t")).select("conv_id", "t.*")
    return own.unionByName(heads), conversations.select("conv_id")


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, conversations = rebuilt(trie.turn_codes(table(spark, sf_dir, "conversations")))
    nodes, ends = trie.prefix_trie(turns, conversations)
    found = nodes.join(trie.end_digests(ends), (F.col("id1") == F.col("e1")) & (F.col("id2") == F.col("e2")), "left")
    none = F.sha2(F.lit("").cast("binary"), 256)
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                        F.col("saved").alias("saved_tokens"), F.coalesce("sha", none).alias("ends_sha256"))


def op12_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, name = substrings.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    r = F.col(name)
    return out.select("doc_id", r["n_words"].alias("n_words"), r["n_removed"].alias("n_removed"),
                      F.sha2(r["text"].cast("binary"), 256).alias("kept_sha256"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text) as the contract of operator 13 alters it: in some texts a stretch of words recurs to the end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def altered(w):
        n = F.size(w).cast("long")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))).cast("long")
        at = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p)))
        return F.when(n > 0, F.array_join(F.transform(at, lambda i: F.get(w, i.cast("int"))), " ")).otherwise("")

    # The one-element array binds a text's words once.
    split = F.filter(F.split(F.col("text"), r"[ \t\n\x0B\f\r]+"), lambda x: x != "")
    return docs.select("doc_id", F.when(h % 10 == 0, F.transform(F.array(split), altered)[0]).otherwise(F.col("text")).alias("text"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.collapse(with_repeats(table(spark, sf_dir, "documents")))
    lines_of = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    top = found.withColumn("top", runs.strongest(F.col("runs")))
    return top.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines_of, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # uses this module, so it is imported on call

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_bpe": op1_bpe,
        "op2_langid": op2_langid,
        "op3_sharding": op3_sharding,
        "op4_pii": op4_pii,
        "op5_toxicity": op5_toxicity,
        "op6_quality": op6_quality,
        "op7_decontaminate": op7_decontaminate,
        "op8_tokenfile": op8_tokenfile,
        "op9_lines": op9_lines,
        "op10_simhash": op10_simhash,
        "op11_trie": op11_trie,
        "op12_substrings": op12_substrings,
        "op13_runs": op13_runs,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
