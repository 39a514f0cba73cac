"""Benchmark decontamination over a positional inverted index (DataFrame functions only).

The index holds one posting (term, d, row, pos) per training token whose term
the benchmark uses, written in segments sorted by term.  A benchmark window of
13 words is looked up from its rarest term: each posting of that term, moved
back by the term's offset, is a candidate start; the lists of the next rarest
terms, moved likewise, are intersected with the candidates.  What is left is
compared word by word with the documents.

``d`` is the ``doc_id`` (the smallest long for null), ``row`` a hash of the
text: rows that repeat both are one document to the index and each get its
result.  A null or empty text has no words and no hit; an item without words
has no window, one without an id marks words but is not listed; very long texts
are indexed whole; repeated items each count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.llm.common import ascii_lower, broadcast_if_small, fresh, materialize

WINDOW = 13
#: Rarest terms of a window whose lists are intersected before the exact check.
RAREST = 3
#: Contaminated when one word in so many is hit.
SHARE = 20

#: Copies of a term's count where counts are too many to broadcast.
SALTS = 32
_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_NO_ID = -(1 << 63)


def words(text: Column) -> Column:
    """Lower-cased words: runs of digits, letters a-z and characters beyond ASCII."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _NO_WORD), lambda w: w != "")


def keyed(docs: DataFrame) -> DataFrame:
    """(d, row, text)."""
    return docs.select(
        F.coalesce("doc_id", F.lit(_NO_ID)).alias("d"), F.xxhash64("text").alias("row"), F.col("text").alias("text"))


def windows(benchmark: DataFrame, width: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(wid, terms) of each distinct window; (wid, item_id) of where it is from."""
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - width + 1))
    cut = items.select("item_id", F.explode(F.transform(starts, lambda s: F.slice(F.col("w"), s, width))).alias("terms"))
    whole = materialize(cut.distinct(), "bench-windows")
    distinct = materialize(whole.select("terms").distinct().withColumn("wid", F.monotonically_increasing_id()), "bench-distinct")
    return distinct, whole.join(distinct, "terms").select("wid", "item_id")


def build_index(docs: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """The stored postings (term, d, row, pos) of all tokens, or of those in ``terms`` (term)."""
    tokens = keyed(docs).select("d", "row", F.posexplode(words(F.col("text"))).alias("pos", "term"))
    if terms is not None:
        tokens = tokens.join(broadcast_if_small(terms), "term")
    return materialize(tokens.select("term", "d", "row", "pos").sortWithinPartitions("term"), "postings")


def _plans(index: DataFrame, distinct: DataFrame, rarest: int) -> DataFrame:
    """(wid, n, anchors): the windows all of whose terms occur, with their rarest terms and offsets."""
    counts = materialize(index.groupBy("term").agg(F.count(F.lit(1)).alias("tf")), "term-counts")
    spread = distinct.select("wid", F.size("terms").alias("n"), F.posexplode("terms").alias("off", "term"))
    # A common word is in many windows: past the broadcast bound its rows meet copies of its one count.
    salted = counts.select("*", F.explode(F.array(*[F.lit(k) for k in range(SALTS)])).alias("salt"))
    small = broadcast_if_small(counts)
    met = spread.join(small, "term") if small is not counts else spread.withColumn(
        "salt", F.pmod(F.xxhash64("wid"), F.lit(SALTS)).cast("int")).join(salted, ["term", "salt"])
    ranked = met.groupBy("wid", "n").agg(
        F.sort_array(F.collect_list(F.struct("tf", "off", "term"))).alias("anchors"))
    return ranked.where(F.size("anchors") == F.col("n")).select("wid", "n", F.slice("anchors", 1, rarest).alias("anchors"))


def phrase_matches(docs: DataFrame, index: DataFrame, distinct: DataFrame, rarest: int = RAREST) -> DataFrame:
    """(d, row, start, n, wid): every exact occurrence of a window, from 0."""
    plans = materialize(_plans(index, distinct, rarest), "window-plans")
    first = plans.select("wid", "n", F.get("anchors", F.lit(0)).alias("a")).select(
        "wid", "n", F.col("a.term").alias("term"), F.col("a.off").alias("off"))
    found = index.join(broadcast_if_small(first), "term").select(
        "wid", "n", "d", "row", (F.col("pos") - F.col("off")).alias("start")).where("start >= 0")
    for k in range(1, rarest):
        nth = plans.select("wid", F.get("anchors", F.lit(k)).alias("a")).select(
            "wid", F.col("a.term").alias("term"), F.col("a.off").alias("off"))
        lists = index.join(broadcast_if_small(nth.where("term is not null").select("term").distinct()), "term", "left_semi")
        aimed = found.join(broadcast_if_small(nth), "wid").withColumn("pos", F.col("start") + F.col("off"))
        short = aimed.where("term is null").select(found.columns)  # windows with fewer terms
        found = aimed.where("term is not null").join(lists, ["term", "d", "row", "pos"], "left_semi").select(
            found.columns).unionByName(short)
    found = materialize(found, "phrase-candidates")
    some = materialize(found.select("d", "row").distinct(), "phrase-documents")
    texts = keyed(docs).join(broadcast_if_small(some), ["d", "row"], "left_semi").select(
        "d", "row", words(F.col("text")).alias("w")).dropDuplicates(["d", "row"])
    # A text's candidates are checked in one pass over its words, which are not copied for each.
    listed = found.join(broadcast_if_small(distinct), "wid").groupBy("d", "row").agg(
        F.collect_list(F.struct("start", "n", "wid", "terms")).alias("c"))
    check = listed.join(texts, ["d", "row"]).select("d", "row", F.explode(F.filter(
        "c", lambda c: F.slice(F.col("w"), c["start"] + 1, c["n"]) == c["terms"])).alias("c"))
    return materialize(check.select("d", "row", "c.start", "c.n", "c.wid"), "phrase-matches")


def proximity_matches(index: DataFrame, pairs: DataFrame, slop: int) -> DataFrame:
    """(left_term, right_term, d, row, left_pos, right_pos): both terms at most ``slop`` words apart.

    Positions meet in blocks of ``slop + 1`` words, so no document is paired with itself whole.
    """
    block = slop + 1
    a = index.withColumnsRenamed({"term": "left_term", "pos": "left_pos"}).join(pairs, "left_term")
    a = a.withColumn("block", F.explode(F.array(*[F.floor(F.col("left_pos") / block) + k for k in (-1, 0, 1)])))
    b = index.withColumnsRenamed({"term": "right_term", "pos": "right_pos"}).withColumn(
        "block", F.floor(F.col("right_pos") / block))
    return a.join(b, ["right_term", "d", "row", "block"]).where(
        (F.abs(F.col("left_pos") - F.col("right_pos")) <= slop)
        & ~((F.col("left_term") == F.col("right_term")) & (F.col("left_pos") >= F.col("right_pos")))
    ).select("left_term", "right_term", "d", "row", "left_pos", "right_pos")


def hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(d, row, n_hit, items): words inside any window and the sorted item ids, for documents with any."""
    distinct, origin = windows(benchmark)
    vocabulary = materialize(distinct.select(F.explode("terms").alias("term")).distinct(), "bench-terms")
    matches = phrase_matches(docs, build_index(docs, vocabulary), distinct)
    spans = matches.groupBy("d", "row", "start").agg(F.max("n").alias("n"))
    before = Window.partitionBy("d", "row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("n")
    covered = F.greatest(F.lit(0), end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(before), F.lit(0))))
    n_hit = spans.select("d", "row", covered.alias("new")).groupBy("d", "row").agg(F.sum("new").alias("n_hit"))
    items = matches.select("d", "row", "wid").distinct().join(origin, "wid").groupBy("d", "row").agg(
        F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    return materialize(n_hit.join(items, ["d", "row"]), "contamination")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` plus one struct column (n_words, n_hit, items, contaminated); its name."""
    found = broadcast_if_small(hits(docs, benchmark)).withColumnsRenamed({"d": "_d", "row": "_r", "n_hit": "_h", "items": "_i"})
    met = (F.coalesce(docs["doc_id"], F.lit(_NO_ID)) == F.col("_d")) & (F.xxhash64(docs["text"]) == F.col("_r"))
    name = fresh(docs, "contamination_result")
    n_words = F.size(words(docs["text"])).cast("long")
    n_hit = F.coalesce(F.col("_h"), F.lit(0)).cast("long")
    result = F.struct(
        n_words.alias("n_words"), n_hit.alias("n_hit"),
        F.coalesce(F.col("_i"), F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (SHARE * n_hit >= n_words)).alias("contaminated"),
    )
    return docs.join(found, met, "left").select(*[docs[c] for c in docs.columns], result.alias(name)), name


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    judged, name = decontaminate(docs, benchmark)
    return judged.where(~F.col(name)["contaminated"]).select(*docs.columns)
