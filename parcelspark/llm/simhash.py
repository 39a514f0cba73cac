"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints are made in the workers; equal fingerprints become one class.
The 64 bits are dealt into ``m`` partitions that keep correlated bits
together.  With thresholds ``t_i >= -1`` that sum to ``max_bits - m + 1``, two
fingerprints within ``max_bits`` differ in at most ``t_i`` bits of some
partition ``i``.  A dynamic program picks the thresholds with the lowest
estimated cost (probe keys plus candidate pairs); every class then probes, per
partition, all values within ``t_i`` bits, and each candidate is verified on
all 64 bits inside the join.  Nothing is capped: classes that share a crowded
value are first joined to a few pivots among them, and pairs within what that
has joined need no look (see ``components``).

Defined results: a text without words has fingerprint zero and links like any
other; a text of fewer words than a shingle is one shingle; repeated rows
share a class; rows without a ``doc_id`` have the component of the others in
their group, else none.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from parcelspark.llm.common import (
    LOWER, UPPER, broadcast_if_small, connected_components, materialize, ship_code,
)

BITS = 64
SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Relative cost of shuffling one probe row and of verifying one candidate pair.
PROBE_COST, VERIFY_COST = 1.0, 0.02

#: Members of one value's crowd that all others are compared with first.
PIVOTS = 3

_TO_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def fingerprint_of(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The fingerprint of a whole text, as an unsigned integer."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_TO_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        hashes = [xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        last = shingle_words - 1
        hashes = [xxh64_intdigest(joined[a:b], SEED)
                  for a, b in zip(starts[: len(words) - last].tolist(), ends[last:].tolist())]
    h = np.array(hashes, dtype="<u8")
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(h), 1 << 16):  # bounds the unpacked bits of very long texts
        part = h[i : i + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """Fingerprint column: 64 bits in a (signed) long."""

    @F.arrow_udf("long")
    def simhash_fingerprint(texts: pa.Array) -> pa.Array:
        slices = (texts.slice(i, 500).to_pylist() for i in range(0, len(texts), 500))
        fps = np.array([fingerprint_of(t, shingle_words) for part in slices for t in part], np.uint64)
        return pa.array(fps.view(np.int64))

    return simhash_fingerprint(text)


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def bit_statistics(classes: DataFrame) -> tuple[int, np.ndarray]:
    """(classes, 64 x 64 counts of bits set together) over all classes."""

    def count(batches):
        total, n = np.zeros((BITS, BITS), np.int64), 0
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            bits = np.unpackbits(fps.view(np.uint8).reshape(len(fps), 8), axis=1, bitorder="little").astype(np.float32)
            total += np.rint(bits.T @ bits).astype(np.int64)
            n += len(fps)
        if n:
            cell = np.arange(BITS * BITS + 1)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(np.append(total.ravel(), n))], ["cell", "n"])

    rows = classes.select("fp").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    found = dict(rows)
    n = found.get(BITS * BITS, 0)
    return n, np.array([found.get(c, 0) for c in range(BITS * BITS)], float).reshape(BITS, BITS)


def group_bits(n: int, together: np.ndarray, m: int) -> list[list[int]]:
    """Deal the bits into ``m`` near-equal partitions, most correlated bits together."""
    p = np.diag(together) / max(n, 1)
    var = np.maximum(p * (1 - p), 1e-9)
    corr = np.abs(together / max(n, 1) - np.outer(p, p)) / np.sqrt(np.outer(var, var))
    np.fill_diagonal(corr, 0)
    free, parts = set(range(BITS)), []
    for k in range(m):
        size = (len(free) + (m - k) - 1) // (m - k)
        order = sorted(free)
        part = [max(order, key=lambda b: (corr[b, order].sum(), -b))]
        while len(part) < size:
            part.append(max(sorted(free - set(part)), key=lambda b: (corr[b, part].sum(), -b)))
        free -= set(part)
        parts.append(sorted(part))
    return parts


def expected_pairs(n: int, p: np.ndarray, part: list[int], most: int) -> list[float]:
    """Estimated pairs within 0..most bits in one partition, from the bits' rates."""
    differ = np.clip(2 * p[part] * (1 - p[part]), 1e-6, 1 - 1e-6)
    odds = differ / (1 - differ)
    ways = np.zeros(most + 1)
    ways[0] = 1
    for o in odds:  # elementary symmetric sums: exactly d of the bits differ
        ways[1:] += o * ways[:-1].copy()
    return (n * n / 2 * np.prod(1 - differ) * np.cumsum(ways)).tolist()


def allocate(n: int, p: np.ndarray, parts: list[list[int]], max_bits: int) -> tuple[float, list[int]]:
    """Cheapest thresholds with sum ``max_bits - m + 1``, each -1 or more, by dynamic programming."""
    m, best = len(parts), {0: (0.0, [])}
    for part in parts:
        pairs, after = expected_pairs(n, p, part, min(max_bits, len(part))), {}
        for t in range(-1, min(max_bits, len(part)) + 1):
            keys = sum(math.comb(len(part), d) for d in range(t + 1))
            cost = 0.0 if t < 0 else n * (1 + keys) * PROBE_COST + pairs[t] * VERIFY_COST
            for used, (so_far, chosen) in best.items():
                if so_far + cost < after.get(used + t, (math.inf,))[0]:
                    after[used + t] = (so_far + cost, [*chosen, t])
        best = after
    return best[max_bits - m + 1]


def plan(n: int, together: np.ndarray, max_bits: int = MAX_BITS) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each partition that is probed."""
    p = np.diag(together) / max(n, 1)
    options = []
    for m in range(1, max_bits + 2):
        parts = group_bits(n, together, m)
        cost, chosen = allocate(n, p, parts, max_bits)
        options.append((cost, [(b, t) for b, t in zip(parts, chosen) if t >= 0]))
    return min(options, key=lambda x: x[0])[1]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def partitions(classes: DataFrame, max_bits: int = MAX_BITS) -> list[tuple[list[int], int]]:
    """The planned (bits, threshold) of each probed partition for these classes."""
    return plan(*bit_statistics(classes), max_bits)


def _values(classes: DataFrame, parts: list[tuple[list[int], int]], flips: bool) -> DataFrame:
    """(part, value, *classes): each class's own value in every partition, or all values within the threshold."""
    out = None
    for i, (bits, t) in enumerate(parts):
        mask = _signed(sum(1 << b for b in bits))
        value = F.col("fp").bitwiseAND(F.lit(mask))
        rows = classes.select(F.lit(i).alias("part"), value.alias("value"), *classes.columns)
        if flips:
            ball = [_signed(sum(1 << b for b in c)) for d in range(t + 1) for c in itertools.combinations(bits, d)]
            flip = F.from_json(F.lit("[" + ",".join(map(str, ball)) + "]"), "array<bigint>")
            rows = rows.withColumn("flip", F.explode(flip)).withColumn(
                "value", F.col("value").bitwiseXOR(F.col("flip"))).drop("flip")
        out = rows if out is None else out.unionByName(rows)
    return out


def _near(a: str, b: str, max_bits: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits


def links(classes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): ids of all classes (fp, id) whose fingerprints differ in at most ``max_bits`` bits."""
    parts = partitions(classes, max_bits)
    a, b = _values(classes, parts, True).alias("a"), _values(classes, parts, False).alias("b")
    met = (F.col("a.part") == F.col("b.part")) & (F.col("a.value") == F.col("b.value"))
    return a.join(b.hint("merge"), met & (F.col("a.fp") < F.col("b.fp")) & _near("a.fp", "b.fp", max_bits)).select(
        F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()


def components(classes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, component_id) of every class (fp, id): the components of ``links``, without listing them.

    First each class is compared with ``PIVOTS`` pivots of its own values: a
    linear number of pairs, and labelled with the smallest one near it.  Then
    classes probe for links between different labels only.  In a value's
    crowd, members of its largest label meet just the members of others, so a
    group around one pivot costs no pairs.
    """
    parts = partitions(classes, max_bits)
    own = _values(classes, parts, False)
    firsts = [F.min(F.struct(F.xxhash64("fp", F.lit(k)), "fp", "id")).alias(f"p{k}") for k in range(PIVOTS)]
    pivots = own.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"), *firsts).where("n > 1").select(
        F.col("part").alias("q_part"), F.col("value").alias("q_value"),
        F.array(*[F.struct(F.col(f"p{k}.fp"), F.col(f"p{k}.id")) for k in range(PIVOTS)]).alias("pivots"))
    met = (F.col("part") == F.col("q_part")) & (F.col("value") == F.col("q_value"))
    close = F.filter("pivots", lambda p: (F.bit_count(p["fp"].bitwiseXOR(F.col("fp"))) <= max_bits) & (p["id"] != F.col("id")))
    stars = own.join(pivots, met).select("id", F.explode(close).alias("p")).select(
        F.col("id").alias("a"), F.col("p.id").alias("b"))
    stars = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    stars = materialize(stars, "simhash-stars")
    # A class and the smallest pivot near it are linked, so classes of one such label are one component.
    first = stars.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("near"))
    grouped = materialize(classes.join(first, "id", "left").select(
        "fp", "id", F.coalesce("near", "id").alias("comp")), "simhash-grouped")

    labelled = grouped.select("fp", "comp")
    own, probes = _values(labelled, parts, False), _values(labelled, parts, True)
    sizes = own.groupBy("part", "value", "comp").agg(F.count(F.lit(1)).alias("n"))
    main = materialize(sizes.groupBy("part", "value").agg(
        F.max_by("comp", F.struct("n", "comp")).alias("main"), F.count(F.lit(1)).alias("comps")), "simhash-main")
    # side 0: probes from outside the main label meet everyone; side 1: those from inside meet outsiders.
    own = own.join(main, ["part", "value"]).withColumn("side", F.explode(
        F.when(F.col("comp") == F.col("main"), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))))
    probes = probes.join(main, ["part", "value"]).where((F.col("comps") > 1) | (F.col("comp") != F.col("main"))).withColumn(
        "side", (F.col("comp") == F.col("main")).cast("int"))
    a, b = probes.alias("a"), own.alias("b")
    met = (F.col("a.part") == F.col("b.part")) & (F.col("a.value") == F.col("b.value")) & (F.col("a.side") == F.col("b.side"))
    cross = a.join(b.hint("merge"), met & (F.col("a.comp") != F.col("b.comp")) & _near("a.fp", "b.fp", max_bits)).select(
        F.least("a.comp", "b.comp").alias("a"), F.greatest("a.comp", "b.comp").alias("b")).distinct()
    merged = connected_components(stars.unionByName(cross), "simhash-cross").select(F.col("node").alias("id"), "component")
    return grouped.join(merged, "id", "left").select("fp", F.coalesce("component", "id").alias("component_id"))


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) of every row."""
    ship_code(docs.sparkSession)
    prints = materialize(docs.select("doc_id", fingerprint(F.col("text"), shingle_words).alias("fp")), "simhash-prints")
    classes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("id")), "simhash-classes")
    named = components(classes.where("id is not null"), max_bits)
    return prints.join(named, "fp", "left").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each group: the one whose ``doc_id`` names the group.

    Rows without a ``doc_id`` stay; of rows that repeat the naming id one stays.
    """
    found = materialize(near_duplicates(docs, shingle_words, max_bits), "simhash-result")
    gone = materialize(
        found.where("doc_id is not null and doc_id != component_id").select(F.col("doc_id").alias("_gone")).distinct(),
        "simhash-gone")
    out = docs.join(broadcast_if_small(gone), docs["doc_id"] == F.col("_gone"), "left_anti")
    repeated = found.where("doc_id = component_id").groupBy("doc_id").count().where("count > 1")
    if repeated.isEmpty():
        return out
    unnamed = out.where("doc_id is null")
    return out.where("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(unnamed)
