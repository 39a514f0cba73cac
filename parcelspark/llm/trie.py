"""Prefix trie of conversations in balanced parentheses, one sequence per shard.

A *node* is a distinct sequence of first turns (role, text); its id is the
exclusive or of 128-bit hashes of its (position, role, text) triples, zero for
the root.  Texts are hashed first and never shuffled.

1. Conversations become paths of turn codes, cut into segments of ``SEGMENT``
   turns; equal segments behind equal prefixes are one row with a count.
2. The paths are range-partitioned and sorted, which is depth-first order.  A
   partition is a *shard*; as its rows are distinct, no common first turn or
   copied conversation gathers rows in one shard.
3. Each shard writes its part of the trie as balanced parentheses, with the
   minimum and maximum excess of each block under a range tree.  ``findclose``
   delimits each node's subtree; ranks count its leaf pairs ``()`` and the
   paths through it; a cumulative array over the nodes gives its savings.
4. Nodes that go on in a neighbour shard (the shared spine between two shards:
   the common prefix of the last path of one and the first of the next) are
   merged by adding up.  Each shard knows both neighbours' paths, so a spine
   node's own turn is counted as saved, as a child and as a leaf only once.
5. A longer conversation's later segments are tries of their own below the
   nodes where the segment starts; they are done first, from the deepest, and
   their totals enter their parents' shards.

Defined results: rows without ``conv_id`` are left out; a null role or text is
empty; turns are ordered by number, null first, and turns of one number by a
hash of role and text; repeated rows are turns of their own; an empty table
has no nodes; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.llm.common import broadcast_if_small, materialize, ship_code

#: Turns in a row of codes (16 bytes each); longer conversations take more rounds.
SEGMENT = 8192
#: Ids whose text is one row on the way to a digest.
_IDS = 4096
_ID_BITS = 33  # Spark's row ids: partition << 33 | row


class BalancedParens:
    """Balanced parentheses (1 opens, 0 closes) with block-wise excess bounds."""

    BLOCK = 128

    def __init__(self, bits: np.ndarray):
        self.bits = bits.astype(bool)
        n, size = len(bits), self.BLOCK
        self.excess = np.cumsum(np.where(self.bits, 1, -1)).astype(np.int32)
        blocks = max(1, -(-n // size))
        padded = np.full(blocks * size, n + 1, np.int32)
        padded[:n] = self.excess
        self.padded = padded
        self.lows = [padded.reshape(-1, size).min(1)]
        self.highs = [np.where(padded > n, -1, padded).reshape(-1, size).max(1)]
        while len(self.lows[-1]) > 1:
            odd = len(self.lows[-1]) % 2
            low = np.concatenate([self.lows[-1], np.full(odd, n + 1, np.int32)])
            high = np.concatenate([self.highs[-1], np.full(odd, -1, np.int32)])
            self.lows.append(low.reshape(-1, 2).min(1))
            self.highs.append(high.reshape(-1, 2).max(1))
        #: Opens and leaf pairs before each place.
        self.opens_before = np.concatenate([[0], np.cumsum(self.bits)])
        pairs = self.bits & ~np.concatenate([self.bits[1:], [True]])[:n]
        self.pairs_before = np.concatenate([[0], np.cumsum(pairs)])

    def depth(self) -> int:
        return int(self.highs[-1][0])

    def findclose(self, at: np.ndarray) -> np.ndarray:
        """Place of the closing parenthesis of each opening one in ``at``."""
        goal = self.excess[at] - 1
        out = np.full(len(at), -1, np.int64)
        open_, place = np.arange(len(at)), at + 1
        self._scan(out, open_, place, goal)
        left = np.flatnonzero(out < 0)
        if not len(left):
            return out
        # Up: the first block to the right whose least excess reaches the goal ...
        node, want = at[left] // self.BLOCK, goal[left]
        found_level = np.full(len(left), -1)
        for level, lows in enumerate(self.lows[:-1]):
            todo = np.flatnonzero(found_level < 0)
            if not len(todo):
                break
            sibling = node[todo] + 1
            is_left = (node[todo] % 2 == 0) & (sibling < len(lows))
            hit = is_left & (lows[np.minimum(sibling, len(lows) - 1)] <= want[todo])
            node[todo] = np.where(hit, sibling, node[todo] // 2)
            found_level[todo[hit]] = level
        # ... and down again.
        for level in range(len(self.lows) - 2, 0, -1):
            here = np.flatnonzero(found_level == level)
            lower = self.lows[level - 1]
            child = 2 * node[here]
            node[here] = np.where(lower[child] <= want[here], child, child + 1)
            found_level[here] = level - 1
        self._scan(out, left, node * self.BLOCK, goal)
        return out

    def _scan(self, out: np.ndarray, which: np.ndarray, place: np.ndarray, goal: np.ndarray) -> None:
        """Go on from ``place`` within its block until the excess falls to the goal."""
        for _ in range(self.BLOCK + 1):
            inside = place < len(self.excess)
            which, place = which[inside], place[inside]
            hit = self.excess[place] <= goal[which]
            out[which[hit]] = place[hit]
            which, place = which[~hit], place[~hit] + 1
            same = place % self.BLOCK != 0
            which, place = which[same], place[same]
            if not len(which):
                return


class RangeMin:
    """Minimum of values[a:b] for many ranges at once."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while 2 << len(self.rows) <= 2 * len(values):
            half = 1 << (len(self.rows) - 1)
            last = self.rows[-1]
            self.rows.append(np.minimum(last[:-half], last[half:]))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        level = np.log2(b - a).astype(np.int64)
        out = np.empty(len(a), self.rows[0].dtype)
        for k, row in enumerate(self.rows):
            i = np.flatnonzero(level == k)
            out[i] = np.minimum(row[a[i]], row[b[i] - (1 << k)])
        return out


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common prefix of two paths (rows of two numbers)."""
    n = min(len(a), len(b))
    differ = np.flatnonzero((a[:n] != b[:n]).any(1))
    return int(differ[0]) if len(differ) else n


def _common_prefixes(codes: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each path with the one before it; 0 for the first."""
    both = np.minimum(size[1:], size[:-1])
    at = np.arange(both.sum()) - np.repeat(np.cumsum(both) - both, both)
    same = (codes[np.repeat(start[1:], both) + at] == codes[np.repeat(start[:-1], both) + at]).all(1)
    cut = np.where(same, np.repeat(both, both), at)
    out = np.minimum.reduceat(cut, np.cumsum(both) - both) if len(both) else both
    return np.concatenate([[0], out])


NODE = "id1 long, id2 long, p1 long, p2 long, depth long, conv_id long, parent_conv_id long, n_convs long, " \
       "n_children long, n_leaves long, saved long, spine boolean, parent_spine boolean"


def encode_shard(paths: dict, before: np.ndarray | None, after: np.ndarray | None, first_depth: int) -> dict[str, np.ndarray]:
    """The nodes of one shard, in depth-first order.

    ``paths``: sorted distinct rows as flat arrays - ``codes`` (n, 2), the
    segment's root id first, ``chars`` of each code's text, ``size`` codes of
    each row, and per row ``weight`` (conversations), ``least`` (smallest
    ``conv_id``) and, if the row goes on below, ``leaves``, ``saved`` and
    ``children`` there.  ``before`` and ``after``: the codes of the neighbour
    shards' last and first path.
    """
    codes, size = paths["codes"], paths["size"]
    start = np.cumsum(size) - size
    common = _common_prefixes(codes, start, size)
    opened = size - common  # one at least: a prefix comes first
    closed = np.concatenate([[0], (size[:-1] - common[1:])])
    steps = np.stack([closed, opened], 1).ravel()
    bits = np.repeat(np.tile([0, 1], len(size)), steps)
    parens = BalancedParens(np.concatenate([bits, np.zeros(size[-1], bits.dtype)]))

    at = np.flatnonzero(parens.bits)
    path = np.repeat(np.arange(len(size)), opened)  # a node is opened by its first path
    first_node = np.cumsum(opened) - opened
    level = common[path] + np.arange(len(at)) - first_node[path]
    element = start[path] + level
    ids = np.bitwise_xor.accumulate(codes, 0)
    base = np.where(start[:, None] > 0, ids[np.maximum(start - 1, 0)], 0)
    node_id = ids[element] ^ base[path]

    close = parens.findclose(at)
    last_path = np.searchsorted(at[first_node], close)  # paths [path, last_path) go through the node
    last_node = parens.opens_before[close]  # nodes [k, last_node) are its subtree
    total = lambda per_path: (s := np.concatenate([[0], np.cumsum(per_path)]))[last_path] - s[path]
    n_convs = total(paths["weight"])
    least = RangeMin(paths["least"])(path, last_path)

    lcp_before = 0 if before is None else _common(before, codes[: size[0]])
    last = codes[start[-1] :]
    lcp_after = 0 if after is None else _common(last, after)
    own = np.ones(len(at), bool)  # opened here and not in an earlier shard
    own[:lcp_before] = False
    parent, of_level = _parents(level)
    spine = ~own
    for k in range(lcp_after):
        spine[of_level[k][-1]] = True

    goes_on = paths["children"] > 0
    leaf_change = np.where(goes_on, paths["leaves"] - 1, 0)
    if lcp_after == size[-1]:
        leaf_change[-1] -= 1  # the next shard's first path grows from this one
    n_leaves = parens.pairs_before[close] - parens.pairs_before[at] + total(leaf_change)
    chars = paths["chars"][element]
    savings = np.concatenate([[0], np.cumsum(n_convs * chars - chars * own)])
    saved = savings[last_node] - savings[np.arange(len(at))] + total(paths["saved"])
    inner = level > 0
    n_children = np.bincount(parent[inner & own], minlength=len(at))
    n_children[first_node + opened - 1] += paths["children"]

    up = np.maximum(parent, 0)
    null = ~inner
    return {
        "id1": node_id[:, 0], "id2": node_id[:, 1],
        "p1": np.ma.array(node_id[up, 0], mask=null), "p2": np.ma.array(node_id[up, 1], mask=null),
        "depth": first_depth + level, "conv_id": least, "parent_conv_id": np.ma.array(least[up], mask=null),
        "n_convs": n_convs, "n_children": n_children, "n_leaves": n_leaves, "saved": saved, "spine": spine,
        "parent_spine": inner & (spine[up] | ((first_depth > 0) & (level == 1))),
    }


def _parents(level: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Each node's parent (-1: none) and the nodes of each level, all in depth-first order."""
    order = np.argsort(level, kind="stable")
    cuts = np.searchsorted(level[order], np.arange(level.max() + 2))
    of_level = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
    parent = np.full(len(level), -1)
    for above, nodes in zip(of_level, of_level[1:]):
        parent[nodes] = above[np.searchsorted(above, nodes) - 1]
    return parent, of_level


def _shard_of_table(table: pa.Table, first_depth: int) -> pa.Table:
    table = table.sort_by("idx").combine_chunks()
    column = lambda name: table[name].combine_chunks()
    lists = column("path")

    def two(structs) -> np.ndarray:
        return np.stack([structs.field(c).to_numpy(zero_copy_only=False) for c in ("c1", "c2")], 1)

    def neighbour(name: str, row: int):
        value = table[name][row]
        return two(value.values) if value.is_valid else None

    numbers = {c: column(c).to_numpy(zero_copy_only=False) for c in ("weight", "least", "leaves", "saved", "children")}
    nodes = encode_shard(
        numbers | {"codes": two(lists.flatten()), "chars": lists.flatten().field("chars").to_numpy(zero_copy_only=False),
                   "size": lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)},
        neighbour("before", 0), neighbour("after", table.num_rows - 1), first_depth)
    arrays = [pa.array(v.data, mask=v.mask) if isinstance(v, np.ma.MaskedArray) else pa.array(v) for v in nodes.values()]
    return pa.table(arrays, list(nodes))


def turn_codes(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, x1, x2, chars): numbered turns as hashes of role and text; ``at`` counts from 0.

    Turns are sorted by ranges, so one conversation may fill many tasks; each
    task's first place in a conversation comes from a table of (conversation,
    task) counts.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.xxhash64(role, text).alias("x1"),
        F.xxhash64(F.lit(7), role, text).alias("x2"), F.length(text).cast("long").alias("chars"),
        F.monotonically_increasing_id().alias("row"))
    key = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("x1"), F.col("x2"), F.col("row")]
    rows = rows.repartitionByRange(*key).sortWithinPartitions(*key).withColumn("row", F.monotonically_increasing_id())
    rows = materialize(rows.select("conv_id", "x1", "x2", "chars", "row", F.shiftright("row", _ID_BITS).alias("part")), "turns")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    chunks = rows.groupBy("conv_id", "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    chunks = chunks.withColumn("done", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    chunks = broadcast_if_small(materialize(chunks, "turn-chunks"))
    return rows.join(chunks, ["conv_id", "part"]).select(
        "conv_id", (F.col("row") - F.col("first") + F.col("done")).alias("at"), "x1", "x2", "chars", "part")


def _segments(turns: DataFrame, conversations: DataFrame, segment: int) -> DataFrame:
    """(conv_id, s, r1, r2, path, e1, e2): segment ``s`` of each conversation, the ids of its prefix and its end.

    ``path`` has the prefix id, then the codes.  Conversations without turns
    have one segment of the root alone.
    """
    code = lambda *more: F.xxhash64(*more, "at", "x1", "x2")
    rows = turns.select("conv_id", (F.col("at") / segment).cast("long").alias("s"), F.struct(
        "at", code().alias("c1"), code(F.lit(7)).alias("c2"), "chars").alias("c"))
    cut = rows.groupBy("conv_id", "s").agg(
        F.array_sort(F.collect_list("c")).alias("c"), F.bit_xor("c.c1").alias("y1"), F.bit_xor("c.c2").alias("y2"))
    all_ = conversations.join(cut, "conv_id", "left").withColumn("s", F.coalesce("s", F.lit(0).cast("long")))
    upto = Window.partitionBy("conv_id").orderBy("s").rowsBetween(Window.unboundedPreceding, 0)
    for k in (1, 2):
        all_ = all_.withColumn(f"e{k}", F.coalesce(F.bit_xor(f"y{k}").over(upto), F.lit(0).cast("long")))
        all_ = all_.withColumn(f"r{k}", F.col(f"e{k}").bitwiseXOR(F.coalesce(f"y{k}", F.lit(0).cast("long"))))
    root = F.struct(F.col("r1").alias("c1"), F.col("r2").alias("c2"), F.lit(0).cast("long").alias("chars"))
    codes = F.transform("c", lambda c: F.struct(c["c1"].alias("c1"), c["c2"].alias("c2"), c["chars"].alias("chars")))
    path = F.concat(F.array(root), F.coalesce(codes, F.array().cast("array<struct<c1:bigint,c2:bigint,chars:bigint>>")))
    return materialize(all_.select("conv_id", "s", "r1", "r2", path.alias("path"), "e1", "e2"), "segments")


def _encode_band(paths: DataFrame, below: DataFrame | None, band: int, segment: int) -> DataFrame:
    """The shards' nodes for the segments number ``band``; ``below``: totals (id1, id2, leaves, saved, children) of the next."""
    rows = paths.where(F.col("s") == band)
    if below is not None:
        met = (F.col("e1") == F.col("id1")) & (F.col("e2") == F.col("id2")) & (F.size("path") == segment + 1)
        rows = rows.join(broadcast_if_small(below), met, "left")
    extra = [F.coalesce(F.col(c) if below is not None else F.lit(None), F.lit(0)).cast("long").alias(c)
             for c in ("leaves", "saved", "children")]
    rows = rows.select("path", "weight", "least", *extra)
    # The codes alone order the paths; equal codes have equal texts.
    rows = rows.repartitionByRange("path").sortWithinPartitions("path").withColumn("row", F.monotonically_increasing_id())
    rows = rows.withColumn("part", F.shiftright("row", _ID_BITS)).withColumn("idx", F.col("row") - F.shiftleft("part", _ID_BITS))
    rows = materialize(rows.drop("row"), "paths")
    ends = rows.groupBy("part").agg(
        F.min_by("path", "idx").alias("head"), F.max_by("path", "idx").alias("tail"), F.max("idx").alias("last"))
    shards = Window.orderBy("part")  # one row a shard
    ends = ends.select(F.col("part").alias("_part"), "last", F.lag("tail").over(shards).alias("before"), F.lead("head").over(shards).alias("after"))
    ends = broadcast_if_small(materialize(ends, "shard-ends"))
    rows = rows.join(ends, F.col("part") == F.col("_part")).select(
        *rows.columns, F.when(F.col("idx") == 0, F.col("before")).alias("before"),
        F.when(F.col("idx") == F.col("last"), F.col("after")).alias("after"))
    first_depth = band * segment
    return materialize(rows.groupBy("part").applyInArrow(lambda shard: _shard_of_table(shard, first_depth), NODE), "nodes")


def _merge_spines(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one row per node, those of them that several shards have); nodes of one shard pass as they are."""
    merged = nodes.where("spine").groupBy("id1", "id2").agg(
        F.first("p1").alias("p1"), F.first("p2").alias("p2"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.min("parent_conv_id").alias("parent_conv_id"),
        *[F.sum(c).cast("long").alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
        F.max("parent_spine").alias("parent_spine"))
    merged = materialize(merged, "spines")
    alone = nodes.where(~F.col("spine")).drop("spine")
    return alone.unionByName(merged), merged


def _with_parents(nodes: DataFrame, spines: DataFrame) -> DataFrame:
    """Take the parent's smallest member from the merged ``spines`` where the parent is one of them."""
    known = broadcast_if_small(spines).select(
        F.col("id1").alias("_1"), F.col("id2").alias("_2"), F.col("conv_id").alias("_conv"))
    met = F.col("parent_spine") & (F.col("p1") == F.col("_1")) & (F.col("p2") == F.col("_2"))
    return nodes.join(known, met, "left").withColumn("parent_conv_id", F.coalesce("_conv", "parent_conv_id")).drop("_1", "_2", "_conv")


def prefix_trie(turns: DataFrame, conversations: DataFrame, segment: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """(nodes, ends) of the trie over ``turns`` (conv_id, at, x1, x2, chars).

    nodes: id1, id2, conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved.  ends: conv_id, e1, e2 - the node each of
    ``conversations`` (conv_id, distinct) ends at.
    """
    ship_code(turns.sparkSession)
    segments = _segments(turns, conversations, segment)
    paths = segments.groupBy("s", "path").agg(
        F.first("e1").alias("e1"), F.first("e2").alias("e2"), F.count(F.lit(1)).alias("weight"), F.min("conv_id").alias("least"))
    paths = materialize(paths, "distinct-paths")
    ends = segments.groupBy("conv_id").agg(F.max_by("e1", "s").alias("e1"), F.max_by("e2", "s").alias("e2"))
    deepest = paths.agg(F.max("s")).first()[0]
    below, above = None, []
    for band in range(0 if deepest is None else deepest, -1, -1):
        nodes, spines = _merge_spines(_encode_band(paths, below, band, segment))
        top = F.col("p1").isNull()
        if band:
            below = nodes.where(top).select(
                "id1", "id2", F.col("n_leaves").alias("leaves"), "saved", F.col("n_children").alias("children"))
            below = materialize(below, "below")
        nodes = _with_parents(nodes if not band else nodes.where(~top), spines.where(~top) if band else spines)
        if above:  # the band below has its top nodes' parents here, at the end of the segment
            joints = nodes.where(F.col("depth") == (band + 1) * segment)
            above[-1] = _with_parents(above[-1], materialize(joints.select("id1", "id2", "conv_id"), "joints"))
        above.append(nodes)
    return functools.reduce(DataFrame.unionByName, above).select("id1", "id2", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved"), ends


def _id_texts(batches):
    """Rows (e1, e2, first, ids) of up to ``_IDS`` joined ids, from sorted rows (e1, e2, conv_id)."""
    for batch in batches:
        e1, e2, conv = (c.to_numpy() for c in batch.columns)
        new = np.concatenate([[True], (e1[1:] != e1[:-1]) | (e2[1:] != e2[:-1])])[: len(conv)]
        first = np.flatnonzero(new)
        run = np.arange(len(conv)) - np.repeat(first, np.diff(np.concatenate([first, [len(conv)]])))
        cut = np.flatnonzero(run % _IDS == 0)
        stop = np.concatenate([cut[1:], [len(conv)]])[: len(cut)]
        texts = [",".join(map(str, conv[a:b].tolist())) for a, b in zip(cut.tolist(), stop.tolist())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(e1[cut]), pa.array(e2[cut]), pa.array(conv[cut]), pa.array(texts, pa.string())], ["e1", "e2", "first", "ids"])


def _id_digests(batches):
    """(e1, e2, sha) from rows (e1, e2, first, ids) sorted by all three; one hash state at a time."""
    now, state = None, None
    for batch in batches:
        done = []
        for e1, e2, text in zip(*(batch.column(c).to_pylist() for c in ("e1", "e2", "ids"))):
            if (e1, e2) != now:
                if now:
                    done.append((*now, state.hexdigest()))
                now, state = (e1, e2), hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        if done:
            yield _digest_batch(done)
    if now:
        yield _digest_batch([(*now, state.hexdigest())])


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["e1", "e2", "sha"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(e1, e2, sha): SHA-256 of the comma-joined ids, ascending, of the conversations that end at each node.

    A digest reads its ids in order, so a node's joined ids pass one task; they
    stream through it in rows of ``_IDS``.
    """
    key = ["e1", "e2", "conv_id"]
    texts = ends.select(*key).repartitionByRange(*key).sortWithinPartitions(*key).mapInArrow(
        _id_texts, "e1 long, e2 long, first long, ids string")
    texts = texts.repartition("e1", "e2").sortWithinPartitions("e1", "e2", "first")
    return texts.mapInArrow(_id_digests, "e1 long, e2 long, sha string")
