"""The trie of conversation prefixes, by van Emde Boas recursion over tables.

A node is a distinct sequence of first d turns; it is known by (smallest member, d). The recursion cuts every block of 2s depths at its
half: the first s turns are the cut prefix, which gets a name; the upper trie keeps the block's forest, the lower forest is the one below
the cut prefix's name, and both are cut again at s/2. All blocks of one size are one table, so each step of the recursion is one Spark
job over all forests in parallel, log2(longest conversation) steps in all; block s has one row per conversation and block, so the steps
together touch each turn about twice. A name is the sum of 120 hash bits of (depth, turn) over the prefix, which two half
blocks add up to whatever the order of the rows: no task needs a whole conversation.

Totals go upward the same way: for s = 1, 2, 4, ... the totals of every lower forest (the children of a cut prefix) are grafted onto the
s nodes of the cut prefix's path in the upper trie, found by one join with the path of its smallest member. Equal conversations
are one weighted sequence from the start.

Hot keys: turns are ranked within (range partition, conversation) and shifted by the counts of the partitions before, so one conversation with
a third of all turns spreads over tasks; nodes are aggregated on the map side first; joins on a node's name are plain
shuffled joins that adaptive execution splits. The digest of a node's members is taken over chunks of ``CHUNK`` ids that tasks of
a range partition write; the last step streams a node's chunks through one hash state, as SHA-256 needs them in order.

Defined results: turns of a null conv_id are dropped; null role or text is empty; turns of one number come by role, then by digest; repeated rows
are turns of their own. Extra columns are ignored. A conversation of up to 2**23 turns has exact names (a sum that would
overflow raises). An empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import written

CHUNK = 512
EMPTY = hashlib.sha256(b"").hexdigest()
_LIMBS = ("a", "b", "c")


def ordered_turns(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), digest and chars (code points of the text) of every turn."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)), 1, 16)
    rows = turns.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), digest.alias("digest"),
                                                      F.length(text).cast("long").alias("chars"))
    # repeated rows are alike, so the last sort key may deal them out at random
    spread = rows.repartitionByRange("conv_id", "turn", "role", "digest", F.rand(0)).withColumn("part", F.spark_partition_id())
    spread = written(spread, "trie_turns")
    before = (spread.groupBy("part", "conv_id").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("before", F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
              .select("part", "conv_id", F.coalesce("before", F.lit(0)).alias("before")))
    local = F.row_number().over(Window.partitionBy("part", "conv_id").orderBy("turn", "role", "digest"))
    return (spread.withColumn("local", local).join(before, ["part", "conv_id"])
            .select("conv_id", (F.col("before") + F.col("local")).alias("pos"), "digest", "chars"))


def with_shared_openings(turns: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """(rebuilt turns, conversation ids): conversation c opens with the first h turns of conversation c - c % ``every`` and goes on with its own
    turns after its first h; h = crc32(decimal c) % ``most``."""
    turns = written(turns, "trie_ordered")
    ids = (turns.select("conv_id").distinct()
           .withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).withColumn("base", F.col("conv_id") - F.col("conv_id") % every))
    openings = turns.filter(F.col("pos") < most).withColumnRenamed("conv_id", "base")  # fewer than ``most`` rows a conversation
    opening = ids.join(openings, "base").filter("pos <= h").select("conv_id", "pos", "digest", "chars")
    taken = ids.join(opening.groupBy("conv_id").agg(F.count(F.lit(1)).alias("taken")), "conv_id", "left").select("conv_id", "h", F.coalesce("taken", F.lit(0)).alias("taken"))
    own = (turns.join(taken, "conv_id").filter("pos > h")
           .select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "digest", "chars"))
    return opening.unionByName(own), ids.select("conv_id")


def _hashes() -> list[Column]:
    return [F.shiftrightunsigned(F.xxhash64(F.lit(i), "pos", "digest"), 24).alias(x) for i, x in enumerate(_LIMBS)]


def _named(name: str, limbs: list[Column]) -> Column:
    return F.struct(*[c.alias(x) for c, x in zip(limbs, _LIMBS)]).alias(name)


def prefix_trie(turns: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, members) of the sequences in ``turns`` (conv_id, pos from 1 without gaps, digest, chars) of the distinct conversations ``ids``.

    nodes: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens. members: conv_id, depth of the node
    at which each conversation ends, member."""
    root = F.struct(*[F.lit(0).cast("long").alias(x) for x in _LIMBS])
    rows = written(turns.select("conv_id", "pos", "chars", *_hashes()), "trie_rows")
    whole = rows.groupBy("conv_id").agg(F.max("pos").alias("depth"), _named("name", [F.sum(x) for x in _LIMBS]))
    ends = written(ids.join(whole, "conv_id", "left").select("conv_id", F.coalesce("depth", F.lit(0)).cast("long").alias("depth"), F.coalesce("name", root).alias("name")), "trie_ends")
    everyone = ends.agg(F.min("conv_id").alias("least"), F.count(F.lit(1)).alias("n"), F.max("depth").alias("deepest")).first()
    if not everyone["n"]:
        nodes = ids.select("conv_id", *[F.lit(None).cast("long").alias(c) for c in ("depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")])
        return nodes, ids.select("conv_id", F.lit(0).cast("long").alias("depth"), F.col("conv_id").alias("member"))
    one_each = ends.groupBy("name").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight"), F.min("depth").alias("length"))
    seqs = written(rows.join(one_each.select("conv_id", "weight", "length"), "conv_id"), "trie_sequences")

    paths = _node_names(seqs, root, everyone["deepest"])
    named = written(paths.groupBy("name").agg(F.min("conv_id").alias("conv_id"), F.min("pos").alias("depth"), F.sum("weight").alias("n_convs"), F.min("chars").alias("chars")), "trie_names")
    placed = written(paths.drop("chars").join(named.select("name", F.col("conv_id").alias("node"), "n_convs", "chars"), "name")
                     .select("conv_id", F.col("pos").alias("depth"), "node", "length", "n_convs", "chars"), "trie_places")
    above = placed.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent_conv_id"))
    steps = written(placed.join(above, ["conv_id", "depth"], "left")
                    .withColumn("parent_conv_id", F.coalesce("parent_conv_id", F.lit(everyone["least"]).cast("long"))), "trie_steps")
    linked = steps.filter("node = conv_id").select("conv_id", "depth", "parent_conv_id", "n_convs", "chars")  # a node on its smallest member's path
    children = linked.groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    tree = written(linked.join(children, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie_tree")

    totals = _grafted(tree, steps, everyone["deepest"])
    below = totals.filter("depth = 1").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    top = (below.crossJoin(tree.filter("depth = 1").agg(F.count(F.lit(1)).alias("n_children")))  # two single rows
           .select(F.lit(everyone["least"]).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
                   F.lit(everyone["n"]).cast("long").alias("n_convs"), "n_children", F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"),
                   F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens")))
    nodes = tree.join(totals, ["conv_id", "depth"]).select("conv_id", F.col("depth").cast("long").alias("depth"), *top.columns[2:]).unionByName(top)
    members = (ends.withColumnRenamed("conv_id", "member").join(named.select("name", "conv_id"), "name", "left")
               .select(F.coalesce("conv_id", F.lit(everyone["least"]).cast("long")).alias("conv_id"), "depth", "member"))
    return nodes, members


def _node_names(seqs: DataFrame, root: Column, deepest: int) -> DataFrame:
    """conv_id, pos, chars, weight, length and the name of the prefix that ends there, for every turn of every distinct sequence.

    Downward through the half cuts: a block's upper half belongs to the block's forest, its lower half to the forest of the cut prefix,
    whose name is the forest's plus the upper half's sum. The sums come from the halves of the block size below. A sequence enters at the
    least block size that holds it whole."""
    block = seqs.select("conv_id", (F.col("pos") - 1).alias("block"), *_LIMBS)
    cuts = []
    while (1 << len(cuts)) < deepest:
        is_lower = F.col("block") % 2 == 1
        block = written(block.groupBy("conv_id", F.shiftright("block", 1).alias("block"))
                        .agg(*[F.sum(x).alias(x) for x in _LIMBS], _named("upper", [F.sum(F.when(~is_lower, F.col(x))) for x in _LIMBS]), F.max(is_lower).alias("cut"))
                        .filter("block > 0 or cut"), f"trie_cut{len(cuts)}")
        cuts.append(block.select("conv_id", "block", "upper", "cut"))
    heads = written(seqs.filter("pos = 1").select("conv_id", "length", F.lit(0).cast("long").alias("block"), root.alias("forest")), "trie_heads")

    def entering(level: int) -> DataFrame:
        return heads.filter(F.col("length").between((1 << level) // 2 + 1, 1 << level)).select("conv_id", "block", "forest")

    forest = entering(len(cuts))
    for level, halves in reversed(list(enumerate(cuts))):
        cut_prefix = _named("forest", [F.col(f"forest.{x}") + F.col(f"upper.{x}") for x in _LIMBS])
        both = F.array(F.struct((F.col("block") * 2).alias("block"), F.col("forest").alias("forest")), F.struct((F.col("block") * 2 + 1).alias("block"), cut_prefix))
        forest = forest.join(halves, ["conv_id", "block"]).select("conv_id", F.explode(F.slice(both, 1, F.when(F.col("cut"), 2).otherwise(1))).alias("half")).select("conv_id", "half.*")
        forest = forest.unionByName(entering(level))
    name = _named("name", [F.col(f"forest.{x}") + F.col(x) for x in _LIMBS])
    return written(seqs.join(forest.select("conv_id", (F.col("block") + 1).alias("pos"), "forest"), ["conv_id", "pos"]).select("conv_id", "pos", "chars", "weight", "length", name), "trie_paths")


def _grafted(tree: DataFrame, steps: DataFrame, deepest: int) -> DataFrame:
    """conv_id, depth, n_leaves, saved_tokens over every node's subtree (the root left out)."""
    sums = [F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")]
    found = tree.select("conv_id", "depth", "parent_conv_id", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"))
    level = 0
    while (size := 1 << level) < deepest:
        # roots of lower forests stand just below the cut at half of every block of 2 * size depths
        forests = (found.filter((F.col("depth") - 1) % (2 * size) == size)
                   .groupBy(F.col("parent_conv_id").alias("conv_id"), ((F.col("depth") - 2) / size).cast("long").alias("block")).agg(*sums))
        upper = steps.filter(F.col("length") >= size).withColumn("block", ((F.col("depth") - 1) / size).cast("long")).filter(F.col("block") % 2 == 0)
        grafts = upper.join(forests, ["conv_id", "block"]).groupBy(F.col("node").alias("conv_id"), "depth", "parent_conv_id").agg(*sums)
        found = found.unionByName(written(grafts, f"trie_graft{level}"))
        level += 1
    return found.groupBy("conv_id", "depth").agg(*sums)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members sorted by (conv_id, depth, member) as comma-joined chunks of one node each."""
    for batch in batches:
        conv, depth, member = (batch.column(i).to_numpy() for i in range(3))
        if not len(conv):
            continue
        new = np.flatnonzero(np.r_[True, (conv[1:] != conv[:-1]) | (depth[1:] != depth[:-1])])
        bounds = np.unique(np.concatenate([np.arange(a, b, CHUNK) for a, b in zip(new, np.r_[new[1:], len(conv)])]))
        texts = [",".join(map(str, member[a:b].tolist())) for a, b in zip(bounds, np.r_[bounds[1:], len(conv)])]
        yield pa.RecordBatch.from_arrays([pa.array(conv[bounds]), pa.array(depth[bounds]), pa.array(member[bounds]), pa.array(texts)], ["conv_id", "depth", "first", "chunk"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node from its chunks in order, whatever the batches they come in."""
    names = ["conv_id", "depth", "ends_sha256"]
    node, state = None, None
    for batch in batches:
        out = []
        for conv, depth, chunk in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist()):
            if (conv, depth) == node:
                state.update(b"," + chunk.encode())
                continue
            if node is not None:
                out.append((*node, state.hexdigest()))
            node, state = (conv, depth), hashlib.sha256(chunk.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*node, state.hexdigest())], names)


def member_digests(members: DataFrame) -> DataFrame:
    """conv_id, depth, ends_sha256 of every node at which a conversation ends: the SHA-256 of its members' ids in ascending order."""
    chunks = (members.select("conv_id", "depth", "member").repartitionByRange("conv_id", "depth", "member").sortWithinPartitions("conv_id", "depth", "member")
              .mapInArrow(_chunks, "conv_id long, depth long, first long, chunk string"))
    chunks = written(chunks, "trie_chunks")
    return (chunks.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "first")
            .mapInArrow(_hashed, "conv_id long, depth long, ends_sha256 string"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """All prefix nodes of the rebuilt conversations, with the digest of those that end there."""
    nodes, members = prefix_trie(*with_shared_openings(ordered_turns(conversations)))
    digests = member_digests(written(members, "trie_members"))
    return (nodes.join(digests, ["conv_id", "depth"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256")))
