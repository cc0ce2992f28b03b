"""The prefix trie of conversations by whole-sequence collapse.

Identical conversations become one weighted sequence with the digest of its list of members. Sequences that are proper
prefixes of others fall out by an anti-join; the rest are the leaves. The nodes are the weighted prefixes of the distinct
sequences, aggregated by key. A key is the pair of running XORs of two 64-bit hashes of (depth, SHA-256 of the turn), so
texts are read once and never shuffled, and an empty prefix has the key (0, 0).

Sums over subtrees need no walk. A node belongs to its smallest member, so the nodes that one sequence owns are the end of
its path, from depth ``top`` on; any sum over the distinct nodes below a node is a sum over the sequences through it.

Rows without a conversation id belong to no conversation. Turns are ordered by ``turn``, NULL first, equal ones by the
SHA-256 of their role and text; repeated rows are turns of their own; a NULL role or text is empty. An empty table has no
nodes. Only named columns are read. One conversation's turns pass one task in order, as digests, spilled to disk if many.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.session import materialise

KEY = ["depth", "k1", "k2"]


def turn_digests(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, pos, digest, chars): the turns of every conversation numbered from 0, without their texts."""
    said, by = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    whole = F.concat(F.length(by).cast("string"), F.lit(":"), by, said).cast("binary")
    digests = df.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).alias("_turn"),
        F.unhex(F.sha2(whole, 256)).alias("digest"),
        F.length(said).cast("long").alias("chars"),
    )
    order = Window.partitionBy("conv").orderBy(F.asc_nulls_first("_turn"), "digest")
    return digests.withColumn("pos", (F.row_number().over(order) - 1).cast("long")).drop("_turn")


def with_shared_heads(turns: DataFrame, every: int, heads: int) -> tuple[DataFrame, DataFrame]:
    """(turns, ids): conversation c gets the first h turns of c - c % ``every`` in place of its own first h.

    h is the crc32 of the decimal id modulo ``heads``. A base that is absent gives no turns, a shorter one all it has.
    """
    numbered = materialise(turns, "turns")
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % heads
    convs = numbered.where("pos = 0").select("conv", (F.col("conv") - F.col("conv") % every).alias("base"), h.alias("h"))
    first = numbered.where((F.col("pos") < heads) & (F.col("conv") % every == 0))
    borrowed = (
        convs.join(first.withColumnRenamed("conv", "base"), "base")
        .where("pos < h")
        .select("conv", F.lit(0).alias("part"), "pos", "digest", "chars")
    )
    own = numbered.where(F.col("pos") >= h).select("conv", F.lit(1).alias("part"), "pos", "digest", "chars")
    order = Window.partitionBy("conv").orderBy("part", "pos")
    rebuilt = borrowed.unionByName(own).withColumn("pos", (F.row_number().over(order) - 1).cast("long")).drop("part")
    return rebuilt, convs.select("conv")


def prefix_trie(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations ``ids``, whose turns come as (conv, pos, digest, chars).

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256. A
    conversation without turns ends at the root.
    """
    order = Window.partitionBy("conv").orderBy("pos")
    hashes = {"h1": F.xxhash64("depth", "digest"), "h2": F.xxhash64("digest", "depth", F.lit("second"))}
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    steps = materialise(
        turns.withColumn("depth", F.col("pos") + 1)
        .withColumns(hashes)
        .select(
            "conv", "depth", "chars", "h1", "h2",
            F.bit_xor("h1").over(running).alias("k1"),
            F.bit_xor("h2").over(running).alias("k2"),
            F.sum("chars").over(running).alias("so_far"),
            F.lead("pos").over(order).isNull().alias("is_last"),
        ),
        "prefixes",
    )
    root = {"depth": F.lit(0).cast("long"), "k1": F.lit(0).cast("long"), "k2": F.lit(0).cast("long")}
    ended = steps.where("is_last").select("conv", *KEY, F.col("so_far").alias("total"))
    turnless = ids.select("conv").distinct().join(ended, "conv", "left_anti").withColumns(root)
    members = materialise(ended.unionByName(turnless.withColumn("total", F.lit(0).cast("long"))), "members")

    collapsed = members.groupBy(*KEY).agg(
        F.min("conv").alias("conv"), F.count("*").alias("weight"), F.max("total").alias("total")
    )
    sequences = materialise(collapsed.join(end_digests(members), KEY).withColumnRenamed("depth", "length"), "sequences")

    path = sequences.select("conv", "length", "weight", "total")
    below = steps.join(path, "conv").select(
        *path.columns, *KEY, "chars", F.col("k1").bitwiseXOR(F.col("h1")).alias("up1"),
        F.col("k2").bitwiseXOR(F.col("h2")).alias("up2"), (F.col("total") - F.col("so_far") + F.col("chars")).alias("rest"),
    )
    zero = F.lit(0).cast("long")
    tops = path.withColumns({**root, "chars": zero, "up1": zero, "up2": zero, "rest": F.col("total")})
    prefixes = materialise(below.unionByName(tops), "paths")

    owners = materialise(
        prefixes.groupBy(*KEY).agg(
            F.min(F.struct("conv", "rest")).alias("owner"), F.max(F.col("depth") < F.col("length")).alias("inner")
        ).select(*KEY, "owner.*", "inner"),
        "owners",
    )
    from_top = owners.groupBy("conv").agg(F.min(F.struct("depth", "rest")).alias("top")).select(
        "conv", F.col("top.depth").alias("top"), F.col("top.rest").alias("owned")
    )
    continued = owners.where("inner").select(F.col("depth").alias("length"), "k1", "k2")
    leaves = sequences.join(continued, ["length", "k1", "k2"], "left_anti").select("conv", F.lit(1).alias("leaf"))
    known = (
        sequences.select("conv", "ends_sha256").join(from_top, "conv", "left").join(leaves, "conv", "left")
    )
    depth, length, top = F.col("depth"), F.col("length"), F.col("top")
    # A sequence that owns no node has no top.
    distinct_chars = F.when(top.isNull(), 0).when(depth >= top, F.col("rest")).otherwise(F.col("owned"))
    owns_child = (top <= depth + 1) & (depth < length)
    nodes = materialise(
        prefixes.join(known, "conv").groupBy(*KEY).agg(
            F.min(F.struct("conv", "top", "up1", "up2")).alias("owner"),
            F.sum("weight").alias("n_convs"),
            F.count(F.when(owns_child, 1)).alias("n_children"),
            F.count("leaf").alias("n_leaves"),
            F.sum(F.col("weight") * F.col("rest") - distinct_chars).alias("saved_tokens"),
            F.max(F.when(depth == length, F.col("ends_sha256"))).alias("ends"),
        ).select(
            F.col("owner.conv").alias("conv_id"), "depth", F.col("owner.top").alias("top"), "owner.up1", "owner.up2",
            "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        ),
        "nodes",
    )
    # Below the top of its owner a node's parent has the same owner; the root's owner is the smallest of all.
    inside = F.when(nodes["depth"] > nodes["top"], nodes["conv_id"])
    smallest = owners.where("depth = 0").agg(F.min("conv")).scalar()
    easy = nodes.where("depth < 2 OR depth > top").withColumn(
        "parent_conv_id", F.coalesce(inside, F.when(F.col("depth") == 1, smallest))
    )
    above = owners.select(
        F.col("conv").alias("parent_conv_id"), (F.col("depth") + 1).alias("depth"), F.col("k1").alias("up1"),
        F.col("k2").alias("up2"),
    )
    # Many tops may hang below one node, which is one row here: AQE splits such a key without repeating more than that.
    hard = nodes.where("depth >= 2 AND depth = top").join(above, ["depth", "up1", "up2"])
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return easy.select(*columns).unionByName(hard.select(*columns))


def end_digests(members: DataFrame) -> DataFrame:
    """(key, ends_sha256): SHA-256 of the members' decimal ids of each sequence, ascending and comma-joined.

    A sequence that very many conversations share is sorted in many tasks, each of which joins its ids to blocks; the
    digest itself is sequential and takes the blocks one by one.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(k).to_numpy(zero_copy_only=False) for k in KEY]
            new = np.ones(batch.num_rows, bool)
            new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
            starts = np.flatnonzero(new)
            ids = batch.column("conv")
            lists = pa.ListArray.from_arrays(
                pa.array(np.append(starts, batch.num_rows).astype(np.int32)), ids.cast(pa.string())
            )
            rows = pa.array(starts)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k).take(rows) for k in KEY], ids.take(rows), pc.binary_join(lists, ",")],
                names=[*KEY, "first", "ids"],
            )

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, state, out = None, None, []
        for batch in batches:
            for row in batch.to_pylist():
                key = tuple(row[k] for k in KEY)
                if key == own:
                    state.update(b"," + row["ids"].encode())
                    continue
                if own is not None:
                    out.append((*own, state.hexdigest()))
                own, state = key, hashlib.sha256(row["ids"].encode())
            if out:
                yield _digest_rows(out)
                out = []
        if own is not None:
            yield _digest_rows([(*own, state.hexdigest())])

    key = "depth long, k1 long, k2 long"
    in_order = members.select(*KEY, "conv").repartitionByRange(*KEY, "conv").sortWithinPartitions(*KEY, "conv")
    joined = in_order.mapInArrow(blocks, f"{key}, first long, ids string")
    return (
        joined.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(digests, f"{key}, ends_sha256 string")
    )


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    kinds = [pa.int64()] * len(KEY) + [pa.string()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[*KEY, "ends_sha256"]
    )
