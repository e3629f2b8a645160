"""Merkle manifest of a dataset, with a persistent tree for tampered versions.

Every row is a leaf.  Leaves of one tree (a source) are put in order; runs of
``RUN`` neighbours become their parent until one node, the subroot, is left.
The subroots, in order of source, are the leaves of the tree above, whose top
is the dataset's root.

Trees are cut into aligned blocks of ``RUN ** block_levels`` nodes, so a task
handles one block at a time whatever the size of its tree, and the block tops
are the nodes of the next round.  Inside a block the tree is persistent: a
tampered leaf gives a new version of the block that copies the leaf's
ancestors and shares every other node (:class:`Tree`).  Above the block, a
version goes on where the rows are: the block's written path to the root is
joined to its leaves, and each version copies its ancestors along that path.
Blocks are joined by number, so no key holds more rows than one block.

Hashing: H is the lowercase hex SHA-256 of the concatenated inputs, digests as
hex text; tables hold the 32 bytes.

Cases: a null value is hashed as ``-``, another one as its UTF-8 byte count,
``:`` and text.  Null ordering values come first.  Repeated rows are leaves of
their own, next to each other; equal ordering values are ordered by digest.  A
tree of one leaf has it as its subroot, one source makes the subroot the root.
Texts are hashed whole inside the JVM and leave the scan as digests.  An empty
table gives no rows.  Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faresight.llm.tables import materialise

RUN = 3
BLOCK_LEVELS = 6

_WALKED = "tree string, block long, pos long, n long, doc_id long, digest binary, path array<binary>, top binary, folded binary"


def hashed(*parts: bytes) -> bytes:
    """H of digests: SHA-256 over their hex texts."""
    return hashlib.sha256("".join(p.hex() for p in parts).encode("ascii")).digest()


def height(n: int) -> int:
    """Rounds of grouping until one of ``n`` nodes is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // RUN), levels + 1
    return levels


class Tree:
    """A persistent tree over digests: a node is ``(digest, children)`` and never changes.

    :meth:`put` returns another tree that shares all nodes but the ancestors
    of one leaf.
    """

    def __init__(self, digests: Sequence[bytes], levels: int):
        nodes = [(d, ()) for d in digests]
        for _ in range(levels):
            nodes = [self._parent(tuple(nodes[i:i + RUN])) for i in range(0, len(nodes), RUN)]
        self.levels = levels
        self.node = nodes[0]

    @staticmethod
    def _parent(children: tuple) -> tuple:
        return hashed(*[c[0] for c in children]), children

    @property
    def top(self) -> bytes:
        return self.node[0]

    def _turns(self, leaf: int) -> list[int]:
        """The child to take at each level from the top down to ``leaf``."""
        return [leaf // RUN ** level % RUN for level in range(self.levels - 1, -1, -1)]

    def put(self, leaf: int, digest: bytes) -> Tree:
        """The version in which ``leaf`` has another digest."""
        turns, spine = self._turns(leaf), [self.node]
        for t in turns[:-1]:
            spine.append(spine[-1][1][t])
        node = (digest, ())
        for old, t in zip(reversed(spine if turns else []), reversed(turns)):
            node = self._parent((*old[1][:t], node, *old[1][t + 1:]))
        version = Tree.__new__(Tree)
        version.levels, version.node = self.levels, node
        return version

    def path(self, leaf: int) -> list[bytes]:
        """Digests before and after the leaf's ancestor at each level, bottom up (two entries a level)."""
        sides, node = [], self.node
        for t in self._turns(leaf):
            sides.append((b"".join(c[0] for c in node[1][:t]), b"".join(c[0] for c in node[1][t + 1:])))
            node = node[1][t]
        return [s for pair in reversed(sides) for s in pair]


# -- leaves -------------------------------------------------------------------

def field(value: Column) -> Column:
    """A value as hashed text: ``-`` if null, else byte count, ``:`` and text."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    """The 32-byte digest of a row."""
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


# -- positions ------------------------------------------------------------------

def positions(spark: SparkSession, rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos`` (from 0 inside ``tree``) and ``n`` (rows of the tree), in ``order``.

    Rows are sorted over all by ranges and written; a row's position is its
    place in its sorted part plus the sizes of the tree's earlier parts.  Only
    one count for each part and tree is summed over.  ``_row`` separates equal
    rows, so a value that many rows share is split as well.
    """
    keyed = rows.withColumn("_row", F.monotonically_increasing_id())
    keys = ["tree", *order, "_row"]
    sorted_rows = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = materialise(spark, sorted_rows.drop("_row").select(
        "*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")), "merkle-order")
    parts = placed.groupBy("_part", "tree").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    up_to = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = (parts.withColumn("_before", F.sum("_rows").over(up_to) - F.col("_rows"))
                  .withColumn("n", F.sum("_rows").over(Window.partitionBy("tree"))))
    return (placed.join(parts.drop("_rows"), ["_part", "tree"])
                  .withColumn("pos", F.col("_before") + F.col("_at") - F.col("_first"))
                  .drop("_part", "_at", "_first", "_before"))


# -- blocks -----------------------------------------------------------------------

def _walk(block_levels: int):
    """Each block of nodes -> one row a node: its path inside the block, the block's top, the top of its version."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            members = row["members"]
            tree = Tree([m["digest"] for m in members], min(block_levels, height(row["n"])))
            paths = [tree.path(i) for i in range(len(members))]
            folded = [tree.top if m["altered"] is None else tree.put(i, m["altered"]).top for i, m in enumerate(members)]
            k = len(members)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["tree"]] * k, pa.string()), pa.array([row["block"]] * k, pa.int64()),
                 pa.array([m["pos"] for m in members], pa.int64()), pa.array([row["n"]] * k, pa.int64()),
                 pa.array([m["doc_id"] for m in members], pa.int64()), pa.array([m["digest"] for m in members], pa.binary()),
                 pa.array(paths, pa.list_(pa.binary())), pa.array([tree.top] * k, pa.binary()), pa.array(folded, pa.binary())],
                ["tree", "block", "pos", "n", "doc_id", "digest", "path", "top", "folded"])

    return rows


def _walked(spark: SparkSession, nodes: DataFrame, block_levels: int) -> DataFrame:
    """One round: nodes (tree, pos, n, doc_id, digest, altered) gathered by block and walked."""
    member = F.struct("pos", "digest", "altered", "doc_id")
    blocks = (nodes.groupBy("tree", F.floor(F.col("pos") / RUN ** block_levels).alias("block"), "n")
                   .agg(F.sort_array(F.collect_list(member)).alias("members")))
    return materialise(spark, blocks.mapInArrow(_walk(block_levels), _WALKED), "merkle-blocks")


def _forest(spark: SparkSession, nodes: DataFrame, block_levels: int) -> tuple[list[DataFrame], DataFrame]:
    """All rounds of all trees: the walked rows of each round, and ``tree, subroot, _round`` (the round it ended in)."""
    rounds, tops, block = [], None, RUN ** block_levels
    while True:
        walked = _walked(spark, nodes, block_levels)
        rounds.append(walked)
        heads = walked.filter(F.col("pos") == F.col("block") * block).select(
            "tree", F.col("block").alias("pos"), F.ceil(F.col("n") / block).alias("n"), F.col("top").alias("digest"))
        done = heads.filter("n = 1").select("tree", F.col("digest").alias("subroot"), F.lit(len(rounds)).alias("_round"))
        tops = done if tops is None else tops.unionAll(done)
        heads = heads.filter("n > 1")
        if heads.isEmpty():
            return rounds, tops
        nodes = heads.withColumn("doc_id", F.lit(None).cast("long")).withColumn("altered", F.lit(None).cast("binary"))


def _paths_up(spark: SparkSession, rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """For each block of the first round: ``tree, pos, up, root, subroot``; ``tops`` has the ends by tree and round."""
    upper = None
    for k in range(len(rounds), 0, -1):
        ended = tops.filter(F.col("_round") == k).select("tree", F.lit(0).cast("long").alias("pos"), "up", "root", "subroot")
        here = ended if upper is None else ended.unionAll(upper)
        if k == 1:
            return here
        nodes = rounds[k - 1].select("tree", "pos", "block", "path")
        here = here.withColumnRenamed("pos", "block")
        upper = materialise(spark, nodes.join(here, ["tree", "block"]).select(
            "tree", "pos", F.concat("path", "up").alias("up"), "root", "subroot"), "merkle-upper")
    raise AssertionError("a forest has a round at least")


def fold(digest: Column, path: Column) -> Column:
    """The top that a digest and the digests beside its ancestors give (one native pass over the path)."""
    levels = F.sequence(F.lit(0), F.shiftright(F.size(path), 1) - 1)
    text = lambda b: F.lower(F.hex(b))
    return F.when(F.size(path) == 0, text(digest)).otherwise(F.aggregate(
        levels, text(digest),
        lambda node, i: F.sha2(F.concat(text(path[2 * i]), node, text(path[2 * i + 1])), 256)))


def manifest(spark: SparkSession, leaves: DataFrame, order: Sequence[str] = ("doc_id",),
             block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """Paths and tops of all leaves, original and tampered.

    ``leaves``: source (string), doc_id (long), digest (binary), altered
    (binary; the tampered leaf, null if none).  Result: source, doc_id, leaf,
    subroot, root, proof_sha256, folded_root (hex texts) and verified.
    """
    # a null source is the empty text, another one follows "=", so byte order keeps null first
    tree = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), "source"))
    rows = leaves.select(tree.alias("tree"), "doc_id", "digest", "altered")
    rounds, tops = _forest(spark, positions(spark, rows, [*order, "digest"]), block_levels)
    above = positions(spark, tops.select(
        F.lit("").alias("tree"), F.col("tree").alias("own"), F.col("subroot").alias("digest"), "_round"), ["own"])
    above = materialise(spark, above, "merkle-subroots")
    nodes = above.select("tree", "pos", "n", F.lit(None).cast("long").alias("doc_id"), "digest",
                         F.lit(None).cast("binary").alias("altered"))
    top_rounds, top = _forest(spark, nodes, block_levels)
    top = top.select("tree", "_round", F.array().cast("array<binary>").alias("up"), F.col("subroot").alias("root"), "subroot")
    over = _paths_up(spark, top_rounds, top)
    subpaths = (top_rounds[0].select("tree", "pos", "block", "path")
                .join(over.withColumnRenamed("pos", "block").drop("subroot"), ["tree", "block"])
                .select("pos", F.concat("path", "up").alias("up"), "root"))
    ends = materialise(spark, above.join(subpaths, "pos").select(
        F.col("own").alias("tree"), "_round", "up", "root", F.col("digest").alias("subroot")), "merkle-ends")
    blocks = _paths_up(spark, rounds, ends).withColumnRenamed("pos", "block")
    found = rounds[0].drop("n", "top").join(blocks, ["tree", "block"])
    text = lambda b: F.lower(F.hex(b))
    root, siblings = text(F.col("root")), F.concat(F.array_join(F.transform("path", text), ""),
                                                   F.array_join(F.transform("up", text), ""))
    folded = fold(F.col("folded"), F.col("up"))
    return found.select(
        F.when(F.col("tree") != "", F.substring("tree", 2, 1 << 30)).alias("source"), "doc_id", text("digest").alias("leaf"),
        text("subroot").alias("subroot"), root.alias("root"), F.sha2(siblings, 256).alias("proof_sha256"),
        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def document_leaves(docs: DataFrame, altered_text: Column | None = None, where: Column | None = None) -> DataFrame:
    """Leaves of ``documents``; rows for which ``where`` holds are tampered to have ``altered_text``."""
    before = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    altered = F.lit(None).cast("binary")
    if altered_text is not None:
        altered = F.when(where & ~altered_text.eqNullSafe(F.col("text")), leaf_digest(*before, altered_text))
    return docs.select("source", F.col("doc_id").cast("long").alias("doc_id"),
                       leaf_digest(*before, F.col("text")).alias("digest"), altered.alias("altered"))


def tamper_report(spark: SparkSession, docs: DataFrame, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """The manifest of ``documents``, where rows with an even CRC-32 of doc_id have lost their line ends."""
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    without = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    leaves = materialise(spark, document_leaves(docs, without, even), "merkle-leaves")
    return manifest(spark, leaves, block_levels=block_levels).drop("source")
