"""Merkle manifest of a dataset, kept as a persistent tree.

Every row is a leaf.  The leaves of a group (a source) stand in order of their ids and form a tree of fan-out 16; the
groups' roots form one tree above them.  The tree is cut into aligned blocks of three levels, 4,096 nodes wide: a block
is built in one task from its own nodes alone, and the blocks' tops are the leaves of the blocks above, so a group of
any size is many small blocks.  The trees above are tables too, climbed three levels a round.

The tree is persistent: an edited leaf makes a version that shares every untouched node with the original and holds
copies of nothing but the leaf's ancestors.  Copies are made inside the leaf's block and go on over the nodes that the
blocks above name as the siblings of its path, so no version is ever stored whole and none needs another one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelanes.session import stored

FAN_OUT = 16
LEVELS = 3  # of a block
BLOCK = FAN_OUT**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<before:string,after:string>>"  # siblings of a node, level by level, as joined digests


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(fields: Sequence[Column]) -> Column:
    """Digest of a row: every field as ``-`` if null, else its count of UTF-8 bytes, a colon, and its text."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def levels_of(nodes: int) -> int:
    """Levels above ``nodes`` nodes until one remains."""
    n = 0
    while nodes > 1:
        nodes, n = -(-nodes // FAN_OUT), n + 1
    return n


class Block:
    """The nodes above up to BLOCK neighbours, ``levels[0]`` the neighbours themselves."""

    def __init__(self, nodes: list[str], height: int):
        self.levels = [nodes]
        for _ in range(height):
            below = self.levels[-1]
            self.levels.append([digest("".join(below[i:i + FAN_OUT])) for i in range(0, len(below), FAN_OUT)])

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def siblings(self, at: int) -> list[tuple[str, str]]:
        """The digests before and after the path of node ``at`` in its runs, level by level."""
        found = []
        for level in self.levels[:-1]:
            first = at - at % FAN_OUT
            found.append(("".join(level[first:at]), "".join(level[at + 1:first + FAN_OUT])))
            at //= FAN_OUT
        return found


def ancestors(leaf: str, path: Sequence[tuple[str, str]]) -> list[str]:
    """The nodes that a version with ``leaf`` copies: one a level, over the siblings that it shares with the original."""
    copied = []
    for before, after in path:
        leaf = digest(before + leaf + after)
        copied.append(leaf)
    return copied


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``at``, the place of each in its group from 0 on, and ``total``, the group's number of rows.

    The rows are sorted once over range partitions of (group, order), which split a large group; a row's place is its
    place in the partition plus what the partitions before hold of its group.  ``order`` has to tell any two rows
    apart.  Null groups and orders come first."""
    # monotonically_increasing_id numbers a partition's rows in order and keeps the partition in its upper bits
    ranged = stored(rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
                    .withColumn("nr", F.monotonically_increasing_id()).withColumn("part", F.shiftright("nr", 33)), "sorted")
    whole = Window.partitionBy(group)
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = (ranged.groupBy(group, "part").agg(F.count(F.lit(1)).alias("n"), F.min("nr").alias("first"))
             .select(F.col(group).alias("_group"), F.col("part").alias("_part"), F.sum("n").over(whole).alias("total"),
                     (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("_shift")))
    same = (ranged["part"] == spans["_part"]) & ranged[group].eqNullSafe(spans["_group"])
    return ranged.join(spans, same).withColumn("at", F.col("nr") + F.col("_shift")).drop("nr", "part", "_group", "_part", "_shift")


def climb(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All levels above ``nodes`` (tree, at, total, node): their ``path`` to the top, and (tree, top).

    A round takes every block of BLOCK neighbours three levels up.  A block's nodes get their siblings in it; its top
    goes on as a node of the next round, whose path is put behind.  There are as many rounds as the largest tree needs."""
    def up(groups: pa.Table) -> pa.Table:
        rows = groups.sort_by("at")
        at, total = rows["at"].to_pylist(), rows["total"][0].as_py()
        block = Block(rows["node"].to_pylist(), min(LEVELS, levels_of(total)))
        paths = [[{"before": b, "after": a} for b, a in block.siblings(i)] for i in range(len(at))]
        return pa.table({"tree": rows["tree"], "at": rows["at"], "total": rows["total"], "path": pa.array(paths, PATH_TYPE),
                         "block": pa.array([x // BLOCK for x in at], pa.int64()), "top": pa.array([block.top] * len(at))})

    tree = nodes.schema["tree"].dataType.simpleString()
    schema = f"tree {tree}, at long, total long, path {PATH}, block long, top string"
    rounds = []
    while True:
        done = stored(nodes.select("tree", "at", "total", "node", F.floor(F.col("at") / BLOCK).alias("block"))
                      .groupBy("tree", "block").applyInArrow(up, schema), "climbed")
        rounds.append(done)
        nodes = (done.groupBy("tree", "block").agg(F.first("top").alias("node"), F.first("total").alias("total"))
                 .select("tree", F.col("block").alias("at"), F.ceil(F.col("total") / BLOCK).alias("total"), "node"))
        if (nodes.agg(F.max("total")).first()[0] or 1) == 1:
            break
    paths = rounds[-1].select("tree", "at", "path")
    for done in reversed(rounds[:-1]):
        above = paths.select(F.col("tree").alias("_tree"), F.col("at").alias("_at"), F.col("path").alias("_above"))
        same = done["tree"].eqNullSafe(above["_tree"]) & (done["block"] == above["_at"])
        paths = done.join(above, same).select("tree", "at", F.concat("path", "_above").alias("path"))
    return paths, nodes.select("tree", F.col("node").alias("top"))


PATH_TYPE = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


class Manifest:
    """The stored tree: ``blocks``, one row for each block of leaves with its rows packed and the siblings of its path
    to the root, and ``root`` (None without documents)."""

    def __init__(self, blocks: DataFrame, root: str | None):
        self.blocks, self.root = blocks, root

    def proofs(self) -> DataFrame:
        """For every leaf: doc_id, leaf, edited (the new leaf of an edited row, else null), subroot, root,
        proof_sha256 (of its siblings up to the root) and folded_root, the root of its version if it is edited,
        else recomputed from the leaf and its siblings."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in _blocks(batches):
                out = {k: [] for k in ("doc_id", "leaf", "edited", "subroot", "root", "proof_sha256", "folded_root")}
                block, above = rows["block"], rows["above"]
                upper = "".join(b + a for b, a in above).encode()
                for i, (key, leaf, edited) in enumerate(zip(rows["ids"], block.levels[0], rows["edited"])):
                    inner = block.siblings(i)
                    proof = hashlib.sha256("".join(b + a for b, a in inner).encode())
                    proof.update(upper)
                    version = [edited or leaf, *ancestors(edited or leaf, [*inner, *above])]
                    for name, value in zip(out, (key, leaf, edited, rows["subroot"], rows["root"], proof.hexdigest(), version[-1])):
                        out[name].append(value)
                yield pa.RecordBatch.from_pydict(out, pa.schema([("doc_id", pa.int64()), *((k, pa.string()) for k in list(out)[1:])]))

        return self.blocks.mapInArrow(run, "doc_id long, leaf string, edited string, subroot string, root string, proof_sha256 string, folded_root string")

    def versions(self) -> DataFrame:
        """The nodes that the versions copy, one version for each edited leaf: doc_id, level (0 the leaf) and node.
        All other nodes of a version are the original's."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in _blocks(batches):
                copies = [(key, level, node) for i, (key, edited) in enumerate(zip(rows["ids"], rows["edited"])) if edited
                          for level, node in enumerate([edited, *ancestors(edited, [*rows["block"].siblings(i), *rows["above"]])])]
                columns = [pa.array([c[k] for c in copies], kind) for k, kind in enumerate((pa.int64(), pa.int32(), pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "level", "node"])

        return self.blocks.mapInArrow(run, "doc_id long, level int, node string")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Packed blocks, one at a time, with their inner nodes built again from their leaves."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}
            yield {"ids": row["ids"], "edited": [e or None for e in row["edited"]], "block": Block(row["leaves"], row["height"]),
                   "above": [(p["before"], p["after"]) for p in row["path"]], "subroot": row["subroot"], "root": row["root"]}


def build(docs: DataFrame, edited: Column | None = None, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group_col: str = "source",
          text_col: str = "text") -> Manifest:
    """The manifest of all rows of ``docs``.  ``edited`` is the new text of the rows that are edited, null for the others.

    Leaves of a group ascend by id, null ids first, those of one id by their digest; rows that repeat in every field
    are leaves of their own.  A null group is a group, the first.  Fields may be null or empty and texts of any length,
    each is hashed whole where it is read and only digests travel.  An empty table has no blocks and no root.  Columns
    that are no fields are not read, so they may have any names."""
    new = F.lit(None).cast("string") if edited is None else edited
    changed = leaf_of([F.col("_new") if f == text_col else F.col(f) for f in fields])
    rows = stored(docs.select(*fields, F.col(id_col).cast("long").alias("_id"), F.col(group_col).cast("string").alias("tree"), new.alias("_new"))
                  .select(F.col("_id").alias("id"), "tree", leaf_of([F.col(f) for f in fields]).alias("leaf"),
                          F.when(F.col("_new").isNotNull(), changed).alias("edited"), F.monotonically_increasing_id().alias("row")), "leaves")
    leaves = numbered(rows, "tree", ["id", "leaf", "row"])

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by("at")
        height = min(LEVELS, levels_of(group["total"][0].as_py()))
        nodes = group["leaf"].to_pylist()
        return pa.table({"tree": group["tree"][:1], "block": group["block"][:1], "total": group["total"][:1], "height": pa.array([height], pa.int32()),
                         "top": pa.array([Block(nodes, height).top]), "ids": pa.array([group["id"].to_pylist()], pa.list_(pa.int64())),
                         "leaves": pa.array([nodes], pa.list_(pa.string())),
                         "edited": pa.array([[e or "" for e in group["edited"].to_pylist()]], pa.list_(pa.string()))})

    blocks = stored(leaves.withColumn("block", F.floor(F.col("at") / BLOCK)).select("tree", "block", "at", "total", "id", "leaf", "edited")
                    .groupBy("tree", "block").applyInArrow(
                        pack, "tree string, block long, total long, height int, top string, ids array<long>, leaves array<string>, edited array<string>"), "blocks")
    inner, subroots = climb(blocks.select("tree", F.col("block").alias("at"), F.ceil(F.col("total") / BLOCK).alias("total"), F.col("top").alias("node")))
    inner, subroots = stored(inner, "paths"), stored(subroots, "subroots")
    groups = numbered(subroots.select(F.lit(True).alias("all"), "tree", "top"), "all", ["tree"])
    groups = stored(groups.select("tree", "at", "total", "top"), "groups")
    outer, tops = climb(groups.select(F.lit(True).alias("tree"), "at", "total", F.col("top").alias("node")))
    root = next((r.top for r in tops.collect()), None)  # one digest, or none
    of_group = (groups.join(outer.select("at", F.col("path").alias("_outer")), "at")
                .select(F.col("tree").alias("_tree"), F.col("top").alias("subroot"), "_outer"))
    inner = inner.select(F.col("tree").alias("_t"), F.col("at").alias("_b"), F.col("path").alias("_inner"))
    placed = (blocks.join(inner, blocks["tree"].eqNullSafe(inner["_t"]) & (blocks["block"] == inner["_b"]))
              .join(of_group, blocks["tree"].eqNullSafe(F.col("_tree"))))
    return Manifest(placed.select("ids", "leaves", "edited", "height", F.concat("_inner", "_outer").alias("path"), "subroot", F.lit(root).alias("root")), root)
