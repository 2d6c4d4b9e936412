"""Merkle manifest of a table: a tree of digests for each group of rows, and one tree over the groups' subroots.

Checkpoint and recompute: a tree has ``FAN`` children a node, but only every ``STRIDE``-th level is written (the leaves,
then one node for each aligned subtree of ``SPAN`` = FAN ** STRIDE).  A proof needs the nodes between: each aligned
subtree is made again from its written descendants in one small task group, its nodes' siblings go into the proofs, and
the nodes are forgotten.  The siblings above a subtree are the same for all of it and come down once, with its root.

No group holds more than SPAN rows, and texts are hashed where they are read: only digests move.  Rows get their places
from range partitions' counts and prefix sums (one row for each partition and group of rows).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from domloom.llm.common import cut

FAN, STRIDE = 8, 3
SPAN = FAN**STRIDE
#: The columns of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf(fields: list[Column]) -> Column:
    """Digest of the fields: of each its UTF-8 byte count, a colon and the value, or a dash where it is null."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def lowered(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def ranked(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 0 in the order of ``order`` within ``key``) and ``n``, the rows of the key.

    Rows alike in key and order take any of their places; they are dealt out too, so none needs a task of its own.
    """
    sorted_ = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(key, *order, "_row")
    placed = cut(sorted_.sortWithinPartitions(key, *order, "_row").withColumn("_part", F.spark_partition_id()).drop("_row"))
    placed = placed.withColumn("_at", F.monotonically_increasing_id())  # ascends within a partition, without gaps
    counts = placed.groupBy("_part", key).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    own = Window.partitionBy(key)
    before = own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("_part"), F.col(key), "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(own).alias("n"))
    return placed.join(starts, ["_part", key]).withColumn("rank", F.col("_at") - F.col("_first") + F.col("_before")).drop("_part", "_at", "_first", "_before")


@dataclass
class Forest:
    """One tree a key.  ``levels`` are the written ones, from the leaves up: rows key, rank, n (nodes of the key at this
    level), digest; ``tops`` the trees' own digests (key, digest), by the level that their last subtree stands on."""

    levels: list[DataFrame]
    tops: list[DataFrame]

    def subroots(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.tops)


def _run(nodes: list[str]) -> str:
    return sha256("".join(nodes).encode()).hexdigest()


def _subtree(nodes: list[str], n: int) -> list[list[str]]:
    """The levels of an aligned subtree, from ``nodes`` up; its key has ``n`` nodes on the lowest of them."""
    levels, width = [nodes], n
    while width > 1 and len(levels) <= STRIDE:
        below = levels[-1]
        levels.append([_run(below[i : i + FAN]) for i in range(0, len(below), FAN)])
        width = -(-width // FAN)
    return levels


def _siblings(levels: list[list[str]], i: int) -> list[tuple[str, str]]:
    """Of leaf ``i``, on each level below the subtree's root, the digests left and right of its node in the run, joined."""
    out = []
    for nodes in levels[:-1]:
        start = i - i % FAN
        out.append(("".join(nodes[start:i]), "".join(nodes[i + 1 : start + FAN])))
        i //= FAN
    return out


def fold(digest: str, siblings: list[tuple[str, str]]) -> str:
    """The root that a digest and its siblings, from the lowest level up, give."""
    for left, right in siblings:
        digest = sha256(f"{left}{digest}{right}".encode()).hexdigest()
    return digest


def _written(siblings: list[tuple[str, str]]) -> str:
    return "".join(f"{left}|{right};" for left, right in siblings)


def _read(path: str) -> list[tuple[str, str]]:
    return [tuple(level.split("|")) for level in path.split(";")[:-1]]


def _up(group: pa.Table) -> pa.Table:
    group = group.sort_by("rank")
    n, first = group["n"][0].as_py(), group["rank"][0].as_py()
    root = _subtree(group["digest"].to_pylist(), n)[-1][0]
    return pa.table({"key": group["key"][:1], "rank": pa.array([first // SPAN], pa.int64()), "n": pa.array([-(-n // SPAN)], pa.int64()), "digest": pa.array([root], pa.string())})


def build(leaves: DataFrame) -> Forest:
    """The trees of ``leaves`` (key, rank, n, digest, as :func:`ranked` gives them); one job a written level."""
    levels, tops = [leaves], []
    block = F.expr(f"rank div {SPAN}").alias("block")
    while True:
        nodes = levels[-1].select("key", "rank", "n", "digest")
        above = cut(nodes.groupBy("key", block).applyInArrow(_up, "key string, rank long, n long, digest string"))
        tops.append(above.where("n = 1").select("key", "digest"))
        rest = above.where("n > 1")
        if rest.isEmpty():
            return Forest(levels, tops)
        levels.append(rest)


_PATHS = "key string, rank long, path string, subroot string, root string"


def _paths(left: pa.Table, right: pa.Table) -> pa.Table:
    """Every node of a subtree (left) with its siblings up to the root; ``right`` holds those from the subtree's root on."""
    if not left.num_rows or not right.num_rows:
        return pa.table({name: pa.array([], pa.int64() if name == "rank" else pa.string()) for name in ("key", "rank", "path", "subroot", "root")})
    left, above = left.sort_by("rank"), right.to_pylist()[0]
    levels = _subtree(left["digest"].to_pylist(), left["n"][0].as_py())
    same = {name: pa.array([above[name]] * left.num_rows, pa.string()) for name in ("subroot", "root")}
    path = pa.array([_written(_siblings(levels, i)) + above["path"] for i in range(left.num_rows)], pa.string())
    return pa.table({"key": left["key"], "rank": left["rank"], "path": path} | same)


_PROOFS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string"


def _proofs(left: pa.Table, right: pa.Table) -> pa.Table:
    """Each leaf's proof, digested, and the root that its claimed digest gives with it; the proof itself is not kept."""
    out: list[list] = [[], []]
    if not left.num_rows or not right.num_rows:
        left, above = left.slice(0, 0), {"path": "", "subroot": None, "root": None}
    else:
        left, above = left.sort_by("rank"), right.to_pylist()[0]
        levels = _subtree(left["digest"].to_pylist(), left["n"][0].as_py())
        upper = _read(above["path"])
        rest = "".join(left + right for left, right in upper)
        for i, claimed in enumerate(left["claimed"].to_pylist()):
            own = _siblings(levels, i)
            out[0].append(sha256(("".join(a + b for a, b in own) + rest).encode()).hexdigest())
            out[1].append(fold(fold(claimed, own), upper))
    same = {name: pa.array([above[name]] * left.num_rows, pa.string()) for name in ("subroot", "root")}
    return pa.table({"doc_id": left["doc_id"], "leaf": left["digest"]} | same | {"proof_sha256": pa.array(out[0], pa.string()), "folded_root": pa.array(out[1], pa.string())})


def descend(forest: Forest, above: DataFrame, each=_paths, schema: str = _PATHS) -> DataFrame:
    """``each`` over the lowest level's subtrees, from the top down; ``above`` has key, path, subroot, root of every tree."""
    paths = None
    for t in reversed(range(len(forest.levels))):
        parents = forest.tops[t].join(above, "key").select("key", F.lit(0).cast("long").alias("block"), "path", "subroot", "root")
        if paths is not None:
            parents = parents.unionByName(paths.withColumnRenamed("rank", "block"))
        rows = forest.levels[t].withColumn("block", F.expr(f"rank div {SPAN}"))
        step, columns = (each, schema) if t == 0 else (_paths, _PATHS)
        paths = rows.groupBy("key", "block").cogroup(parents.groupBy("key", "block")).applyInArrow(step, columns)
        if t:
            paths = cut(paths)
    return paths


def manifest(docs: DataFrame, claimed: Column | None = None, fields: tuple[str, ...] = FIELDS, group: str = "lang", order: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf is the digest of ``fields``; leaves of one ``group`` ascend by ``order``, null first, equal ones by their digest.
    The proof is checked with ``claimed`` (a digest; the leaf itself by default): ``folded_root`` is what it gives, and
    ``verified`` whether that is the root.  Null values (ids and groups too) count as such, empty texts as texts of no
    bytes.  Repeated rows are leaves of their own.  An empty table gives no rows; other columns are ignored.
    """
    own = leaf([F.col(f) for f in fields])
    key = F.coalesce(F.concat(F.lit("="), F.col(group)), F.lit("-"))  # a null group stands before all others
    hashed = cut(docs.select(key.alias("key"), F.col(order).cast("long").alias("doc_id"), own.alias("digest"), (own if claimed is None else claimed).alias("claimed")))
    trees = build(ranked(hashed, "key", ["doc_id", "digest"]))
    tops = ranked(trees.subroots().select(F.lit("").alias("key"), F.col("key").alias("group"), "digest"), "key", ["group"])
    whole = build(tops)
    root = whole.subroots().select("key", F.lit("").alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    from_top = descend(whole, root).select("rank", "path", "root")
    above = cut(tops.select("rank", F.col("group").alias("key"), F.col("digest").alias("subroot")).join(from_top, "rank").select("key", "path", "subroot", "root"))
    return descend(trees, above, _proofs, _PROOFS).withColumn("verified", F.col("folded_root") == F.col("root"))


def tampered(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs``, its proofs checked with leaves of lower-cased text where 3 divides the id's checksum."""
    fields = [F.col(f) for f in FIELDS]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    other = leaf([*fields[:-1], lowered(fields[-1])])
    return manifest(docs, F.when(F.coalesce(hit, F.lit(False)), other).otherwise(leaf(fields)))
