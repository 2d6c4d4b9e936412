"""Approximate nearest neighbours by largest inner product, with a permutation index.

Every vector is represented by its ``PREFIX`` nearest pivots, in order, out of ``PIVOTS`` that are vectors of the table
themselves (a hash sample of that bounded size).  Vectors are dealt by a hash into blocks; a block posts each of its
vectors in the inverted files of its pivots, with the place that the pivot has in the vector's order.  A query reads the
files of its own nearest pivots, adds up the footrule distance to every vector of the block, and the share of ``RERANKED``
nearest ones is ranked anew by the inner product itself.  Every vector is in exactly one block and every query meets every
block, so no neighbour is lost but by its place in the footrule order.

"Nearest" for inner products: with a further component sqrt(M^2 - |x|^2), M the largest norm, and 0 for queries, the order
of distances is that of inner products.  Equal vectors are searched and found once, whatever the number of their rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from domloom.llm.common import cut, give_back

PIVOTS, PREFIX = 512, 64
#: Share of a block's vectors that is ranked by inner product, and how many of them at least.
RERANKED, LEAST = 0.2, 400
#: Components of a block of vectors (8 MB as doubles), and queries that meet a block in one task.
BLOCK, QUERIES = 1 << 20, 4096


def _matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of doubles, filled up with zeros."""
    out = np.zeros((len(vectors), width))
    lists = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _orders(vectors: np.ndarray, pivots: np.ndarray, lifted: np.ndarray | None) -> np.ndarray:
    """The nearest pivots of every vector, nearest first; ``lifted`` is the further component (none for queries)."""
    near = vectors @ pivots[:, :-1].T  # all lifted vectors are of one length, so the largest product is the nearest
    if lifted is not None:
        near += np.outer(lifted, pivots[:, -1])
    return np.argsort(-near, axis=1, kind="stable")[:, : min(PREFIX, len(pivots))]


class Postings:
    """Inverted files of a block: for each pivot the vectors that have it in their order, with its place there."""

    def __init__(self, orders: np.ndarray, pivots: int):
        self.rows, self.prefix = orders.shape
        flat = orders.ravel()
        by_pivot = np.argsort(flat, kind="stable")
        self.vector = (by_pivot // self.prefix).astype(np.int32)
        self.place = (by_pivot % self.prefix).astype(np.int32)
        self.edges = np.searchsorted(flat[by_pivot], np.arange(pivots + 1))

    def nearest(self, order: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` vectors of least footrule distance to an order.

        A pivot that one order lacks counts as in place ``prefix``.  Each pivot that both have, in places i and j, then
        brings the distance down by 2 * (prefix - max(i, j)) from what it is for orders without a common pivot.
        """
        if n >= self.rows:
            return np.arange(self.rows)
        slices = [slice(self.edges[p], self.edges[p + 1]) for p in order]
        gains = np.concatenate([self.prefix - np.maximum(self.place[s], i) for i, s in enumerate(slices)])
        gain = np.bincount(np.concatenate([self.vector[s] for s in slices]), gains, self.rows)
        return np.argpartition(-gain, n)[:n]


def _found(pivots: np.ndarray, largest: float, k: int, reranked: float, least: int):
    """(query's hashes, score, id) of the ``k`` + 1 best rows that a block holds for each query of the group."""

    def found(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if left.num_rows and right.num_rows:
            width = pivots.shape[1] - 1
            _, once = np.unique(np.stack([left["h1"].to_numpy(), left["h2"].to_numpy()], 1), axis=0, return_index=True)
            left = left.take(np.sort(once))  # a row that the table repeats
            vectors, members = _matrix(left["vector"], width), left["members"].to_pylist()
            lifted = np.sqrt(np.maximum(largest**2 - np.einsum("ij,ij->i", vectors, vectors), 0))
            postings = Postings(_orders(vectors, pivots, lifted), len(pivots))
            _, once = np.unique(np.stack([right["q1"].to_numpy(), right["q2"].to_numpy()], 1), axis=0, return_index=True)
            right = right.take(np.sort(once))
            asked = _matrix(right["asked"], width)
            n = max(least, int(np.ceil(reranked * len(vectors))))
            for h1, h2, vector, order in zip(right["q1"].to_pylist(), right["q2"].to_pylist(), asked, _orders(asked, pivots, None)):
                near = postings.nearest(order, n)
                scores = np.einsum("ij,j->i", vectors[near], vector)  # the same sum for equal vectors, wherever they stand
                if len(near) > k + 1:
                    best = scores >= np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]  # ties too
                    near, scores = near[best], scores[best]
                rows = sorted((-s, i) for s, v in zip(scores.tolist(), near.tolist()) for i in members[v])[: k + 1]
                out[0] += [h1] * len(rows)
                out[1] += [h2] * len(rows)
                out[2] += [-s for s, _ in rows]
                out[3] += [i for _, i in rows]
        give_back()
        return pa.table({name: pa.array(c, t) for name, c, t in zip(("h1", "h2", "score", "id"), out, (pa.int64(), pa.int64(), pa.float64(), pa.int64()))})

    return found


def nearest(table: DataFrame, k: int = 20, every: int = 20, reranked: float = RERANKED, least: int = LEAST, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """One row per query and neighbour found: query_id, rank, vec_id, score; queries are the ids that ``every`` divides.

    Candidates are all rows but those with the query's own id; the ``k`` best found come nearest first, ties by the smaller
    id, all of them if there are no more than ``k``.  ``score`` is the inner product in doubles.  Null ids, and vectors that
    are null, empty, all zero or hold a null or a non-finite component, take no part.  A shorter vector counts as filled up
    with zeros.  A row that stands in the table several times counts once.  An empty table gives no rows; other columns
    are ignored.  ``reranked`` = 1 ranks every row by its score: the exact answer.
    """
    rows = table.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("vector")).where("id IS NOT NULL AND size(vector) > 0")
    rows = rows.where("NOT exists(vector, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity')) AND exists(vector, x -> x <> 0)")
    rows = rows.withColumns({"h1": F.xxhash64("vector"), "h2": F.xxhash64(F.lit(1), "vector")})  # 128 bits stand for a vector
    narrow = cut(rows.groupBy("id", "h1", "h2").agg(F.max(F.size("vector")).alias("width"), F.expr("max(aggregate(vector, 0D, (s, x) -> s + double(x) * double(x)))").alias("norm")))
    # Equal vectors are one class; of its ids only the least k + 1 can be among the best k of any query.
    first = Window.partitionBy("h1", "h2").orderBy("id")
    classes = narrow.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1).groupBy("h1", "h2").agg(F.sort_array(F.collect_list("id")).alias("members"), F.max("width").alias("width"), F.max("norm").alias("norm"))
    classes = cut(classes)
    total = classes.agg(F.count("*").alias("n"), F.max("width").alias("width"), F.max("norm").alias("norm")).first()
    asked = narrow.where(F.col("id") % every == 0).select(F.col("id").alias("query_id"), "h1", "h2")
    n_asked = asked.select("h1", "h2").distinct().count()
    width = total.width or 1
    blocks = max(1, -(-total.n * width // BLOCK))
    parts = max(1, -(-n_asked // QUERIES))
    objects = rows.join(classes.select("h1", "h2", "members", F.col("members")[0].alias("id")), ["h1", "h2", "id"])
    objects = cut(objects.select("h1", "h2", "members", "vector"))
    sample = objects.select("h1", "h2", "vector").orderBy("h1", "h2").limit(2 * PIVOTS).dropDuplicates(["h1", "h2"]).orderBy("h1", "h2").limit(PIVOTS).toArrow()
    plain = _matrix(sample["vector"], width)
    largest = float(np.sqrt(total.norm or 0))
    pivots = np.concatenate([plain, np.sqrt(np.maximum(largest**2 - (plain**2).sum(1), 0))[:, None]], 1)
    block, part = F.pmod("h2", F.lit(blocks)).cast("int"), F.pmod(F.xxhash64("h2"), F.lit(parts)).cast("int")
    searched = objects.withColumns({"block": block, "part": F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))})
    asking = objects.select("h1", "h2", "vector").join(asked.select("h1", "h2").distinct(), ["h1", "h2"], "left_semi")
    asking = asking.withColumns({"block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))), "part": part}).toDF("q1", "q2", "asked", "of_block", "of_part")
    found = searched.groupBy("block", "part").cogroup(asking.groupBy("of_block", "of_part")).applyInArrow(_found(pivots, largest, k, reranked, least), "h1 long, h2 long, score double, id long")
    best = Window.partitionBy("h1", "h2").orderBy(F.desc("score"), "id")
    top = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    listed = top.groupBy("h1", "h2").agg(F.sort_array(F.collect_list(F.struct("n", "id", "score"))).alias("top"))  # k + 1 each
    others = F.slice(F.filter("top", lambda x: x["id"] != F.col("query_id")), 1, k)
    ranked = asked.join(listed, ["h1", "h2"]).select("query_id", F.posexplode(others).alias("at", "hit"))
    return ranked.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.id").alias("vec_id"), F.col("hit.score").alias("score"))
