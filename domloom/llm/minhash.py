"""MinHash near-duplicates by an LSH forest: sorted signature orders, adaptive depth, exact confirmation.

Each of several trees orders the documents by ``DEPTH`` minimum hashes.  Documents with a common prefix are
neighbours in that order.  The first candidates tie every document to the least document of its longest and of
its shallowest shared prefix, which is linear in the group's size and joins groups of true copies at once.  Regions
that still hold several components are looked at again.  Only documents of different components matter there, so the
rows outside a region's largest component meet all its rows, in blocks; a region with too many rows outside takes a longer
prefix, and at full depth all of them meet.  Pairs whose whole signatures agree about enough are candidates.  Such
candidates are not written out: documents that chains of them tie together form a family, whose texts meet once, by the
same rule.  Every candidate is confirmed on the full sets.  The number of trees is such that full depth alone misses a
pair at the bound with a probability of at most ``MISSED``.
Texts with equal sets are one class and enter once.  Components come from the confirmed links by star contraction.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domloom.llm.common import settled, step, tidy

WORDS = 5
DEPTH, SHALLOW = 3, 2
#: Probability that no tree joins two texts alike exactly at the bound in a full prefix.
MISSED = 1e-6
#: Rows outside the largest component up to which a region is compared at a shallow depth.
REGION = 2_000
#: Weight of the rows that one block holds: signatures by number, texts by the size of their sets.
SIGNATURES, SHINGLES = 2_000, 1 << 18

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15
_draw = np.random.default_rng(11)
_A = _draw.integers(1, 1 << 63, 4096, dtype=np.uint64) | np.uint64(1)
_B = _draw.integers(0, 1 << 63, 4096, dtype=np.uint64)


def trees(percent: int) -> int:
    return max(1, int(np.ceil(np.log(MISSED) / np.log1p(-((min(percent, 99) / 100) ** DEPTH)))))


def _mix(x):
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's five-word shingles; fewer words make one, no words none."""
    if len(text) > 1 << 24:
        return _long_set(text)
    buffer = np.frombuffer(text.translate(_FOLD), np.uint8)
    gap = np.concatenate([[True], _SPACE[buffer], [True]])
    first = np.flatnonzero(gap[:-1] & ~gap[1:])
    last = np.flatnonzero(~gap[:-1] & gap[1:])
    if not len(first):
        return np.zeros(0, np.uint64)
    return np.unique(_shingles(_words(buffer, first, last)))


_powers: dict[str, np.ndarray] = {}


def _words(buffer, first, last):
    n = len(buffer) + 1
    if len(_powers.get("up", ())) < n:
        _powers["up"] = np.cumprod(np.full(2 * n, _BASE, np.uint64))
        _powers["down"] = np.cumprod(np.full(2 * n, pow(_BASE, -1, 1 << 64), np.uint64))
    up, down = _powers["up"], _powers["down"]
    total = np.zeros(n, np.uint64)
    np.cumsum(_mix(buffer.astype(np.uint64) + np.uint64(1)) * up[: n - 1], out=total[1:])
    return _mix((total[last] - total[first]) * down[first] + (last - first).astype(np.uint64))


def _shingles(words):
    k = min(WORDS, len(words))
    h = np.full(len(words) - k + 1, k, np.uint64)
    for i in range(k):
        h = _mix(h * np.uint64(0xD6E8FEB86659FD93) + words[i : i + len(h)])
    return h


def _long_set(text: bytes) -> np.ndarray:
    """The same for a very long text, its words hashed in parts that end at white space."""
    words, start = [], 0
    while start < len(text):
        end = min(len(text), start + (1 << 24))
        while end < len(text) and not _SPACE[text[end]]:
            end += 1
        buffer = np.frombuffer(text[start:end].translate(_FOLD), np.uint8)
        gap = np.concatenate([[True], _SPACE[buffer], [True]])
        first, last = np.flatnonzero(gap[:-1] & ~gap[1:]), np.flatnonzero(~gap[:-1] & gap[1:])
        if len(first):
            words.append(_words(buffer, first, last))
        start = end
    return np.unique(_shingles(np.concatenate(words))) if words else np.zeros(0, np.uint64)


def signature(hashes: np.ndarray, n: int) -> np.ndarray:
    """``n`` minimum hashes, 32 bits each."""
    least = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 4096):
        part = hashes[i : i + 4096, None] * _A[:n] + _B[:n]
        np.minimum(least, (part ^ (part >> np.uint64(32))).min(0), out=least)
    return (_mix(least) >> np.uint64(32)).astype(np.uint32)


def _sets(docs: DataFrame, id_column: str, text_column: str, values: int) -> DataFrame:
    """(doc_id, n, digest, sig): size, digest and signature of each document's set; digest null for an empty one."""

    def digests(batches):
        for batch in batches:
            n, digest, sig = [], [], []
            for text in batch.column("text").to_pylist():
                own = shingle_set((text or "").encode())
                n.append(len(own))
                digest.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
                sig.append(signature(own, values).tobytes() if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.binary())],
                names=["doc_id", "n", "digest", "sig"],
            )

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(tidy(digests), "doc_id long, n long, digest binary, sig binary")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the least node reachable.  Star contraction.

    Large stars tie a node's greater neighbours to its least one, small stars the lesser ones; both are grouped minima
    and joins, so a hub of any degree is pre-aggregated and split.  Each round is cut, its shuffle files are deleted, and
    the loop ends when only stars are left: a further round would change nothing.
    """
    current = step(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    while not _only_stars(current):
        current = step(_contracted(current))
    own = current.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(own).groupBy("node").agg(F.min("component").alias("component"))


def _contracted(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    return large.join(least, "a").select(F.explode(F.array(F.col("a"), F.col("b"))).alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _only_stars(edges: DataFrame) -> bool:
    """Whether every node of the distinct edges (a, b), b < a, has one lesser neighbour or is one, but not both."""
    ends = edges.select(F.inline(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up")), F.struct(F.col("b").alias("node"), F.lit(0).alias("up")))))
    return ends.groupBy("node").agg(F.sum("up").alias("n"), F.min("up").alias("least")).where("n > least").count() == 0


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are alike enough."""

    def confirm(batches):
        last, sets = None, {}
        for batch in batches:
            keep = []
            for a, b, ta, tb in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b"))):
                if b != last:
                    last, of_b = b, shingle_set(tb.encode())
                    sets["b"] = of_b
                of_a, of_b = shingle_set(ta.encode()), sets["b"]
                both = len(np.intersect1d(of_a, of_b, assume_unique=True))
                keep.append(100 * both >= percent * (len(of_a) + len(of_b) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with_a = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    both = with_a.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(tidy(confirm), "a long, b long")


def _alike(least: int):
    """(a, b) for every document of a region with a partner of another component and at least so many equal signature
    values: itself and the least document that a chain of such partners reaches.  As many rows as documents at most."""

    def chains(table: pa.Table) -> pa.Table:
        reps, comps, sigs, asks = _sides(table)
        sigs = np.frombuffer(b"".join(sigs), np.uint32).reshape(len(reps), -1)
        ids, node = np.unique(reps, return_inverse=True)
        label, met = ids.copy(), np.zeros(len(ids), bool)
        rest = np.flatnonzero(~asks)
        for i in np.flatnonzero(asks):
            near = rest[((sigs[rest] == sigs[i]).sum(1) >= least) & (comps[rest] != comps[i])]
            if len(near):
                at = np.append(node[near], node[i])
                met[at] = True
                own = np.unique(label[at])
                if len(own) > 1:
                    label[np.isin(label, own)] = own[0]
        return pa.table({"a": pa.array(ids[met], pa.int64()), "b": pa.array(label[met], pa.int64())})

    return chains


def _sides(table: pa.Table):
    return *(table[c].to_numpy() for c in ("rep", "component")), table["load"].to_pylist(), table["asks"].to_numpy()


def _linked(percent: int):
    """Links (a, b) of a block of asking documents with others, between different components, confirmed on the full sets.

    Components that a link has joined are one from then on, and nothing inside one is compared."""

    def links(table: pa.Table) -> pa.Table:
        reps, comps, texts, asks = _sides(table)
        ids, first, node = np.unique(reps, return_index=True, return_inverse=True)
        sets = [shingle_set(texts[k].encode()) for k in first]
        del texts
        size = np.fromiter(map(len, sets), np.int64, len(sets))
        begin = np.cumsum(size) - size
        known, flat = np.unique(np.concatenate(sets), return_inverse=True)
        mark = np.zeros(len(known), np.int64)
        root, a, b = comps[first], [], []
        answers = np.zeros(len(ids), bool)
        answers[node[~asks]] = True
        for i in np.unique(node[asks]):
            rest = np.flatnonzero(answers & (root != root[i]))
            while len(rest):
                some, rest = rest[:4096], rest[4096:]
                own, n = flat[begin[i] : begin[i] + size[i]], size[some]
                mark[own] = 1
                at = np.repeat(begin[some] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                both = np.add.reduceat(mark[flat[at]], np.cumsum(n) - n)
                mark[own] = 0
                for j in some[100 * both >= percent * (size[i] + n - both)]:
                    if root[i] != root[j]:
                        a.append(max(ids[i], ids[j]))
                        b.append(min(ids[i], ids[j]))
                        root[root == max(root[i], root[j])] = min(root[i], root[j])
                rest = rest[root[rest] != root[i]]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return links


def _regions(rows: DataFrame, key: str) -> DataFrame:
    """(key, n, weight, top, outside, outside_n) of the keys with several components: all, the largest component, the rest."""
    parts = rows.groupBy(key, "component").agg(F.sum("weight").alias("w"), F.count("*").alias("k"))
    whole = parts.groupBy(key).agg(F.count("*").alias("components"), F.max(F.struct("w", "component", "k")).alias("most"), F.sum("w").alias("weight"), F.sum("k").alias("n"))
    return whole.where("components > 1").select(
        F.col(key), "weight", F.col("most.component").alias("top"), (F.col("weight") - F.col("most.w")).alias("outside"), (F.col("n") - F.col("most.k")).alias("outside_n")
    )


def _dealt(rows: DataFrame, loads: DataFrame, regions: DataFrame, key: str, unit: int) -> DataFrame:
    """Rows (key, i, j, rep, component, load, asks): the rows outside a region's largest component ask, in blocks i of
    about ``unit`` weight, and all its rows answer, in blocks j; every asking row meets every answering one once."""
    asking, answering = F.ceil(F.col("outside") / unit).cast("int"), F.ceil(F.col("weight") / unit).cast("int")
    mine, other = F.pmod(F.xxhash64("rep"), asking).cast("int"), F.pmod(F.xxhash64("rep", F.lit(1)), answering).cast("int")

    def each(n, i, j, asks):
        return F.transform(F.sequence(F.lit(0), n - 1), lambda x: F.struct(i(x).alias("i"), j(x).alias("j"), F.lit(asks).alias("asks")))

    asked = F.when(F.col("component") != F.col("top"), each(answering, lambda x: mine, lambda x: x, True))
    places = F.concat(F.coalesce(asked, F.array().cast(PLACES)), each(asking, lambda x: x, lambda x: other, False))
    open_ = rows.drop("weight").join(regions, key).select(F.col(key).alias("key"), "rep", "component", places.alias("places"))
    return open_.join(loads, "rep").select("key", "rep", "component", "load", F.inline("places"))


PLACES = "array<struct<i: int, j: int, asks: boolean>>"


def near_components(docs: DataFrame, percent: int = 80, id_column: str = "doc_id", text_column: str = "text", region: int = REGION) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Two documents are linked when their sets' intersection is at least ``percent`` of their union; a component's id is
    its least doc_id.  A-Z are lower-cased, words part at ASCII white space.  Null, empty and blank texts have an
    empty set and are linked with nothing.  Rows that repeat a doc_id share its component; a null doc_id is linked
    with nothing, has a null component and is kept.  An empty table gives no rows; other columns are ignored.
    """
    n_trees = trees(percent)
    values, alike = n_trees * DEPTH, percent / 100
    base = step(_sets(docs, id_column, text_column, values))
    least = int(values * alike - 5 * (values * alike * (1 - alike)) ** 0.5)
    reps = step(
        base.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    )

    def prefix(depth):
        return F.xxhash64("tree", F.substring("order", 1, 4 * depth)).alias(f"p{depth}")

    orders = reps.select("rep", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))).alias("tree"), "sig").select(
        "rep", "tree", F.expr(f"substring(sig, 1 + tree * {4 * DEPTH}, {4 * DEPTH})").alias("order")
    ).select("rep", *[prefix(d) for d in range(SHALLOW, DEPTH + 1)])
    shared = orders.groupBy(f"p{SHALLOW}").agg(F.count("*").alias("members")).where("members > 1").drop("members")
    members = step(orders.join(shared, f"p{SHALLOW}"))
    tied = [
        members.join(members.groupBy(f"p{d}").agg(F.min("rep").alias("b")), f"p{d}").where("rep <> b").select(F.col("rep").alias("a"), "b")
        for d in (SHALLOW, DEPTH)
    ]

    def texts_of(ids):
        rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
        return rows.join(ids, "doc_id").dropDuplicates(["doc_id"])

    stars = step(reduce(DataFrame.unionByName, tied).distinct())
    links = step(_confirmed(stars, texts_of(stars.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()), percent))
    first = components(links)
    of_rep = reps.join(members.select("rep").distinct(), "rep").join(first.withColumnRenamed("node", "rep"), "rep", "left")
    named = step(of_rep.select("rep", F.coalesce("component", "rep").alias("component"), "n", F.col("sig").alias("load")))
    rest, more = members.join(named.select("rep", "component"), "rep").withColumn("weight", F.lit(1).cast("long")), []
    for depth in range(SHALLOW, DEPTH + 1):
        key = f"p{depth}"
        regions = step(_regions(rest, key))
        small = regions if depth == DEPTH else regions.where(F.col("outside_n") <= region)
        dealt = _dealt(rest, named.select("rep", "load"), small, key, SIGNATURES)
        more.append(dealt.groupBy("key", "i", "j").applyInArrow(_alike(least), "a long, b long"))
        if depth < DEPTH:
            large = regions.where(F.col("outside_n") > region)
            if large.isEmpty():
                break
            rest = rest.join(large.select(key), key, "left_semi")
    family = step(components(reduce(DataFrame.unionByName, more)).select(F.col("node").alias("rep"), F.col("component").alias("family")))
    told = family.join(named.select("rep", "component", F.col("n").alias("weight")), "rep")
    open_ = step(_regions(told, "family"))
    texts = texts_of(told.join(open_, "family", "left_semi").select(F.col("rep").alias("doc_id")))
    dealt = _dealt(told, texts.select(F.col("doc_id").alias("rep"), F.col("text").alias("load")), open_, "family", SHINGLES)
    found = dealt.groupBy("key", "i", "j").applyInArrow(_linked(percent), "a long, b long")
    final = components(links.unionByName(found))
    classes = reps.select("digest", "rep").join(final.withColumnRenamed("node", "rep"), "rep", "left").select("digest", F.coalesce("component", "rep").alias("c"))
    out = base.select("doc_id", "n", "digest").join(classes, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("c", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), (F.coalesce(component, F.lit(0)) == F.coalesce("doc_id", F.lit(0))).alias("kept"))


def keep_one(docs: DataFrame, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, that are the least of their component; rows with null ids stay."""


    def build():
        return near_components(docs, percent, id_column, text_column).where("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("kept_id")).distinct()

    kept = settled(docs.sparkSession, build)
    rows = docs.where(F.col(id_column).isNotNull())
    own = rows.join(kept, rows[id_column] == kept["kept_id"], "left_semi")
    return own.unionByName(docs.where(F.col(id_column).isNull()))
