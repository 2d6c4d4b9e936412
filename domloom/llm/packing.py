"""Variable-capacity best-fit packing: several permitted sequence lengths chosen jointly.

Documents longer than the longest sequence are cut into whole sequences and a rest.  Pieces are dealt by a
hash to groups of about ``GROUP`` pieces, each packed on its own in one task: longest first, each piece into the
fullest bin that holds it, else into a new bin.  Its length is chosen by filling one of each permitted length with the
pieces still to be placed and comparing the costs per token held; a plainer choice by the tokens left is tried too,
and the cheaper packing kept.  At the end each bin shrinks to the shortest permitted length that holds its contents.

Lengths are numbers of tokens, counted with the tokenizer; ``estimated_tokens`` is for callers without one.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from domloom.llm.common import cut
from domloom.llm.tokens import count_tokens

CAPACITIES = (512, 1024, 2048, 4096)
#: Cost of any bin besides its length, in tokens.
PER_BIN = 32
#: Pieces of a group, on average.
GROUP = 40_000


def _held(down: list[int], start: int, room: int) -> int:
    """Tokens that a bin of this room holds of the pieces from ``start`` on, filled longest first; ``down`` has negated, ascending lengths."""
    held, at = 0, start
    while room > held and at < len(down):
        at = bisect_left(down, held - room, at)
        if at < len(down):
            alike = bisect_right(down, down[at], at)
            held -= down[at] * min(alike - at, (held - room) // down[at])
            at = alike
    return held


def cost(capacities: list[int], per_bin: int = PER_BIN) -> int:
    return sum(capacities) + per_bin * len(capacities)


def joint_fit(lengths: list[int], capacities: tuple[int, ...] = CAPACITIES, per_bin: int = PER_BIN) -> tuple[list[int], list[int]]:
    """The cheaper packing: new bins sized against the pieces still to be placed, or by the tokens left alone."""
    ways = [best_fit(lengths, capacities, per_bin, against=against) for against in (True, False)]
    return min(ways, key=lambda way: cost(way[1], per_bin))


def best_fit(lengths: list[int], capacities: tuple[int, ...] = CAPACITIES, per_bin: int = PER_BIN, against: bool = False) -> tuple[list[int], list[int]]:
    """Bin number of every piece, and every bin's capacity; lengths are 1 to the largest capacity.

    A new bin's capacity goes by the tokens left, or with ``against`` by what it can hold of the very pieces left.
    """
    sizes = sorted(capacities)
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    left = sum(lengths)
    bins: list[int] = [0] * len(lengths)
    used: list[int] = []
    free: list[int] = []  # room left in open bins, sorted, with one bin list for each room
    by_room: dict[int, list[int]] = {}
    down = [-lengths[i] for i in order]
    for place, i in enumerate(order):
        length = lengths[i]
        at = bisect_left(free, length)
        if at < len(free):
            room = free[at]
            own = by_room[room]
            b = own.pop()
            if not own:
                del by_room[room]
                del free[at]
        else:
            b = len(used)
            used.append(0)
            # What follows is no longer than this piece; it fills the rest as far as it goes.
            fits = [c for c in sizes if c >= length]
            if against:
                held = {c: _held(down, place, c) for c in fits}
                room = min(fits, key=lambda c: ((sizes[bisect_left(sizes, held[c])] + per_bin) / held[c], c))
            else:
                room = min(fits, key=lambda c: ((c + per_bin) / min(c, left), c))
        room -= length
        left -= length
        used[b] += length
        bins[i] = b
        if room:
            if room not in by_room:
                by_room[room] = []
                free.insert(bisect_left(free, room), room)
            by_room[room].append(b)
    return bins, [sizes[bisect_left(sizes, u)] for u in used]


def estimated_tokens(text: Column) -> Column:
    """A token for every four UTF-8 bytes begun; null and empty texts have none."""
    return F.ceil(F.octet_length(F.coalesce(text, F.lit(""))) / 4).cast("long")


def pack_counted(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``pack`` by the texts' numbers of tokens, each counted once; ``path`` names the tokenizer file on every executor."""
    counts = cut(count_tokens(docs, path, id_column=id_column, text_column=text_column).select("doc_id", "n_tokens"))
    return pack(counts, F.col("n_tokens"))


def pack(docs: DataFrame, length: Column, capacities: tuple[int, ...] = CAPACITIES, group: int = GROUP, id_column: str = "doc_id") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, bin, offset, capacity, used.

    ``length`` is the document's number of tokens; documents of none (null or empty texts) need no room and
    give no row.  Pieces of one document cover it without gap or overlap.  A bin's name is its group and number.
    Repeated rows are packed each on its own; an empty table gives no rows; other columns are ignored.
    """
    top = max(capacities)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), length.cast("long").alias("n")).where("n > 0")
    pieces = rows.select("doc_id", "n", F.explode(F.sequence(F.lit(0).cast("long"), ((F.col("n") - 1) / top).cast("long"))).alias("piece")).select(
        "doc_id", "piece", (F.col("piece") * top).alias("start"), F.least(F.lit(top).cast("long"), F.col("n") - F.col("piece") * top).alias("length")
    )
    total = rows.agg(F.sum(((F.col("n") + top - 1) / top).cast("long"))).first()[0] or 0
    groups = max(1, -(-total // group))
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)))
    names = ["doc_id", "piece", "start", "length"]

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by([(n, "ascending") for n in names])
        lengths = table["length"].to_pylist()
        bins, sizes = joint_fit(lengths, capacities)
        filled, offset = [0] * len(sizes), []
        for b, n in zip(bins, lengths):
            offset.append(filled[b])
            filled[b] += n
        return pa.table({n: table[n] for n in names} | {
            "bin": pa.array([f"{g}-{b}" for g, b in zip(table["group"].to_pylist(), bins)], pa.string()), "offset": pa.array(offset, pa.int64()),
            "capacity": pa.array([sizes[b] for b in bins], pa.int32()), "used": pa.array([filled[b] for b in bins], pa.int64()),
        })

    return dealt.groupBy("group").applyInArrow(
        packed, "doc_id long, piece long, start long, length long, bin string, offset long, capacity int, used long"
    )
