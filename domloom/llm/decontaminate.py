"""Benchmark decontamination: passages of documents within an edit distance of a benchmark item.

An item of n characters may differ from a passage by d = ``edits`` x n character edits.  It is cut into k > d pieces of
equal length that do not overlap; an edit touches one piece at most, so k - d of them or more stand in the passage as
they are, each moved by d characters at most.  Candidates are the places of a document where so many pieces of one item
are found in one band of 2 d diagonals: no pair within the distance is missed, whatever the edits.  Candidates are
confirmed by the exact edit distance in characters, so the distance given is the least one in the document.

Texts are compared in lower case (A-Z), punctuation and white space as one space between words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domloom.llm.minhash import _FOLD, _mix

#: Greatest edit distance, as a share of the item's characters.
EDITS = 0.1
#: Characters of a piece; shorter items and wider distances take shorter ones, so that there are more pieces than edits.
PIECE = 8
#: Cells of the table that tells most of a text's strings from all pieces at a look.
CELLS = 1 << 20
#: Bytes of documents handled at once, and bytes of items held at once in each worker.
CHUNK, ITEM_BLOCK = 1 << 19, 64 << 20

_BREAK = np.zeros(256, bool)
_BREAK[:48] = _BREAK[58:65] = _BREAK[91:97] = _BREAK[123:128] = True


def _normal(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the texts in normal form, one space between texts as well, and where each text's own begin and end."""
    data = b"\n".join(texts)
    buffer = np.frombuffer(data.translate(_FOLD), np.uint8)
    gap = _BREAK[buffer]
    kept = ~gap
    kept[1:] |= gap[1:] & ~gap[:-1]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.cumsum(sizes + 1) - (sizes + 1)
    out = np.where(gap, np.uint8(32), buffer)
    first = kept & ((buffer & 0xC0) != 0x80)
    begin = np.append(0, np.cumsum(first))[begin]
    points = np.frombuffer(out[kept].tobytes().decode().encode("utf-32-le"), np.uint32)
    end = np.append(begin[1:], len(points))
    own = np.flatnonzero(end > begin)
    end[own] -= points[end[own] - 1] == 32
    return points, begin, end


def normal(text: str) -> str:
    points, _, end = _normal([text.encode()])
    return _string(points[: end[0]])


def _string(points: np.ndarray) -> str:
    return points.tobytes().decode("utf-32-le")


def part_distance(item: str, text: str) -> int:
    """Least edit distance of the item to any part of the text, by bit-parallel columns of arbitrary length."""
    n = len(item)
    if not n:
        return 0
    all_ = (1 << n) - 1
    where: dict[str, int] = {}
    for i, c in enumerate(item):
        where[c] = where.get(c, 0) | (1 << i)
    up, down, score, best, top = all_, 0, n, n, 1 << (n - 1)
    for c in text:
        eq = where.get(c, 0)
        x = eq | down
        d = (((eq & up) + up) ^ up) | eq
        hp = down | (all_ & ~(d | up))
        hn = up & d
        score += bool(hp & top) - bool(hn & top)
        hp = (hp << 1) & all_
        hn = (hn << 1) & all_
        up = hn | (all_ & ~(x | hp))
        down = hp & x
        best = min(best, score)
    return best


def _strings(points: np.ndarray, lengths: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """For each of the ascending lengths, a hash of the string of that length that starts at each point."""
    mixed = _mix(points.astype(np.uint64) + np.uint64(1))
    total, done, power = np.zeros(len(points), np.uint64), 0, 1
    for length in lengths:
        while done < length:
            total = total[: max(0, len(points) - done)]
            total = total + mixed[done : done + len(total)] * np.uint64(power)
            done, power = done + 1, power * 0x9E3779B97F4A7C15 % (1 << 64)
        yield length, total


class Items:
    """The items of one block and the table of their pieces, by length."""

    def __init__(self, rows: list[tuple], edits: float = EDITS):
        if not 0 <= edits < 1:
            raise ValueError("edits is a share of the item's characters, from 0 to less than 1")
        self.ids = [r[0] for r in rows]
        self.texts = [normal(r[1] or "") for r in rows]
        self.size = np.fromiter(map(len, self.texts), np.int64, len(rows))
        self.allowed = np.array([int(edits * len(t)) for t in self.texts], np.int64)
        found: dict[int, list[tuple[int, int, int]]] = {}
        self.enough = np.ones(len(rows), np.int64)
        for k, (text, n, d) in enumerate(zip(self.texts, self.size.tolist(), self.allowed.tolist())):
            if not n:
                continue
            length = min(PIECE, n // (d + 1))
            pieces = n // length
            self.enough[k] = pieces - d
            hashes = next(_strings(np.frombuffer(text.encode("utf-32-le"), np.uint32), [length]))[1]
            found.setdefault(length, []).extend((int(hashes[o]), k, o) for o in (j * n // pieces for j in range(pieces)))
        self.tables = {}
        for length in sorted(found):
            own = sorted(found[length])
            hashes = np.array([x[0] for x in own], np.uint64)
            seen = np.zeros(CELLS, bool)
            seen[(hashes >> np.uint64(44)).astype(np.int64)] = True
            self.tables[length] = seen, hashes, np.array([x[1] for x in own], np.int64), np.array([x[2] for x in own], np.int64)

    def _places(self, points: np.ndarray, begin: np.ndarray, end: np.ndarray):
        """Text, item, least and greatest start of the regions of the texts with enough pieces of an item in one band."""
        parts = []
        for length, hashes in _strings(points, list(self.tables)):
            seen, known, item, offset = self.tables[length]
            at = np.flatnonzero(seen[(hashes >> np.uint64(44)).astype(np.int64)])
            left = np.searchsorted(known, hashes[at], "left")
            many = np.searchsorted(known, hashes[at], "right") - left
            which = np.repeat(left, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            place = np.repeat(at, many)
            text = np.searchsorted(begin, place, "right") - 1
            whole = place + length <= end[text]
            parts.append((text[whole], item[which][whole], (place - offset[which])[whole]))
        text, item, diagonal = (np.concatenate([p[i] for p in parts]) for i in range(3))
        order = np.lexsort((diagonal, item, text))
        text, item, diagonal = text[order], item[order], diagonal[order]
        last = np.arange(len(order)) + self.enough[item] - 1
        ok = last < len(order)
        first, last = np.flatnonzero(ok), last[ok]
        d = self.allowed[item[first]]
        ok = (text[first] == text[last]) & (item[first] == item[last]) & (diagonal[last] - diagonal[first] <= 2 * d)
        first, last, d = first[ok], last[ok], d[ok]
        # The passage starts within d of each of its pieces' diagonals.
        return text[first], item[first], diagonal[last] - d, diagonal[first] + d

    def _regions(self, points: np.ndarray, begin: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """Text, item, begin and end of the regions that hold the places; those of a text and item that overlap are one."""
        text, item, least, most = self._places(points, begin, end)
        least = np.maximum(least, begin[text])
        most = np.minimum(most + self.size[item] + self.allowed[item], end[text])
        held = None
        for t, i, a, b in zip(*(x.tolist() for x in (text, item, least, most))):
            if held is not None and held[:2] == (t, i) and a <= held[3] and held[2] <= b:
                held = t, i, min(a, held[2]), max(b, held[3])
                continue
            if held is not None:
                yield held
            held = t, i, a, b
        if held is not None:
            yield held

    def _alike(self, i: int, part: str) -> bool:
        """Whether the part has as many of the item's short strings as the distance leaves: an edit spoils ``length`` at most."""
        n, d = int(self.size[i]), int(self.allowed[i])
        length = max(1, min(PIECE, n // (d + 1)) // 2 + 1)
        if n < length * (d + 1):
            return True
        there = {part[j : j + length] for j in range(len(part))}
        own = self.texts[i]
        return sum(own[j : j + length] in there for j in range(n - length + 1)) >= n + 1 - length * (d + 1)

    def leaks(self, texts: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(text number, item number, least distance found) of every confirmed pair."""
        if not self.tables or not texts:
            return
        points, begin, end = _normal(texts)
        best: dict[tuple[int, int], int] = {}
        for t, i, a, b in self._regions(points, begin, end):
            part = _string(points[a:b])
            if best.get((t, i)) == 0 or not self._alike(i, part):
                continue
            distance = 0 if self.texts[i] in part else part_distance(self.texts[i], part)
            if distance <= self.allowed[i]:
                best[t, i] = min(distance, best.get((t, i), distance))
        yield from ((t, i, d) for (t, i), d in best.items())


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple]]:
    """The items in blocks of bounded size."""
    rows = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text").distinct()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // ITEM_BLOCK)
    for b in range(blocks):
        yield [tuple(r) for r in rows.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()]


def _groups(texts: list[bytes]):
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= CHUNK:
            yield start, texts[start : i + 1]
            start, held = i + 1, 0
    if start < len(texts):
        yield start, texts[start:]


def leaks(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", edits: float = EDITS) -> DataFrame:
    """One row per (document, item) with a passage within the distance: doc_id, item_id, distance.

    Null and empty texts and items leak nothing; items without words neither.  Repeated items count once; repeated
    documents give a row each.  Empty tables give no rows; other columns are ignored.
    """
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).where("text IS NOT NULL")
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    out = None
    for block in _blocks(benchmark):
        items = context.broadcast(Items(block, edits))

        def find(batches, items=items):
            for batch in batches:
                ids, texts = batch.column("doc_id").to_pylist(), [t.encode() for t in batch.column("text").to_pylist()]
                found = [(ids[s + t], items.value.ids[i], d) for s, group in _groups(texts) for t, i, d in items.value.leaks(group)]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=["doc_id", "item_id", "distance"])

        one = rows.mapInArrow(find, f"doc_id long, item_id {item_type}, distance long")
        out = one if out is None else out.unionByName(one)
    return out if out is not None else rows.select("doc_id", F.lit(None).cast(item_type).alias("item_id"), F.lit(0).cast("long").alias("distance")).where("false")


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", edits: float = EDITS) -> DataFrame:
    """The rows of ``docs``, with all columns, that hold no passage of any item; null texts are kept."""
    context = docs.sparkSession.sparkContext
    for block in _blocks(benchmark):
        items = context.broadcast(Items(block, edits))

        def clean(batches, items=items):
            for batch in batches:
                texts = [(t or "").encode() for t in batch.column(text_column).to_pylist()]
                bad = {s + t for s, group in _groups(texts) for t, _, _ in items.value.leaks(group)}
                yield batch.filter(pa.array([i not in bad for i in range(len(texts))], pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
