"""Periodic runs of words, by a dictionary of basic factors.

Many texts are laid end to end in one array of word numbers, and for 1, 2, 4, ... words every stretch of that many words
that stands in its document more than once gets a name: equal stretches of one document have equal names, and a stretch of
twice the length is named by the pair of its halves' names.  A stretch that stands once is dropped from all later levels,
so ordinary prose is done after a few.

Where a stretch of m words comes again inside a window of twice its length (at most m words on), the distance is proposed
as a period.  Such successors stand in arithmetic progressions: inside a run of smallest period q, with q <= m and
2 q + m words or more, every start has its successor exactly q words on, and the word before and the word after the run
break that.  So neighbouring starts with one distance make a chain, a chain is extended as far as the period goes, and
one run found at several levels, or under a multiple of its period, is kept once, with the least period.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domloom.llm.common import tidy

#: A run has so many words, and so many periods, at least.
LEAST, TIMES = 24, 3
#: Words handled at once (a longer text is handled alone), and bytes of a text that are split into words at once.
CHUNK, PIECE = 1 << 18, 1 << 20

_SPACE = re.compile(rb"[ \t-\r]")


def words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some PIECE bytes of it at a time; they part at ASCII white space, as ``bytes.split`` has it."""
    start = 0
    while len(text) - start > PIECE:
        space = _SPACE.search(text, start + PIECE)
        if space is None:
            break
        yield text[start : space.start()].split()
        start = space.end()
    yield text[start:].split()


def planted(numbers: np.ndarray, doc_id: int | None) -> np.ndarray:
    """The word numbers with the periodic tail that the documents' contract gives one id in ten; a null id has none."""
    n = len(numbers)
    h = 0 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return numbers
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([numbers[:a], numbers[a + np.arange(n - a) % p]])


def _named(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of equal keys, and which keys stand more than once."""
    _, names, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return names, counts[names] > 1


def _chains(at: np.ndarray, names: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first start, last start, distance) of neighbouring starts whose next occurrence is one distance of at most m on."""
    order = np.argsort(names, kind="stable")  # starts ascend within a name
    gap = np.diff(at[order])
    near = (names[order][1:] == names[order][:-1]) & (gap <= m)
    start, distance = at[order][:-1][near], gap[near]
    order = np.argsort(start)
    start, distance = start[order], distance[order]
    head = np.ones(len(start), bool)
    head[1:] = (start[1:] != start[:-1] + 1) | (distance[1:] != distance[:-1])
    tail = np.append(head[1:], True) if len(head) else head
    return start[head], start[tail], distance[head]


def _extend(numbers: np.ndarray, owner: np.ndarray, begin: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches [begin, end) made as long as words ``period`` apart in the document are the same."""

    def same(a, b):
        inside = (a >= 0) & (b < len(numbers))
        a, b = np.where(inside, a, 0), np.where(inside, b, 0)
        return inside & (owner[a] == owner[b]) & (numbers[a] == numbers[b])

    open_ = np.arange(len(begin))
    while len(open_ := open_[same(begin[open_] - 1, begin[open_] - 1 + period[open_])]):
        begin[open_] -= 1
    open_ = np.arange(len(end))
    while len(open_ := open_[same(end[open_] - period[open_], end[open_])]):
        end[open_] += 1
    return begin, end


def runs(numbers: np.ndarray, owner: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows (start, length, period), by start, then period, of all runs in documents laid end to end.

    ``owner`` numbers the document of each word, ascending.  A run keeps its smallest period and is as long as that
    period goes in its document; it has ``least`` words and ``times`` periods or more, three at least.
    """
    found = [np.zeros((0, 3), np.int64)]
    n, m = len(numbers), 1
    names, alive = _named(owner.astype(np.int64) * (numbers.max(initial=0) + 1) + numbers)
    at, names = np.flatnonzero(alive), names[alive]
    while len(at):
        if 2 * m > least // times or m >= least // times:  # shorter periods reach up to here in `least` words
            first, last, period = _chains(at, names, m)
            long = last - first + m + period >= np.maximum(least, times * period)
            begin, end = _extend(numbers, owner, first[long], last[long] + m + period[long], period[long])
            found.append(np.stack([begin, end - begin, period[long]], 1))
        where = np.full(n + m, -1, np.int64)
        where[at] = names
        both = where[at + m] >= 0
        both[both] = owner[at[both]] == owner[at[both] + m]
        at = at[both]
        names, alive = _named(where[at] * n + where[at + m])
        at, names = at[alive], names[alive]
        m *= 2
    rows = np.unique(np.concatenate(found), axis=0)  # by start, length, period
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
    rows = rows[fresh]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _best(rows: list[list[int]]) -> tuple:
    """(start, length, period, exponent in thousandths) of the run with the greatest length / period, four nulls for none."""
    if not rows:
        return None, None, None, None
    start, length, period = rows[0]
    for s, l, p in rows[1:]:  # later rows start later, or have a longer period
        if l * period > length * p:
            start, length, period = s, l, p
    return start, length, period, 1000 * length // period


def _joined_sha256(numbers: np.ndarray, known: list[bytes]) -> str:
    digest = hashlib.sha256()
    for i in range(0, len(numbers), PIECE):
        digest.update((b" " if i else b"") + b" ".join([known[k] for k in numbers[i : i + PIECE].tolist()]))
    return digest.hexdigest()


class _Chunk:
    """Texts of about CHUNK words as word numbers, and their rows of results."""

    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.ids: list = []
        self.texts: list[np.ndarray] = []
        self.words = 0

    def add(self, doc_id, text: str | None) -> None:
        number = self.number
        parts = [np.array([number.setdefault(w, len(number)) for w in part], np.int32) for part in words((text or "").encode())]
        self.ids.append(doc_id)
        self.texts.append(planted(np.concatenate(parts), doc_id))
        self.words += len(self.texts[-1])

    def results(self) -> pa.RecordBatch:
        sizes = np.array([len(t) for t in self.texts], np.int64)
        edges = np.concatenate([[0], np.cumsum(sizes)])
        numbers = np.concatenate(self.texts)
        found = runs(numbers, np.repeat(np.arange(len(sizes), dtype=np.int32), sizes))
        bounds = np.searchsorted(found[:, 0], edges)
        known = list(self.number)
        out = []
        for i, doc_id in enumerate(self.ids):
            own = found[bounds[i] : bounds[i + 1]] - [edges[i], 0, 0]
            kept = self.texts[i]
            if len(own):
                change = np.zeros(sizes[i] + 1, np.int64)
                np.add.at(change, own[:, 0] + own[:, 2], 1)
                np.add.at(change, own[:, 0] + own[:, 1], -1)
                kept = kept[np.cumsum(change[:-1]) == 0]
            rows = own.tolist()
            listed = "".join(f"{s},{l},{p}\n" for s, l, p in rows)
            out.append((doc_id, len(rows), *_best(rows), hashlib.sha256(listed.encode()).hexdigest(), _joined_sha256(kept, known)))
        types = [pa.int64()] * 6 + [pa.string()] * 2
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=_NAMES)


_NAMES = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
_SCHEMA = ", ".join(f"{n} {'string' if n.endswith('sha256') else 'long'}" for n in _NAMES)


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256.

    The row's best run is the one of the greatest length / period; the digests cover all its runs, and its words without
    those that only repeat a period.  Null, empty and blank texts have no words and no runs; a null doc_id stays null and
    gets no periodic tail.  Repeated rows stay; an empty table gives no rows; other columns are ignored.  Nothing is
    shuffled; a text longer than a chunk is handled alone, with a few numbers for each of its words.
    """

    def searched(batches):
        chunk = _Chunk()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                if chunk.words and chunk.words + len(text or "") // 2 > 2 * CHUNK:
                    yield chunk.results()
                    chunk = _Chunk()
                chunk.add(doc_id, text)
                if chunk.words >= CHUNK:
                    yield chunk.results()
                    chunk = _Chunk()
        if chunk.ids:
            yield chunk.results()

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(tidy(searched), _SCHEMA)
