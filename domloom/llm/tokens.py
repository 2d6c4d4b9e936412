"""Token counts of whole texts by a two-tier lookup of pre-tokens, without moving any text.

A bounded sample of documents gives the frequent pre-tokens and their token counts; that table is
broadcast (at most ``FREQUENT`` entries).  Each worker parts its texts at blanks that no pre-token spans, adds up the
table's counts and encodes what it lacks, keeping those counts in a bounded cache beside the table's.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries of the broadcast table and documents sampled for it.  They decide speed only, never a count.
FREQUENT = 65_536
SAMPLED = 2_000
#: Stretches, and pre-tokens, that a worker remembers.
CACHED = 500_000
#: Longer texts are split where a white space follows something else: no pre-token spans such a place.
PIECE = 1 << 20

_SPACE = " \t\n\r\x0b\x0c"


def _keep(cache: dict[str, int], key: str, size: int) -> int:
    """``size``, remembered; of a full cache the older half goes."""
    if len(cache) >= CACHED:
        for old in list(islice(cache, CACHED // 2)):
            del cache[old]
    cache[key] = size
    return size


def _ranks(vocabulary: dict[str, int]) -> dict[bytes, int]:
    """The vocabulary's tokens as bytes.  Byte-level BPE writes a byte as a character: printable ones of Latin-1 as they
    are, the others, in order, from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    byte = {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}
    return {bytes(byte[c] for c in token): i for token, i in vocabulary.items() if all(c in byte for c in token)}


class Counter50k:
    """Counts tokens as the tokenizer file's library does, special strings in texts included.

    ``encode`` is that library.  Stretches of characters whose classes are known are merged by rank instead, which is
    several times faster and gives the same tokens where tokens were numbered in the order of their merges."""

    def __init__(self, path: str, frequent: dict[str, int] | None = None):
        import json

        import regex
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        # Fixed value: the pre-token pattern of byte-level BPE.
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        model = spec["model"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        order = [model["vocab"][a + b] for a, b in pairs]
        self.by_rank = None
        if order == sorted(set(order)) and not model.get("ignore_merges"):
            special = {t["content"] for t in spec["added_tokens"]}
            ranks = _ranks({t: i for t, i in model["vocab"].items() if t not in special})
            self.by_rank = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        # Where the pattern's classes are known to be those of the tokenizer (tests compare every character).
        self.other = regex.compile("[^\t\n\r -\x7e\xa1-ɏ]")
        self.cut = regex.compile(r"(?<=[^\s])(?=[ \n])")
        self.cache: dict[str, int] = dict(frequent or {})

    def pieces(self, text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > PIECE:
            found = self.cut.search(text, start + PIECE)
            if found is None:
                break
            yield text[start : found.start()]
            start = found.start()
        yield text[start:]

    def encode(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _chunk(self, chunk: str) -> int:
        """Tokens of a stretch that stands between safe cuts."""
        if self.by_rank is None or self.other.search(chunk):
            return self.encode(chunk)
        return sum(len(self.by_rank.encode_ordinary(piece)) for piece in self.pieces(chunk))

    def _kept(self, chunk: str) -> int:
        size = self.cache.get(chunk)
        return _keep(self.cache, chunk, self._chunk(" " + chunk)) if size is None else size

    def count(self, text: str) -> int:
        """Tokens of a text.  It parts before each blank that follows something else than white space, where no
        pre-token spans, and the stretches between are looked up whole; those unknown go on to the pre-tokens' table."""
        if any(s in text for s in self.special):
            return self.encode(text)
        first, *parts = text.split(" ")
        held = [first]  # of a stretch that ends with white space so far
        total = 0
        if not first or not first[-1].isspace():
            total, held = self._chunk(first), []
        sizes = list(map(self.cache.get, parts))
        if not held and None not in sizes:
            return total + sum(sizes)
        for part, size in zip(parts, sizes):
            if held or size is None:
                if not part or part[-1].isspace():
                    held = held or [""]
                    held.append(part)
                    continue
                if held:
                    size, held = self._chunk(" ".join([*held, part])), []
                else:
                    size = self._kept(part)
            total += size
        return total + (self._chunk(" ".join(held)) if held else 0)


_of_worker: dict[str, Counter50k] = {}


def counter_of_worker(path: str, frequent: dict[str, int]) -> Counter50k:
    """The counter of this Python worker: later tasks find its cache filled."""
    if path not in _of_worker:
        _of_worker[path] = Counter50k(path, frequent)
    return _of_worker[path]


def frequent_pre_tokens(docs: DataFrame, path: str, text_column: str, sampled: int = SAMPLED, entries: int = FREQUENT) -> dict[str, int]:
    """Token counts of the commonest pre-tokens of about ``sampled`` documents spread over the table.

    A pre-token is keyed with what stands up to the next blank (a word with its comma), without the blank before it."""
    total = docs.count()
    if not total:
        return {}
    step = max(1, total // sampled)
    some = docs.select(text_column).where((F.rand(7) * step < 1) & F.col(text_column).isNotNull()).limit(2 * sampled)

    def commonest(batches):
        counter, seen = Counter50k(path), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(part for part in text.split(" ")[1:] if part and not part[-1].isspace())
        top = [p for p, _ in seen.most_common(entries)]
        yield pa.RecordBatch.from_pydict({"pre_token": pa.array(top, pa.string()), "n": pa.array([counter._kept(p) for p in top], pa.int32())})

    rows = some.repartition(1).mapInArrow(commonest, "pre_token string, n int").collect()  # at most `entries` rows
    return {r.pre_token: r.n for r in rows}


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit.

    Whole texts of any length; a null text counts as empty (0 tokens).  Repeated rows stay; an empty table
    gives no rows; other columns are ignored.  ``path`` names the tokenizer file on every executor.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent_pre_tokens(docs, path, text_column))

    def counted(batches):
        counter = counter_of_worker(path, shared.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(map(counter.count, texts), pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
