"""Repeated passages: bytes covered by a ``LENGTH``-byte string that also starts in a document of a smaller id.

The suffix comparison is carried by a sample, as in difference-cover suffix sorting, from the coarse to the fine:

1. Whole texts are named first (SHA-256): a copy of an earlier text is covered whole and takes no further part.
2. A cover of the positions is sampled such that any two equal ``LENGTH``-byte strings contain a sampled position at the
   same offset: the least hash among the ``GRAM``-byte strings inside.  (A fixed residue cover has the same property but
   six samples in 31 positions where this one has one in 16.)  The samples are named, and a name that only one text has
   settles all suffixes that hang on it.
3. The suffixes that hang on a shared name are merged: all those with the same name meet, are cut to ``LENGTH`` bytes and
   compared; equal prefixes form one class whose least document keeps it.  Names shared by very many texts are compared
   through pre-aggregated prefixes instead, so that no task gathers them.

Names and prefixes are compared by 45 to 128 bit hashes; a name that collides only costs work.  Names travel as packed
arrays, one for each bucket and chunk of texts; a name that a chunk holds in several texts is entered once.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domloom.llm.common import cut, give_back, settled, step, text_bytes, tidy

LENGTH, GRAM = 50, 20
WINDOW = LENGTH - GRAM + 1
#: Bytes of text handled at once in a task, and bytes of text for each bucket of names.
CHUNK, BUCKET = 1 << 19, 8 << 20
#: Bytes of text whose stretches are packed together: with buckets of one size, a chunk alone has too few for each to compress well.
PACKED_CHUNK = 4 * CHUNK
#: A name is widely shared beyond so many texts, or beyond this share of all entries: at most 1/WIDE_SHARE such names.
WIDE, WIDE_SHARE = 5_000, 1e-5

_LOW = np.uint64((1 << 40) - 1)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_BYTE = np.random.default_rng(3).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _mix(x):
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    return x * np.uint64(0x81DADEF4BC2DD44D)


def _rolling(buffer: np.ndarray, k: int, base: int) -> np.ndarray:
    """Hash of every k-byte string of the buffer."""
    n = len(buffer)
    if n < k:
        return np.zeros(0, np.uint64)
    if base not in _powers or len(_powers[base][0]) < n:
        m = n + (1 << 16)
        _powers[base] = np.cumprod(np.full(m, base, np.uint64)), np.cumprod(np.full(m, pow(base, -1, 1 << 64), np.uint64))
    up, down = _powers[base]
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[buffer] * up[:n], out=total[1:])
    h = _mix((total[k:] - total[:-k]) * down[: n - k + 1])
    return h ^ (h >> np.uint64(33))


def _least(h: np.ndarray) -> np.ndarray:
    m = 1
    while 2 * m <= WINDOW:
        h = np.minimum(h[:-m], h[m:])
        m *= 2
    rest = WINDOW - m
    return np.minimum(h[: len(h) - rest], h[rest:]) if rest else h


def _names(texts: list[bytes], buckets: int):
    """(buffer, names, valid, owner): the name of every LENGTH-byte string's sample; not valid where texts meet."""
    buffer = np.frombuffer(b"".join(texts), np.uint8)
    n = len(buffer) - LENGTH + 1
    if n <= 0:
        return buffer, np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int32)
    h = _least(_rolling(buffer, GRAM, _BASES[0]))
    # The least of several hashes is small, so its own high bits would put a quarter of all samples into one of 64 buckets.
    names = ((h & _LOW) | (((((h * _SPREAD) >> np.uint64(40)) * np.uint64(buckets)) >> np.uint64(24)) << np.uint64(40))).view(np.int64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    valid = np.zeros(n, bool)
    np.equal(owner[:n], owner[LENGTH - 1 :], out=valid)
    return buffer, names, valid, owner[:n]


def _chunked(batches, size: int = CHUNK):
    """Rows of the batches as lists of about ``size`` bytes of text; the text is the last column."""
    rows, held = [], 0
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            for row in zip(*(c.to_pylist() for c in batch.slice(i, 256).columns)):
                rows.append(row)
                held += len(row[-1])
                if held >= size:
                    yield rows
                    rows, held = [], 0
    if rows:
        yield rows


def _parts(text: bytes) -> list[tuple[int, bytes]]:
    """The text in parts of bounded size, with their offsets; each string of LENGTH bytes starts in one of them."""
    return [(i, text[i : i + CHUNK + LENGTH - 1]) for i in range(0, max(1, len(text) - LENGTH + 1), CHUNK)]


def _regrouped(rows):
    """The chunk's texts as bytes, those of more than a chunk in parts of their own."""
    small = []
    for cls, text in rows:
        data = text.encode()
        if len(data) <= 4 * CHUNK:
            small.append((cls, data))
        else:
            yield from ([(cls, part)] for _, part in _parts(data))
    if small:
        yield small


def _enter(buckets: int):
    """Rows (bucket, entries, texts, many) of a chunk's names: 5 bytes of name and the number of its text; the texts' classes;
    and (class, name) pairs that the chunk itself shows to be shared."""

    def enter(batches):
        for rows in (group for chunk in _chunked(batches) for group in _regrouped(chunk)):
            classes = np.array([r[0] for r in rows], np.int64)
            _, names, valid, owner = _names([r[1] for r in rows], buckets)
            starts = np.flatnonzero(valid & np.concatenate([[True], (names[1:] != names[:-1]) | (owner[1:] != owner[:-1])]))
            distinct, index = np.unique(classes, return_inverse=True)
            name, text = names[starts], index[owner[starts]]
            order = np.lexsort((text, name))
            name, text = name[order], text[order]
            once = np.concatenate([[True], (name[1:] != name[:-1]) | (text[1:] != text[:-1])])
            name, text = name[once], text[once]
            first = np.concatenate([[True], name[1:] != name[:-1]]) if len(name) else np.zeros(0, bool)
            group = np.cumsum(first) - 1
            shared = np.bincount(group, minlength=1)[group] > 1 if len(name) else first
            pairs = np.stack([distinct[text[shared]], name[shared]], 1) if len(name) else np.zeros((0, 2), np.int64)
            name, text, shared = name[first], text[first], shared[first]
            text = np.where(shared, len(distinct), text)
            bucket = (name >> 40).astype(np.int64)
            edges = np.searchsorted(bucket, np.arange(buckets + 1))
            filled = np.flatnonzero(np.diff(edges))
            low = (name & int(_LOW)).view(np.uint64)
            packed = np.empty(len(name), [("n", "u4"), ("m", "u1"), ("t", "u4" if len(distinct) > 65_000 else "u2")])
            packed["n"], packed["m"], packed["t"] = low & np.uint64(0xFFFFFFFF), low >> np.uint64(32), text
            wide = packed.dtype["t"].itemsize == 4
            rows = []
            for b in filled:
                part = packed[edges[b] : edges[b + 1]]
                used, at = np.unique(part["t"], return_inverse=True)
                part = part.copy()
                part["t"] = at
                known = np.append(distinct, -1)[used]
                alone = used < len(distinct)
                rows.append((int(b), part.tobytes(), known.tobytes(), alone.tobytes(), wide))
            yield _batch(rows, _ENTERED)
            for i in range(0, len(pairs), 50_000):
                yield _batch([(int(filled[i // 50_000 % len(filled)]), b"", pairs[i : i + 50_000].tobytes(), b"", wide)], _ENTERED)

    return enter


_ENTERED = "bucket int, entries binary, classes binary, alone binary, wide boolean"
_PACKED = "bucket int, packed binary"
_KINDS = {"int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    """All of a chunk's rows in one batch: one for each bucket would cost more than what is in it."""
    names, kinds = zip(*(field.split() for field in schema.split(", ")))
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, k in zip(columns, kinds)], names=list(names))


def _shared(table: pa.Table) -> pa.Table:
    """(class, name) pairs of a bucket for names that several texts have."""
    names, classes, alone, done = [], [], [], [np.zeros((0, 2), np.int64)]
    for bucket, entries, known, single, wide in zip(*(table[c].to_pylist() for c in ("bucket", "entries", "classes", "alone", "wide"))):
        known = np.frombuffer(known, np.int64)
        if not entries:
            done.append(known.reshape(-1, 2))
            continue
        part = np.frombuffer(entries, [("n", "u4"), ("m", "u1"), ("t", "u4" if wide else "u2")])
        names.append((part["n"].astype(np.int64) | (part["m"].astype(np.int64) << 32)) | (bucket << 40))
        classes.append(known[part["t"]])
        alone.append(np.frombuffer(single, bool)[part["t"]])
    if names:
        name, cls, one = np.concatenate(names), np.concatenate(classes), np.concatenate(alone)
        order = np.argsort(name, kind="stable")
        name, cls, one = name[order], cls[order], one[order]
        first = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
        size = np.diff(np.append(first, len(name)))
        # A text read again in another chunk is no second text; a name entered for several texts is shared as it is.
        several = (np.minimum.reduceat(cls, first) != np.maximum.reduceat(cls, first)) | ~np.minimum.reduceat(one, first)
        keep = np.repeat(several, size) & one
        done.append(np.stack([cls[keep], name[keep]], 1))
        del names, classes, alone, name, cls, one, order
    pairs = np.concatenate(done)
    give_back()
    return pa.table({"class": pa.array(pairs[:, 0]), "name": pa.array(pairs[:, 1])})


def _runs(text: bytes, found: np.ndarray, buckets: int):
    """Stretches [a, b) of starts whose strings hang on one of the found names, with that name."""
    _, names, valid, _ = _names([text], buckets)
    hit = valid & np.isin(names, found)
    starts = np.flatnonzero(hit & np.concatenate([[True], ~hit[:-1] | (names[1:] != names[:-1])]))
    ends = np.flatnonzero(hit & np.concatenate([~hit[1:] | (names[1:] != names[:-1]), [True]])) + 1
    if len(starts) and (ends - starts).max() > WINDOW:  # equal neighbours, as in a long row of one letter
        longer = -(-(ends - starts) // WINDOW)
        begin = np.repeat(starts, longer)
        begin = begin + WINDOW * (np.arange(len(begin)) - np.repeat(np.cumsum(longer) - longer, longer))
        ends = np.minimum(begin + WINDOW, np.repeat(ends, longer))
        starts = begin
    return starts, ends, names[starts]


def _suffixes(buckets: int):
    """Rows (bucket, packed): the stretches of text that hang on shared names, packed by name bucket."""

    def suffixes(batches):
        for rows in _chunked(batches, PACKED_CHUNK):
            found_, start_, doc_, text_ = [], [], [], []
            for doc, names, text in rows:
                own = np.array(names, np.int64)
                for offset, data in _parts(text.encode()):
                    a, b, name = _runs(data, own, buckets)
                    found_.append(name)
                    start_.append(a + offset)
                    doc_.append(np.full(len(a), doc, np.int64))
                    text_ += [data[x : y + LENGTH - 1] for x, y in zip(a.tolist(), b.tolist())]
            name, start, doc = map(np.concatenate, (found_, start_, doc_))
            order = np.argsort(name, kind="stable")
            name, start, doc = name[order], start[order], doc[order]
            sizes = np.fromiter((len(text_[i]) for i in order), np.uint8, len(order))
            bucket = name >> 40
            edges = np.searchsorted(bucket, np.arange(buckets + 1))
            out = []
            for k in np.flatnonzero(np.diff(edges)):
                s = slice(edges[k], edges[k + 1])
                parts = [name[s].tobytes(), doc[s].tobytes(), start[s].tobytes(), sizes[s].tobytes(), b"".join(text_[i] for i in order[s])]
                packed = len(name[s]).to_bytes(8, "little") + b"".join(parts)
                out.append((int(k), zstandard.compress(packed, 3)))
            yield _batch(out, _PACKED)

    return suffixes


def _merged(table: pa.Table) -> pa.Table:
    """(doc_id, start, mask) of a bucket's stretches: bit i is set if the string at start + i is in an earlier document."""
    columns: list[list] = [[], [], [], [], []]
    for packed in table["packed"].to_pylist():
        data = zstandard.decompress(packed)
        n = int.from_bytes(data[:8], "little")
        at = 8
        for column, kind in zip(columns, (np.int64, np.int64, np.int64, np.uint8)):
            column.append(np.frombuffer(data, kind, n, at))
            at += n * np.dtype(kind).itemsize
        columns[4].append(data[at:])
    name, doc, start, sizes = map(np.concatenate, columns[:4])
    text = np.frombuffer(b"".join(columns[4]), np.uint8)
    sizes = sizes.astype(np.int64)
    begin = np.cumsum(sizes) - sizes
    order = np.argsort(name, kind="stable")
    name, doc, start, sizes, begin = name[order], doc[order], start[order], sizes[order], begin[order]
    masks = np.zeros(len(name), np.int64)
    fresh = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
    i = 0
    while i < len(name):  # whole names, some 4,000 stretches at once
        j = np.searchsorted(fresh, i + 4_000)
        stop = fresh[j] if j < len(fresh) else len(name)
        n = sizes[i:stop] - (LENGTH - 1)
        row = np.repeat(np.arange(stop - i), n)
        bit = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        part = np.repeat(np.arange(stop - i), sizes[i:stop])
        within = np.arange(len(part)) - np.repeat(np.cumsum(sizes[i:stop]) - sizes[i:stop], sizes[i:stop])
        joined = text[begin[i:stop][part] + within]
        at = (np.cumsum(sizes[i:stop]) - sizes[i:stop])[row] + bit
        keys = [_rolling(joined, LENGTH, b)[at] for b in _BASES]
        own = doc[i:stop][row]
        sort = np.lexsort((own, keys[1], keys[0]))
        a, b = keys[0][sort], keys[1][sort]
        first = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        least = own[sort][first][np.cumsum(first) - 1]
        later = sort[own[sort] > least]
        np.bitwise_or.at(masks, i + row[later], np.int64(1) << bit[later])
        i = stop
    hit = masks != 0
    give_back()
    return pa.table({"doc_id": pa.array(doc[hit]), "start": pa.array(start[hit]), "mask": pa.array(masks[hit])})


def _prefixes(buckets: int):
    """Rows (h1, h2, doc_id, start, mask) of the strings that hang on widely shared names.

    A string that the chunk has in an earlier document too is marked at once, in a mask of 32 starts (with doc_id and start
    for hashes); only the first document's go on as names (without a mask), so copies of a passage do not leave the task
    one by one."""

    def prefixes(batches):
        for rows in _chunked(batches):
            found: list[list] = [[], [], [], []]
            for doc, names, text in rows:
                own = np.array(names, np.int64)
                for offset, data in _parts(text.encode()):
                    a, b, _ = _runs(data, own, buckets)
                    at = np.repeat(a, b - a) + np.arange((b - a).sum()) - np.repeat(np.cumsum(b - a) - (b - a), b - a)
                    buffer = np.frombuffer(data, np.uint8)
                    for column, value in zip(found, (*(_rolling(buffer, LENGTH, base)[at].view(np.int64) for base in _BASES), np.full(len(at), doc, np.int64), at + offset)):
                        column.append(value)
            h1, h2, doc, start = map(np.concatenate, found)
            order = np.lexsort((start, doc, h2, h1))
            h1, h2, doc, start = h1[order], h2[order], doc[order], start[order]
            first = np.ones(len(h1), bool)
            first[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            again = doc > doc[first][np.cumsum(first) - 1] if len(doc) else first
            names = [x[~again] for x in (h1, h2, doc, start)]
            word, bit = start[again] // 32 * 32, start[again] % 32
            order = np.lexsort((word, doc[again]))
            own, word, mask = doc[again][order], word[order], np.int64(1) << bit[order]
            fresh = np.ones(len(own), bool)
            fresh[1:] = (own[1:] != own[:-1]) | (word[1:] != word[:-1])
            at = np.flatnonzero(fresh)
            masks = np.bitwise_or.reduceat(mask, at) if len(at) else mask
            columns = [np.concatenate(c) for c in zip(names, (own[at], word[at], own[at], word[at]))]
            mask = pa.array(np.concatenate([np.zeros(len(names[0]), np.int64), masks]), mask=np.arange(len(names[0]) + len(at)) < len(names[0]))
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), mask], names=["h1", "h2", "doc_id", "start", "mask"])

    return prefixes


def _words_of(marks: DataFrame) -> DataFrame:
    """The marks (doc_id, start, mask) as one mask for each 32 starts, added up in buffers of fixed size before any list."""
    at = "start - pmod(start, 32)"
    low, high = "shiftleft(mask, cast(pmod(start, 32) as int)) & 4294967295L", "shiftrightunsigned(shiftleft(mask, cast(pmod(start, 32) as int)), 32)"
    words = marks.selectExpr("doc_id", f"inline(array(struct({at} as start, {low} as mask), struct({at} + 32 as start, {high} as mask)))").where("mask <> 0")
    return words.groupBy("doc_id", "start").agg(F.bit_or("mask").alias("mask"))


def _hanging(text_of: DataFrame, buckets: int) -> DataFrame:
    """Marks of the strings that hang on names which few texts share: all stretches of a name meet in its bucket."""
    packed = text_of.select("doc_id", "names", "text").mapInArrow(tidy(_suffixes(buckets)), _PACKED)
    return _words_of(packed.groupBy("bucket").applyInArrow(_merged, "doc_id long, start long, mask long"))


def _widely_hanging(text_of: DataFrame, buckets: int) -> DataFrame:
    """Marks of the strings that hang on names which very many texts share: at most one row a string and chunk is moved."""
    strings = text_of.where(F.size("widely") > 0).select("doc_id", "widely", "text").mapInArrow(tidy(_prefixes(buckets)), "h1 long, h2 long, doc_id long, start long, mask long")
    least = strings.withColumn("least", F.expr("min(if(mask is null, doc_id, null)) over (partition by h1, h2)")).where("mask IS NOT NULL OR doc_id > least")
    return _words_of(least.select("doc_id", "start", F.coalesce("mask", F.lit(1)).cast("long").alias("mask")))


def covered(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, copies, marks): every row's id, size and digest; which rows copy an earlier text; and the marks
    (doc_id, digest, list of (start, mask)) of the others that lose bytes."""
    texts = docs.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    content = text_bytes(text_column)
    rows = cut(docs.select(F.col(id_column).cast("long").alias("doc_id"), F.octet_length(content).cast("long").alias("n_bytes"), F.sha2(content, 256).alias("digest"), F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))).alias("class")))
    first = rows.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("owner"), F.first("class").alias("class"), F.first("n_bytes").alias("n"))
    owners = cut(first)
    buckets = max(1, -(-(rows.agg(F.sum("n_bytes")).first()[0] or 0) // BUCKET))
    entered = docs.where(F.octet_length(text_column) >= LENGTH).where(F.col(id_column).isNotNull()).select(F.xxhash64(text_column).alias("class"), F.col(text_column).alias("text"))

    def named():
        pairs = cut(entered.mapInArrow(tidy(_enter(buckets)), _ENTERED).groupBy("bucket").applyInArrow(_shared, "class long, name long"))
        many = max(WIDE, int(pairs.count() * WIDE_SHARE))
        wide = pairs.groupBy("name").count().where(F.col("count") > many).select("name", F.lit(True).alias("wide"))  # at most 1 / WIDE_SHARE rows
        flagged = pairs.join(F.broadcast(cut(wide)), "name", "left")
        of_class = flagged.groupBy("class").agg(  # as many as a text has samples
            F.collect_list(F.when(F.col("wide").isNull(), F.col("name"))).alias("names"), F.collect_list(F.when(F.col("wide"), F.col("name"))).alias("widely")
        )
        return of_class.join(owners.where(F.col("n") >= LENGTH).select("class", F.col("owner").alias("doc_id"), "digest"), "class").select("doc_id", "digest", "names", "widely")

    asked = settled(docs.sparkSession, named)  # the pairs are deleted before the texts are moved
    # Three steps move the texts, one after another, so that workers, buffers and shuffle files of one are gone before the next.
    text_of = texts.join(asked, "doc_id").where(F.sha2(F.encode("text", "UTF-8"), 256) == F.col("digest"))
    found = step(_hanging(text_of, buckets))
    if not asked.where(F.size("widely") > 0).isEmpty():
        found = _words_of(found.unionByName(step(_widely_hanging(text_of, buckets))))
    listed = found.groupBy("doc_id").agg(F.collect_list(F.struct("start", "mask")).alias("marks"))  # one for 32 bytes of the text at most
    marks = listed.join(asked.select("doc_id", "digest"), "doc_id")
    copies = rows.join(owners.select("digest", "owner"), "digest", "left").select("doc_id", "digest", "n_bytes", (F.coalesce(F.col("owner") < F.col("doc_id"), F.lit(False)) & (F.col("n_bytes") >= LENGTH)).alias("copy"))
    return texts, copies, marks


def _flags(size: int, start: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Which bytes the marks cover."""
    row, bit = np.nonzero((mask[:, None] >> np.arange(32)) & 1)
    at = start[row] + bit
    change = np.bincount(at, minlength=size + 1) - np.bincount(at + LENGTH, minlength=size + 1)
    return np.cumsum(change[:-1]) > 0


def _slices(batches):
    """The batches in parts of few rows, each with a function that gives row i's marks as (starts, masks)."""
    for batch in batches:
        for k in range(0, batch.num_rows, 256):
            part = batch.slice(k, 256)
            lists = part.column("marks")
            stop = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
            start, mask = (x.to_numpy(zero_copy_only=False) for x in lists.flatten().flatten())
            yield part, lambda i, start=start, mask=mask, stop=stop: (start[stop[i - 1] if i else 0 : stop[i]], mask[stop[i - 1] if i else 0 : stop[i]])


def digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Null and empty texts have no bytes and lose none.  Rows with one id do not remove each other's bytes; rows with a
    null id neither lose bytes nor take any.  An empty table gives no rows; other columns are ignored.
    """
    texts, copies, marks = covered(docs, id_column, text_column)

    def removed(batches):
        for batch, marks_of in _slices(batches):
            out = []
            for i, (doc, digest, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "digest", "text")))):
                data = text.encode()
                gone = _flags(len(data), *marks_of(i))
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum())
                out.append((doc, digest, int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()))], names=["doc_id", "digest", "removed", "spans", "kept"])

    whole = texts.join(marks, "doc_id").where(F.sha2(F.encode("text", "UTF-8"), 256) == F.col("digest"))
    lost = whole.mapInArrow(tidy(removed), "doc_id long, digest string, removed long, spans long, kept string").dropDuplicates(["doc_id", "digest"])
    out = copies.join(lost, ["doc_id", "digest"], "left")
    return out.select(
        "doc_id", "n_bytes",
        F.when(F.col("copy"), F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copy"), F.lit(1)).otherwise(F.coalesce("spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(F.col("copy"), F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept", "digest")).alias("kept_sha256"),
    )


def cut_texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with the covered bytes taken out of the texts; all columns stay, ``n_chars`` follows the text.

    A character that loses some of its bytes goes whole.  Rows of whose text nothing but white space is left after a
    removal are dropped; all others stay, those with null ids, null or empty texts as they are.
    """

    def build():
        _, copies, marks = covered(docs, id_column, text_column)
        lost = copies.dropDuplicates(["doc_id", "digest"]).join(marks, ["doc_id", "digest"], "left").where("copy OR marks IS NOT NULL")
        return lost.select(F.col("doc_id").alias("lost_id"), F.col("digest").alias("lost_digest"), "copy", "marks")

    lost = settled(docs.sparkSession, build)
    rows = docs.select(F.struct("*").alias("row"), F.col(id_column).cast("long").alias("id"), F.sha2(text_bytes(text_column), 256).alias("digest"))
    joined = rows.join(lost, (F.col("id") == F.col("lost_id")) & (F.col("digest") == F.col("lost_digest")), "left").select("row", "copy", "marks")
    names = docs.columns

    def shorten(batches):
        for batch, marks_of in _slices(batches):
            fields = dict(zip(names, batch.column("row").flatten()))
            texts, keep = fields[text_column].to_pylist(), []
            for i, copy in enumerate(batch.column("copy").to_pylist()):
                start, mask = marks_of(i)
                if copy:
                    texts[i] = ""
                elif len(start):
                    data = texts[i].encode()
                    texts[i] = np.frombuffer(data, np.uint8)[~_flags(len(data), start, mask)].tobytes().decode(errors="ignore")
                keep.append(not (copy or len(start)) or bool(texts[i].strip()))
            fields[text_column] = pa.array(texts, fields[text_column].type)
            if "n_chars" in fields:
                fields["n_chars"] = pa.array([None if t is None else len(t) for t in texts], fields["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(fields.values()), names=names).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(tidy(shorten), docs.schema)
