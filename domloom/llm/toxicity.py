"""Toxicity: averaged subword embeddings and a linear softmax, trained together in numpy.

A text is the bag of its words and of each word's character n-grams (bytes, with marks at both ends), all
hashed to rows of one embedding table; the mean of the rows goes through a linear softmax of two classes.
A misspelt word shares most n-grams with the right one.  After training the table and the softmax collapse
into one number per row, so a score is a mean of table look-ups.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domloom.llm.common import give_back, tidy

ROWS = 1 << 17
DIMENSIONS = 8
GRAMS = (3, 4, 5)
#: Bound of the training sample: labelled rows.
SAMPLE = 6_000
#: Examples seen in training, over as many passes as the sample needs; AdaGrad's rate.
SEEN, RATE = 60_000, 0.5
#: Bytes of a chunk of text handled at once; chunks end between words.
CHUNK = 1 << 18


def _hash(h, c):
    return (h ^ c) * np.uint64(0x100000001B3)


# Bytes that end a word: white space and ASCII punctuation; A-Z fold to a-z.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BREAK = np.zeros(256, bool)
_BREAK[:48] = _BREAK[58:65] = _BREAK[91:97] = _BREAK[123:128] = True


def features(texts: list[bytes]):
    """(rows, owner): table rows of every word and n-gram, and the text each belongs to."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    buffer = _FOLD[np.frombuffer(b" " + b" ".join(texts) + b" " * 6, np.uint8)]
    begin = 1 + np.cumsum(sizes + 1) - (sizes + 1)
    owner = np.zeros(len(buffer), np.int32)
    owner[begin[1:] if len(begin) > 1 else begin[:0]] = 1
    owner = np.cumsum(owner, dtype=np.int32)
    stop = _BREAK[buffer]
    buffer = np.where(stop, np.uint8(32), buffer)
    rows, owners = [], []
    n = len(buffer) - 6
    c = buffer.astype(np.uint64)
    gaps = np.cumsum(stop, dtype=np.int64)
    with np.errstate(over="ignore"):
        h = np.full(n, 0xCBF29CE484222325, np.uint64)
        for k in range(1, max(GRAMS) + 1):
            h = _hash(h, c[k - 1 : k - 1 + n])
            if k in GRAMS:
                # A gram may open or close with the mark of a word's end but has none inside.
                inside = gaps[k - 2 : k - 2 + n] == gaps[:n] if k > 2 else np.ones(n, bool)
                whole = inside & ~(stop[:n] & stop[1 : n + 1])
                mixed = h ^ (h >> np.uint64(29))
                at = np.flatnonzero(whole)
                rows.append(((mixed[at] * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(47)).astype(np.int32))
                owners.append(np.where(stop[at], owner[np.minimum(at + 1, len(owner) - 1)], owner[at]))
        first = np.flatnonzero(~stop[1 : n + 1] & stop[:n]) + 1
        last = np.flatnonzero(stop[1 : n + 1] & ~stop[:n]) + 1
        power = np.cumprod(np.full(n + 7, 0x9E3779B97F4A7C15, np.uint64))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(c * power[: len(c)], dtype=np.uint64)])
        m = min(len(first), len(last))
        first, last = first[:m], last[:m]
        inverse = np.cumprod(np.full(n + 7, pow(0x9E3779B97F4A7C15, -1, 1 << 64), np.uint64))
        word = (total[last] - total[first]) * inverse[first]
        word ^= word >> np.uint64(31)
        rows.append(((word * np.uint64(0x94D049BB133111EB)) >> np.uint64(47)).astype(np.int32))
        owners.append(owner[first])
    return np.concatenate(rows), np.concatenate(owners)


def chunks(text: bytes):
    """The text in parts of about CHUNK bytes that end between words (a longer word is parted)."""
    while len(text) > CHUNK:
        end = text.rfind(b" ", 1, CHUNK)
        end = end if end > 0 else CHUNK
        yield text[:end]
        text = text[end:]
    yield text


def train(texts: list[bytes], labels: np.ndarray, seed: int = 5) -> np.ndarray:
    """Embedding table and softmax by AdaGrad on mini-batches; returned collapsed: one number per row, the bias last."""
    draw = np.random.default_rng(seed)
    table = (draw.random((ROWS, DIMENSIONS), np.float32) - 0.5) / DIMENSIONS
    weights = np.zeros((DIMENSIONS, 2), np.float32)
    weights[:, 1] = draw.random(DIMENSIONS, np.float32) - 0.5
    bias = np.zeros(2, np.float32)
    g_table, g_weights, g_bias = np.full(ROWS, 1e-6, np.float32), np.full_like(weights, 1e-6), np.full(2, 1e-6, np.float32)
    bags = []
    for t in texts:
        found = np.concatenate([features([p])[0] for p in chunks(t)])
        own, times = np.unique(found, return_counts=True)
        bags.append((own, times.astype(np.float32)))
    for _ in range(-(-SEEN // len(bags))):
        order = draw.permutation(len(bags))
        for i in range(0, len(order), 32):
            some = [j for j in order[i : i + 32] if len(bags[j][0])]
            if not some:
                continue
            ids = np.concatenate([bags[j][0] for j in some])
            share = np.concatenate([bags[j][1] / bags[j][1].sum() for j in some]).astype(np.float32)
            lengths = np.array([len(bags[j][0]) for j in some])
            starts = np.cumsum(lengths) - lengths
            hidden = np.add.reduceat(table[ids] * share[:, None], starts, axis=0) * 16
            logits = hidden @ weights + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(some)), labels[some]] -= 1
            p /= len(some)
            back = (p @ weights.T) * 16
            grad_w, grad_b = hidden.T @ p, p.sum(0)
            own, where = np.unique(ids, return_inverse=True)
            grad = np.empty((len(own), DIMENSIONS), np.float32)
            spread = np.repeat(back, lengths, axis=0) * share[:, None]
            for d in range(DIMENSIONS):
                grad[:, d] = np.bincount(where, spread[:, d], len(own))
            g_table[own] += (grad**2).mean(1)
            table[own] -= RATE * grad / np.sqrt(g_table[own])[:, None]
            g_weights += grad_w**2
            g_bias += grad_b**2
            weights -= RATE * 0.2 * grad_w / np.sqrt(g_weights)
            bias -= RATE * 0.2 * grad_b / np.sqrt(g_bias)
    collapsed = table @ (weights[:, 1] - weights[:, 0]) * 16
    return np.append(collapsed, bias[1] - bias[0]).astype(np.float32)


def score(texts: list[bytes], model: np.ndarray) -> np.ndarray:
    """Scores 0 to 1; a text without words has the model's prior."""
    n = len(texts)
    total, count = np.zeros(n), np.zeros(n)
    group: list[bytes] = []
    names: list[int] = []

    def flush():
        if group:
            rows, owner = features(group)
            own = np.array(names)[owner]
            np.add(total, np.bincount(own, model[rows], n), out=total)
            np.add(count, np.bincount(own, minlength=n), out=count)
            group.clear()
            names.clear()

    held = 0
    for i, text in enumerate(texts):
        for part in chunks(text):
            group.append(part)
            names.append(i)
            held += len(part)
            if held > CHUNK:
                flush()
                held = 0
    flush()
    return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + model[-1], -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_column: str = "doc_id", text_column: str = "text"):
    """The model, from at most ``sample`` labelled rows outside the held-out fold, chosen by a hash of the id.

    Null labels and ids are no examples.  Several labels of one id count as toxic if one does.  Without
    examples of both classes the score is the share of the toxic ones, or 0 without any example.
    """
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(~held_out(F.col("doc_id")))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    text = docs.where(F.col(id_column).isNotNull()).select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    examples = text.join(F.broadcast(chosen), "doc_id").limit(2 * sample).repartition(1).sortWithinPartitions("doc_id", "text")

    def learn(batches):
        texts, marks = [], []
        for batch in batches:
            texts += [t.encode() for t in batch.column("text").to_pylist()]
            marks += batch.column("toxic").to_pylist()
        marks = np.array(marks, dtype=int)
        if len(set(marks.tolist())) < 2:
            share = marks.mean() if len(marks) else 0.0
            model = np.zeros(ROWS + 1, np.float32)
            model[-1] = 30 if share == 1 else -30
        else:
            model = train(texts, marks)
            texts.clear()
            give_back()
        yield pa.RecordBatch.from_pydict({"model": pa.array([model.tobytes()], pa.binary())})

    learnt = examples.mapInArrow(learn, "model binary").collect()
    return np.frombuffer(learnt[0].model, np.float32) if learnt else np.append(np.zeros(ROWS, np.float32), np.float32(-30))


def held_out(doc_id):
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2


def keep_clean(docs: DataFrame, model: np.ndarray, text_column: str = "text", bound: float = 0.3) -> DataFrame:
    """The rows of ``docs`` with all their columns whose score is below the bound; null texts are kept if the prior is."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def clean(batches):
        for batch in batches:
            scores = score([(t or "").encode() for t in batch.column(text_column).to_pylist()], shared.value)
            yield batch.filter(pa.array(scores < bound))

    return docs.mapInArrow(tidy(clean), docs.schema)


def rate(docs: DataFrame, model: np.ndarray, id_column: str = "doc_id", text_column: str = "text", bound: float = 0.3) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (1 if score >= bound).

    Null and empty texts, and texts without words, have the model's prior as score.  A null id is not held
    out.  Repeated rows stay; an empty table gives no rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        for batch in batches:
            scores = score([(t or "").encode() for t in batch.column("text").to_pylist()], shared.value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(tidy(scored), "doc_id long, score double").select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= bound).cast("int").alias("predicted"),
    )
