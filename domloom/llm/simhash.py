"""SimHash: weighted term hashes vote on signed bits; permuted block tables find near fingerprints.

Terms are five-word shingles, weighted by how often they occur.  Every shingle has two 63-bit hashes; a bit of
the 126-bit fingerprint is the sign of the weighted votes.  Votes are counted in lanes: one long holds three
counters of 21 bits, so 42 sums in one hash aggregation, all in generated JVM code.  Texts with more shingles than a
lane can count are summed in parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LANE = 21
WORDS = 5
#: Shingles per part: below 2^21, so that no lane overflows.
PART = 1 << 20
BITS = 6 * LANE


def _shingle_hashes(text: Column) -> Column:
    """Hashes of the text's shingles; fewer words than five make one shingle, no words none."""
    words = F.filter(F.split(text, "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    few = F.when(F.size(words) == 0, F.array().cast("array<bigint>")).otherwise(F.array(F.xxhash64(F.array_join(words, " "))))

    def shingles(h):
        one = F.transform(
            F.sequence(F.lit(1), F.size(h) - (WORDS - 1)),
            lambda i: F.xxhash64(*[F.get(h, i + (k - 1)) for k in range(WORDS)]),
        )
        return one

    # The word hashes are computed once: a one-element array is transformed into its shingles.
    many = F.get(F.transform(F.array(hashes), shingles), F.lit(0))
    return F.when(F.size(words) < WORDS, few).otherwise(many)


def votes(rows: DataFrame, keys: list[str], text: Column) -> DataFrame:
    """Fingerprint (two longs ``low``, ``high`` of 63 bits) per distinct ``keys``; a text without words has zeros.

    ``rows`` may carry a partitioning by a subset of ``keys``; then nothing is shuffled.
    """
    exploded = rows.select(*keys, F.posexplode_outer(_shingle_hashes(text)).alias("pos", "h")).select(
        *keys, (F.coalesce(F.col("pos"), F.lit(0)) / PART).cast("int").alias("piece"), "h", F.when(F.col("h").isNotNull(), F.xxhash64("h", F.lit(1))).alias("g")
    )
    mask = 1 | (1 << LANE) | (1 << (2 * LANE))
    lanes = [
        F.sum(F.shiftrightunsigned(c, i).bitwiseAND(F.lit(mask))).alias(f"{c}{i}") for c in ("h", "g") for i in range(LANE)
    ]
    parts = exploded.groupBy(*keys, "piece").agg(F.count("h").alias("n"), *lanes)
    low_lane = F.lit((1 << LANE) - 1)
    sums = [
        F.sum(F.shiftrightunsigned(F.col(f"{c}{i}"), lane * LANE).bitwiseAND(low_lane)).alias(f"{c}{i + lane * LANE}")
        for c in ("h", "g") for lane in range(3) for i in range(LANE)
    ]
    whole = parts.groupBy(*keys).agg(F.sum("n").alias("n"), *sums)

    def bits(c):
        sum_ = F.lit(0).cast("long")
        for i in range(3 * LANE):
            sum_ = sum_.bitwiseOR(F.when(F.col(f"{c}{i}") * 2 > F.col("n"), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
        return sum_

    return whole.select(*keys, bits("h").alias("low"), bits("g").alias("high"))


def distance(a_low: Column, a_high: Column, b_low: Column, b_high: Column) -> Column:
    return F.bit_count(a_low.bitwiseXOR(b_low)) + F.bit_count(a_high.bitwiseXOR(b_high))


def hexed(low: Column, high: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(high), 16, "0"), F.lpad(F.hex(low), 16, "0")))


def neighbours(queries: DataFrame, prints: DataFrame, radius: int) -> DataFrame:
    """All (query, fingerprint) pairs within ``radius`` bits: columns q_low, q_high, low, high, distance.

    Both sides are tables of fingerprints (low, high) and are made distinct first, so copies cost nothing.  The
    126 bits fall into radius + 1 blocks; two fingerprints within the radius agree on one whole block, so
    equality of (block number, block value), one table per block, finds every pair; a pair found through several
    blocks is kept in the first.  AQE splits a block value that many fingerprints share.
    """
    blocks = radius + 1
    size = -(-2 * 63 // blocks)

    def block(low, high, i):
        value = []
        for word, base in ((low, 0), (high, 63)):
            start, stop = max(i * size, base), min((i + 1) * size, base + 63)
            if start < stop:
                value.append(F.shiftrightunsigned(word, start - base).bitwiseAND(F.lit((1 << (stop - start)) - 1).cast("long")))
        return F.xxhash64(F.lit(i), *value) if value else F.lit(i).cast("long")

    def keyed(df, low, high):
        distinct = df.where("low IS NOT NULL").select(F.col("low").alias(low), F.col("high").alias(high)).distinct()
        keys = F.array(*[block(F.col(low), F.col(high), i) for i in range(blocks)])
        return distinct.select(low, high, F.posexplode(keys).alias("table", "key"))

    pairs = keyed(queries, "q_low", "q_high").join(keyed(prints, "low", "high"), ["table", "key"])
    near = pairs.withColumn("distance", distance(F.col("q_low"), F.col("q_high"), F.col("low"), F.col("high"))).where(F.col("distance") <= radius)
    first = F.least(*[
        F.when(block(F.col("q_low"), F.col("q_high"), i) == block(F.col("low"), F.col("high"), i), F.lit(i)).otherwise(F.lit(blocks))
        for i in range(blocks)
    ]) if blocks > 1 else F.lit(0)
    return near.where(F.col("table") == first).select("q_low", "q_high", "low", "high", "distance")


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, low, high) per row of ``docs``; null text counts as empty, whose fingerprint is zero."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    texts = rows.select(F.sha2(F.encode("text", "UTF-8"), 256).alias("digest"), "text", "doc_id")
    prints = votes(texts.select("digest", "text").dropDuplicates(["digest"]), ["digest"], F.col("text"))
    return texts.select("doc_id", "digest").join(prints, "digest").drop("digest")


def _bucket(value: Column, bounds: list) -> Column:
    """How many of the sorted ``bounds`` lie at or below the value: a binary search in the row."""
    steps = 1
    while steps <= len(bounds):
        steps *= 2
    if not bounds:
        return F.lit(0)
    padded = F.array(*[F.lit(b).cast("long") for b in bounds])
    halves = F.array(*[F.lit(s) for s in (1 << k for k in range(steps.bit_length() - 2, -1, -1))])
    return F.aggregate(
        halves, F.lit(0),
        lambda low, s: F.when((low + s <= len(bounds)) & (F.get(padded, low + s - 1) <= value), low + s).otherwise(low),
    )


def edited_fingerprints(docs: DataFrame, buckets: int | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, whose second half is replaced by the next document's start.

    The next document comes in descending id order (after the last: the first); rows of one id follow each
    other by their text.  Texts move once, into ranges of ids; a range borrows the first row of the following one.
    Ranges come from approximate quantiles of the ids, whose number is ``buckets`` (default: four for each shuffle
    partition of the session).  Rows with a null id come last.  Null text counts as empty, and an edit of it is empty too.  One
    document alone is its own next.  An empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = -(1 << 63)
    rows = docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(least)).alias("id"),
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    cuts = rows.agg(F.percentile_approx("id", [i / buckets for i in range(1, buckets)], 100 * buckets).alias("p")).first().p if buckets > 1 else []
    bounds = sorted(set(cuts or []))
    placed = rows.withColumn("bucket", _bucket(F.col("id"), bounds))
    # The first row of each range in the order used, (id descending, text): one row per range.
    heads = placed.groupBy("bucket").agg(F.max("id").alias("id")).collect()
    present = sorted((h.bucket, h.id) for h in heads)
    lender = {}
    for i, (bucket, top) in enumerate(present):
        lender[top] = present[(i + 1) % len(present)][0]  # the range above needs this one's first row; the top range's goes to the lowest
    if not present:
        target = F.lit(None).cast("int")
    else:
        pairs = [x for top, to in lender.items() for x in (F.lit(top).cast("long"), F.lit(to))]
        target = F.try_element_at(F.create_map(*pairs), F.col("id"))
    lent = F.when(target.isNotNull(), F.array(F.struct(F.col("bucket").alias("b"), F.lit(0).alias("ghost")), F.struct(target.alias("b"), F.lit(1).alias("ghost")))).otherwise(
        F.array(F.struct(F.col("bucket").alias("b"), F.lit(0).alias("ghost")))
    )
    order = Window.partitionBy("range").orderBy("ghost", F.desc("id"), "text")
    dealt = placed.select("id", "doc_id", "text", F.explode(lent).alias("to")).select("id", "doc_id", "text", F.col("to.b").alias("range"), F.col("to.ghost").alias("ghost"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    numbered = dealt.repartition("range").withColumns({"row": F.row_number().over(order), "following": F.lead("text").over(order)})
    # Ghosts after the first serve nothing; that one stands right behind the range's own rows.
    paired = numbered.select(
        "range", "row", "ghost", "doc_id", n.cast("long").alias("n_chars"), "text",
        F.concat(F.substring("text", 1, n - half), F.substring(F.coalesce("following", F.lit("")), F.lit(1), half)).alias("edited"),
    )
    kept = paired.select("range", "row", "ghost", "doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("t")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("t")))).alias("v"))
    flat = kept.select("range", "row", "ghost", "doc_id", "n_chars", "edited_sha256", F.col("v.which").alias("which"), F.col("v.t").alias("t"))
    prints = votes(flat, ["range", "row", "ghost", "doc_id", "n_chars", "edited_sha256", "which"], F.col("t"))
    keys = ["range", "row", "ghost", "doc_id", "n_chars", "edited_sha256"]
    own = prints.groupBy(*keys).agg(
        *[F.max(F.when(F.col("which") == w, F.col(c))).alias(f"{c}{w}") for w in (0, 1) for c in ("low", "high")]
    )
    again = Window.partitionBy("range").orderBy("row")
    near = lambda a, b, c, d: (F.lit(1.0) - distance(F.col(a), F.col(b), F.col(c), F.col(d)) / F.lit(float(BITS)))
    return own.withColumns({"next_low": F.lead("low0").over(again), "next_high": F.lead("high0").over(again)}).where("ghost = 0").select(
        "doc_id", "n_chars", "edited_sha256", hexed(F.col("low0"), F.col("high0")).alias("fingerprint"), hexed(F.col("low1"), F.col("high1")).alias("edited_fingerprint"),
        near("low0", "high0", "low1", "high1").alias("near_edited"), near("low0", "high0", "next_low", "next_high").alias("near_next"),
    )
