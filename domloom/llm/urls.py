"""URL filter: host and path rules first, else the ratio of two character language models.

Two smoothed variable-order Markov models are counted from the URLs that the rules decide, one from
accepted and one from rejected URLs.  Contexts of 0 to ``ORDER`` characters back off by interpolation:
p_k = (n(context, char) + MASS * p_{k-1}) / (n(context) + MASS), so an unseen context leaves the shorter one's
estimate as it is.  A URL's score is the difference of the two log-likelihoods per character; the bound it
must reach is calibrated on a held-out part of the decided URLs.

Counts are exact and live in a Spark table of strings of ``ORDER`` + 1 bytes (shorter contexts are its groups), which
grows with the input.  What a character adds to a score follows from such a string, so the strings to be scored are
judged once each and joined with the URLs; at most ``COMMON`` of them, the commonest, are broadcast.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from domloom.llm.common import cut

ORDER = 4
#: Cells of ``_cells``, a hashed count of the same for a few URLs at a time; the models do not use it.
CELLS = 1 << 18
MASS = 4.0
#: Strings that are broadcast; contexts of up to two bytes are no more.
COMMON = 1 << 16
#: Parts of a nat in which scores are summed, so that the sum does not depend on the order.
PARTS = 10**9
#: Score histogram for the calibration: cells of equal width over [-SPAN, SPAN] nats per character.
BINS, SPAN = 2000, 4.0

RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s).*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s).*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits, as struct(rule, verdict), else null."""
    fitting = None
    for rule, verdict in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit(slash + rest))
        value = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        fitting = F.when(fits, value) if fitting is None else fitting.when(fits, value)
    return fitting


def _cells(urls: list[str]):
    """Cells of (context, char) and of the context alone, per order, for every character of every URL; and URL numbers."""
    raw = [u.encode() for u in urls]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    gap = ORDER  # zeros before each URL, so that contexts do not cross URLs
    place = np.cumsum(sizes + gap) - sizes
    buffer = np.zeros(int((sizes + gap).sum()), np.uint8)
    for b, p in zip(raw, place):
        buffer[p : p + len(b)] = np.frombuffer(b, np.uint8)
    row = np.repeat(np.arange(len(raw)), sizes)
    at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(place, sizes)
    context = np.full(len(at), 0x9E3779B97F4A7C15, np.uint64)
    pairs, alone = [], []
    char = buffer[at].astype(np.uint64)
    with np.errstate(over="ignore"):
        for k in range(ORDER + 1):
            if k:
                context = (context ^ (buffer[at - k].astype(np.uint64) + np.uint64(k << 8))) * np.uint64(0xD6E8FEB86659FD93)
                context ^= context >> np.uint64(32)
            both = (context ^ (char + np.uint64(1 << 20))) * np.uint64(0xCA5A826395121157)
            pairs.append(((both >> np.uint64(40)) % np.uint64(CELLS)).astype(np.int64))
            alone.append(((context >> np.uint64(13)) * np.uint64(0x9FB21C651E98DF25) >> np.uint64(40)).astype(np.int64) % CELLS)
    return pairs, alone, row, sizes


def _occurrences(urls: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and every byte of the URL with the ``ORDER`` bytes before it (zeros before the first)."""
    size = F.octet_length("url")
    raw = F.concat(F.lit(bytearray(ORDER)), F.encode("url", "UTF-8"))
    own = F.transform(F.sequence(F.lit(1), size), lambda i: F.substring(raw, i, F.lit(ORDER + 1)))
    return urls.where(size > 0).select(*keep, F.explode(own).alias("string"))


def _counts(decided: DataFrame) -> DataFrame:
    """Exact counts of the decided URLs' strings: string, accepted, rejected."""
    rejected = F.col("rejected").cast("long")
    return _occurrences(decided, "rejected").groupBy("string").agg(F.sum(1 - rejected).alias("n0"), F.sum(rejected).alias("n1"))


def _gains(strings: DataFrame, counts: DataFrame, totals: tuple[int, int]) -> DataFrame:
    """With each string, the difference of its last byte's two log-probabilities, in ``PARTS`` of a nat."""
    p = [F.lit(1 / 256), F.lit(1 / 256)]
    for k in range(ORDER + 1):
        found = [[], []]
        for name, length in (("pair", k + 1), ("context", k)):
            if not length:
                found[0].append(F.lit(totals[0]))
                found[1].append(F.lit(totals[1]))
                continue
            key = F.substring("string", ORDER + 1 - k, length)
            sums = counts.groupBy(key.alias("key")).agg(*(F.sum(n).alias(f"{name}{k}_{n}") for n in ("n0", "n1")))
            strings = strings.withColumn("key", key).join(F.broadcast(sums) if length <= 2 else sums, "key", "left").drop("key")
            for c in (0, 1):
                found[c].append(F.coalesce(F.col(f"{name}{k}_n{c}"), F.lit(0)))
        p = [(found[c][0] + MASS * p[c]) / (found[c][1] + MASS) for c in (0, 1)]
    return strings.select("string", "n", F.round((F.log(p[0]) - F.log(p[1])) * PARTS).cast("long").alias("gain"))


def _scored(urls: DataFrame, counts: DataFrame, totals: tuple[int, int], common: int | None = None) -> DataFrame:
    """The rows of ``urls`` (id, url, …), unique by id, with their scores."""
    each = _occurrences(urls, "id")
    gains = cut(_gains(each.groupBy("string").agg(F.count("*").alias("n")), counts, totals))
    top = gains.orderBy(F.desc("n"), "string").limit(COMMON if common is None else common)
    met = each.join(F.broadcast(top.select("string", F.col("gain").alias("known"))), "string", "left")
    rest = met.where("known IS NULL").select("id", "string").join(gains, "string").select("id", "gain")
    sums = met.where("known IS NOT NULL").select("id", F.col("known").alias("gain")).unionByName(rest).groupBy("id").agg(F.sum("gain").alias("gain"))
    score = F.coalesce(F.col("gain") / PARTS / F.octet_length("url"), F.lit(0.0))
    return urls.join(sums, "id", "left").withColumn("score", score).drop("gain")


def _bound(scored: DataFrame) -> float:
    """The score that best parts accepted from rejected held-out URLs (balanced accuracy; ties: the one nearest 0)."""
    clipped = F.greatest(F.least(F.col("score"), F.lit(SPAN)), F.lit(-SPAN))
    cell = F.least(((clipped + SPAN) / (2 * SPAN) * BINS).cast("int"), F.lit(BINS - 1))
    sums = np.zeros((2, BINS))
    for r in scored.groupBy("rejected", cell.alias("cell")).count().collect():  # at most 2 * BINS rows
        sums[int(r.rejected), r.cell] = r["count"]
    accepted, rejected = sums
    if not accepted.sum() or not rejected.sum():
        return 0.0
    kept = 1 - np.concatenate([[0], np.cumsum(accepted)]) / accepted.sum()
    thrown = np.concatenate([[0], np.cumsum(rejected)]) / rejected.sum()
    edges = np.linspace(-SPAN, SPAN, BINS + 1)
    gain = kept + thrown
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    return float(edges[best[np.argmin(np.abs(edges[best]))]])


def judge(pages: DataFrame, rules: list[tuple[str, str]] = RULES, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, score (null where a rule decides).

    A null URL or one without ``://`` has an empty host and path, and no rule fits it; its score is that of its
    characters, an empty one's 0.  A score of at least the calibrated bound allows.  With only one class among
    the decided URLs, or none, there is nothing to compare: the rest are allowed.  Repeated rows stay; each
    distinct URL counts once in the models, so that one URL's copies cannot tilt them.  An empty table gives no
    rows; other columns are ignored.
    """
    url = F.col("url")
    rows = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"))
    rows = rows.withColumns({"host": host_of(url), "path": path_of(url)})
    rows = rows.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules)).select(
        "page_id", "url", "host", "path", F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("decided")
    )
    held = F.pmod(F.crc32("url"), F.lit(5)) == 0
    rejected = (F.col("decided") == "block").alias("rejected")
    counts = cut(_counts(rows.where(F.col("rule").isNotNull() & ~held).select("url", rejected).distinct()))
    totals = tuple(int(n or 0) for n in counts.agg(F.sum("n0"), F.sum("n1")).first())
    open_ = rows.where("rule IS NULL AND url IS NOT NULL").select("url", F.lit(None).cast("boolean").alias("rejected"))
    tried = rows.where(F.col("rule").isNotNull() & held).select("url", rejected)
    urls = cut(open_.unionByName(tried).distinct().withColumn("id", F.monotonically_increasing_id()))
    scored = cut(_scored(urls, counts, totals))
    bound = float("-inf") if min(totals) == 0 else _bound(scored.where("rejected IS NOT NULL"))
    scores = scored.where("rejected IS NULL").select("url", F.col("score").alias("own"))
    score = F.when(F.col("rule").isNull(), F.coalesce("own", F.lit(0.0)))
    verdict = F.coalesce("decided", F.when(score >= bound, "allow").otherwise("block"))
    ruled = rows.where("rule IS NOT NULL OR url IS NULL").withColumn("own", F.lit(None).cast("double"))
    judged = ruled.unionByName(rows.where("rule IS NULL AND url IS NOT NULL").join(scores, "url").select(*ruled.columns))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), score.alias("score"))
