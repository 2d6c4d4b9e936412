"""Every operator against plain versions on small inputs, with null, empty, long, repeated and clashing cases."""

import hashlib
import importlib.util
import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402

from domloom.llm import decontaminate, licenses, minhash, packing, repeats, sharding, simhash, tokens, toxicity, urls  # noqa: E402

SF = "/root/testdata/sf0.001"
CLASHING = "doc_id long, text string, digest string, marks string, row long, tree int, part int, bucket int, owner string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def plain(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def odd(spark):
    """Null id, null, empty, blank, short, repeated and long texts beside columns with names the operators use."""
    long = " ".join(f"w{i % 977}x{i % 613}" for i in range(30_000))
    texts = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "one two"), (6, long), (7, long), (None, long), (8, "é" * 120), (8, "é" * 120), (9, "a" * 300), (10, "a" * 200)]
    rows = [(i, t, "d", "m", 1, 2, 3, 4, "o") for i, t in texts]
    return spark.createDataFrame(rows, CLASHING), [(i, t) for i, t in texts]


def empty(spark):
    return spark.createDataFrame([], CLASHING)


# 1


def kept_digest(text, flags):
    return hashlib.sha256(bytes(x for x, gone in zip((text or "").encode(), flags) if not gone)).hexdigest()


def spans(flags):
    return sum(1 for k in range(len(flags)) if flags[k] and not (k and flags[k - 1]))


@pytest.mark.parametrize("wide", [5000, 2])
def test_repeats_are_those_of_every_string_compared(docs, plain, monkeypatch, wide):
    monkeypatch.setattr(repeats, "WIDE", wide)
    monkeypatch.setattr(repeats, "BUCKET", 60_000)
    flags = brute.repeats(plain)
    got = {tuple(r) for r in repeats.digests(docs).collect()}
    want = {(i, len((t or "").encode()), sum(flags[i]), spans(flags[i]), kept_digest(t, flags[i])) for i, t in plain}
    assert got == want
    assert sum(x[2] > 0 for x in want) > 50


def test_repeats_of_odd_rows(spark):
    df, rows = odd(spark)
    flags = brute.repeats([r for r in rows if r[0] is not None])
    got = sorted((r.doc_id or 0, r.n_removed, r.kept_sha256) for r in repeats.digests(df).collect())
    want = sorted((i or 0, sum(flags[i]) if i else 0, kept_digest(t, flags[i] if i else bytes(10**6))) for i, t in rows)
    assert got == want
    assert repeats.digests(empty(spark)).count() == 0


def test_cut_texts_keeps_columns_and_the_first_copy(spark):
    df, rows = odd(spark)
    out = repeats.cut_texts(df)
    assert out.columns == df.columns
    kept = sorted((r.doc_id or 0, r.text or "") for r in out.collect())
    texts = dict(rows)
    gone = {7, 10}
    assert kept == sorted((i or 0, t or "") for i, t in rows if i not in gone) and len(texts[6]) > 200_000


# 2


def plain_rule(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end]), rest[end:]
        path = path.split("?")[0].split("#")[0]
    fit = [(r, v) for r, v in urls.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.find("/"):])]
    return (host, path, *max(fit, key=lambda x: len(x[0]), default=(None, None)))


def test_url_rules_and_models(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    odd_urls = [None, "", "no scheme", "http://WWW.Example.COM/en/x", "http://example.com?x=/en/", "http://a.net/fr/#y", "x://y://z/", "http://com/", "http://é.net/es/ü", "http://q.org/" + "a" * 5000]
    more = spark.createDataFrame([(1000 + i, u) for i, u in enumerate(odd_urls)], "page_id long, url string")
    rows = pages.select("page_id", "url").unionByName(more)
    got = {r.page_id: r for r in urls.judge(rows).collect()}
    for r in rows.collect():
        host, path, rule, verdict = plain_rule(r.url)
        g = got[r.page_id]
        assert (g.host, g.path, g.rule) == (host, path, rule), r.url
        assert g.verdict == verdict if rule else g.verdict in ("allow", "block") and g.score is not None
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0
    assert [r.verdict for r in urls.judge(more.where("page_id = 1002")).collect()] == ["allow"]


def test_url_models_part_the_classes_they_learn(spark):
    good = [(i, f"http://h{i}.example.com/fr/{i}") for i in range(300)]
    bad = [(1000 + i, f"http://h{i}.example.net/es/{i}") for i in range(300)]
    new = [(5000 + i, f"http://n{i}.sample.com:80/fr/x{i}") for i in range(0)] + [(6000, "http://z.example.net:8/es/1"), (6001, "http://z.example.com:8/fr/1")]
    got = {r.page_id: r.verdict for r in urls.judge(spark.createDataFrame(good + bad + new, "page_id long, url string")).collect()}
    assert (got[6000], got[6001]) == ("block", "allow")


def test_cells_sum_to_probabilities():
    train = ["http://ab.org/x", "http://ba.org/y"] * 20
    pairs, alone, row, _ = urls._cells(train)
    model = [np.stack([np.bincount(x, minlength=urls.CELLS) for x in t]).astype(float) for t in (pairs, alone)]
    total = 0.0
    for c in range(256):
        p, a, r, s = urls._cells(["http://" + chr(c)] if c < 128 else ["http://\u00ff"])
        one = np.full(len(r), 1 / 256)
        for k in range(urls.ORDER + 1):
            one = (model[0][k][p[k]] + urls.MASS * one) / (np.maximum(model[1][k][a[k]], model[0][k][p[k]]) + urls.MASS)
        total += one[7] if c < 128 else 0
    assert 0.5 < total <= 1.05


@pytest.mark.parametrize("common", [None, 20])
def test_url_scores_are_those_of_exact_counts(spark, monkeypatch, common):
    monkeypatch.setattr(urls, "CELLS", 16)  # scores do not depend on any table's size
    if common:
        monkeypatch.setattr(urls, "COMMON", common)
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url").collect()
    rules = [("com/", "allow"), ("example.com/en/", "block"), ("net/es/", "block")]
    models = [({}, {}), ({}, {})]
    windows = lambda raw: [(b"\0" * 4 + raw)[i : i + 5] for i in range(len(raw))]
    got = {r.page_id: r for r in urls.judge(spark.createDataFrame(rows), rules).collect()}
    assert len(got) == len(rows)
    for url in {r.url for r in rows}:
        verdict = next(g.verdict for g in (got[r.page_id] for r in rows if r.url == url))
        if any(got[r.page_id].rule for r in rows if r.url == url) and zlib.crc32(url.encode()) % 5:
            pairs, contexts = models[verdict == "block"]
            for w in windows(url.encode()):
                for k in range(5):
                    pairs[w[4 - k :]] = pairs.get(w[4 - k :], 0) + 1
                    contexts[k, w[4 - k : 4]] = contexts.get((k, w[4 - k : 4]), 0) + 1
    checked = 0
    for r in rows:
        if got[r.page_id].rule is None:
            total = 0.0
            for w in windows(r.url.encode()):
                p = [1 / 256, 1 / 256]
                for k in range(5):
                    p = [(m[0].get(w[4 - k :], 0) + 4 * q) / (m[1].get((k, w[4 - k : 4]), 0) + 4) for m, q in zip(models, p)]
                total += np.log(p[0] / p[1])
            assert abs(got[r.page_id].score - total / len(r.url.encode())) < 1e-6
            checked += 1
    assert checked > 20


# 3


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    return path, Tokenizer.from_file(path)


def test_token_counts_equal_the_library(spark, docs):
    path, library = tokenizer()
    more = spark.createDataFrame([(10_000, None), (10_001, ""), (10_002, "a<|endoftext|> b"), (10_003, "日本 \u2028x\x1cy\x85 z"), (10_004, "it's  \n\n x " * 9), (10_005, "ab c " * 300_000), (None, "x")], "doc_id long, text string")
    rows = docs.select("doc_id", "text").unionByName(more)
    got = {r.doc_id: tuple(r) for r in tokens.count_tokens(rows, path).collect()}
    for r in rows.collect():
        t = r.text or ""
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert got[r.doc_id] == (r.doc_id, len(t.encode()), n, n > 1024)
    assert tokens.count_tokens(empty(spark), path).count() == 0


def test_every_character_splits_as_in_the_library():
    path, library = tokenizer()
    counter = tokens.Counter50k(path)
    for code in range(0x250):
        for text in (f"a{chr(code)}b", f"  {chr(code)}{chr(code)} 1", f"x {chr(code)}"):
            assert counter.count(text) == counter.encode(text), code


def test_long_texts_are_split_at_safe_places(monkeypatch):
    path, _ = tokenizer()
    monkeypatch.setattr(tokens, "PIECE", 7)
    draw = random.Random(3)
    for _ in range(200):
        text = "".join(draw.choice("ab1 .'\n\t ") for _ in range(60))
        counter = tokens.Counter50k(path)
        assert "".join(counter.pieces(text)) == text
        assert counter.count(text) == counter.encode(text)


# 4


def test_licences_in_other_spelling_are_known(spark):
    mit = licenses.KNOWN[4][1]
    rows = [(1, "RELEASED under the MIT Licence"), (2, "Copyright (c) 2020 Some One\n\n" + mit.replace("sublicense", "sub-license").upper()), (3, mit + " x"), (4, None), (5, ""), (6, "copyright 2001 x"), (7, "© 2020 A\nReleased under the MIT License."), (7, "Released under the MIT License.")]
    got = sorted((r.doc_id, r.license) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), licenses.known_digests(spark)).collect())
    assert [(i, x or "") for i, x in got] == [(1, "MIT"), (2, "MIT"), (3, ""), (4, ""), (5, ""), (6, ""), (7, "MIT"), (7, "MIT")]
    assert licenses.scan(empty(spark), licenses.known_digests(spark)).count() == 0


def test_known_licences_are_found_however_they_are_wrapped(spark):
    import textwrap

    rows, want = [], []
    for name, text in licenses.all_known():
        # The GNU texts hold notices of their own, which end with their lines.
        for width in (0,) if "GPL" in name and len(text) > 1000 else (0, *range(24, 100, 5)):
            body = "\n\n".join(textwrap.fill(" ".join(p.split()), width, break_long_words=False, break_on_hyphens=False) for p in text.split("\n\n")) if width else text
            for notice in ("", "Copyright (c) 2020 Some One\n\n", "# Copyright The Authors, 2019-2021\n© Others\n"):
                rows.append((len(rows), notice + body))
                want.append(name)
    # A word at the start of each line in turn, for one that has the holders' clauses.
    for name, text in licenses.KNOWN[4:] + licenses.LONGER:
        rows.append((len(rows), text.replace(" copyright", "\ncopyright").replace(" COPYRIGHT", "\nCOPYRIGHT")))
        want.append(name)
    got = {r.doc_id: r.license for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), licenses.known_digests(spark)).collect()}
    assert {(want[i], rows[i][1][:200]) for i in got if got[i] != want[i]} == set()
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0", "CC0-1.0", "ISC", "MIT"} <= set(want)


# 5


def test_packing_is_whole_and_bins_are_no_larger_than_needed(spark, docs):
    extra = spark.createDataFrame([(9000, "x" * 100_000), (9001, None), (9002, ""), (9003, "abc"), (9003, "abc")], "doc_id long, text string")
    rows = docs.select("doc_id", "text").unionByName(extra)
    out = packing.pack(rows, packing.estimated_tokens(F.col("text")), group=50).collect()
    need = {}
    for r in rows.collect():
        need[r.doc_id] = need.get(r.doc_id, 0) + -(-len((r.text or "").encode()) // 4)
    have, bins = {}, {}
    for r in out:
        have[r.doc_id] = have.get(r.doc_id, 0) + r.length
        bins.setdefault(r.bin, []).append(r)
    assert have == {d: n for d, n in need.items() if n}
    for own in bins.values():
        own.sort(key=lambda r: r.offset)
        at = 0
        for r in own:
            assert r.offset == at
            at += r.length
        assert own[0].used == at <= own[0].capacity
        assert all(c < at for c in packing.CAPACITIES if c < own[0].capacity)
    assert packing.pack(empty(spark), packing.estimated_tokens(F.col("text"))).count() == 0


def test_best_fit_against_a_plain_search():
    draw = random.Random(4)
    for _ in range(200):
        sizes = sorted(draw.sample(range(4, 40), 3))
        lengths = [draw.randint(1, sizes[-1]) for _ in range(draw.randint(1, 40))]
        got, caps = packing.best_fit(lengths, tuple(sizes), 3)
        rooms, filled, left, want = {}, {}, sum(lengths), {}
        for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
            fits = [b for b in rooms if rooms[b] >= lengths[i]]
            if fits:
                tight = min(rooms[b] for b in fits)
                options = {b for b in fits if rooms[b] == tight}
                b = got[i]
                assert b in options
            else:
                b = len(rooms)
                assert got[i] == b
                rooms[b] = min((c for c in sizes if c >= lengths[i]), key=lambda c: ((c + 3) / min(c, left), c))
            rooms[b] -= lengths[i]
            left -= lengths[i]
            filled[b] = filled.get(b, 0) + lengths[i]
            want[i] = b
        assert caps == [min(c for c in sizes if c >= filled[b]) for b in range(len(filled))]


def test_documents_are_packed_by_their_tokens(spark, docs):
    from domloom.llm import queries, stages

    _, library = tokenizer()
    want = {r.doc_id: len(library.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect()}
    for out in (queries.op5_best_fit_packing(spark, SF), stages.pack_sequences(spark, docs, SF)):
        have, filled = {}, {}
        for r in out.collect():
            have[r.doc_id] = have.get(r.doc_id, 0) + r.length
            filled[r.bin] = filled.get(r.bin, 0) + r.length
            assert r.used <= r.capacity
        assert have == {d: n for d, n in want.items() if n} and max(filled.values()) <= 4096


def test_permitted_lengths_compete():
    # Two pieces of 500 fill 1,000; three leave 200 of 1,700.
    bins, caps = packing.joint_fit([500] * 12, (1000, 1700), 32)
    assert caps == [1000] * 6 and sorted(bins) == [b for b in range(6) for _ in range(2)]
    draw = random.Random(12)
    for _ in range(200):
        sizes = tuple(sorted(draw.sample(range(4, 40), 3)))
        lengths = [draw.randint(1, sizes[-1]) for _ in range(draw.randint(1, 40))]
        bins, caps = packing.joint_fit(lengths, sizes, 3)
        filled = [sum(n for n, own in zip(lengths, bins) if own == b) for b in range(len(caps))]
        assert caps == [min(c for c in sizes if c >= n) for n in filled]
        assert packing.cost(caps, 3) <= packing.cost(packing.best_fit(lengths, sizes, 3)[1], 3)


# 6


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = {r.doc_id: r for r in toxicity.rate(docs, toxicity.fit(docs, labels)).collect()}
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for d, r in rows.items())
    train = [d for d in toxic if not rows[d].held_out]
    right = np.mean([rows[d].predicted == toxic[d] for d in train])
    assert right > 0.98
    held = [d for d in toxic if rows[d].held_out]
    order = sorted(held, key=lambda d: rows[d].score)
    ranks = {d: i for i, d in enumerate(order)}
    bad = [ranks[d] for d in held if toxic[d]]
    area = (sum(bad) - len(bad) * (len(bad) - 1) / 2) / (len(bad) * (len(held) - len(bad)))
    assert area > 0.93 and np.mean([rows[d].predicted for d in held if toxic[d]]) > 0.85


def test_features_of_a_text_do_not_depend_on_its_neighbours():
    texts = [b"ab cd, EF", b"", b"xyzzy", b"  ", "é ü".encode(), b"a"]
    rows, owner = toxicity.features(texts)
    for i, t in enumerate(texts):
        alone, _ = toxicity.features([t])
        assert sorted(rows[owner == i].tolist()) == sorted(alone.tolist()), t


def test_long_text_scores_like_its_parts(monkeypatch):
    model = np.random.default_rng(0).normal(size=toxicity.ROWS + 1).astype(np.float32)
    text = b" ".join(b"w%d" % (i % 97) for i in range(3000))
    whole = toxicity.score([text, b"", b"zz"], model)
    monkeypatch.setattr(toxicity, "CHUNK", 1000)
    assert np.allclose(whole, toxicity.score([text, b"", b"zz"], model))


def test_toxicity_without_two_classes_or_rows(spark):
    df, _ = odd(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.rate(df, toxicity.fit(df, none)).collect()} == {0}
    assert toxicity.rate(empty(spark), toxicity.fit(empty(spark), none)).count() == 0
    assert toxicity.keep_clean(df, toxicity.fit(df, none)).columns == df.columns


# 7


def test_shards_are_contiguous_and_equal(spark, docs, plain):
    copies = spark.createDataFrame([(5000 + i, "copy " * 40) for i in range(300)] + [(9000, None), (9001, ""), (None, "x")], "doc_id long, text string")
    rows = docs.select("doc_id", "text").unionByName(copies)
    out = sharding.byte_shards(rows, 40).collect()
    texts = {(r.doc_id if r.doc_id is not None else -1): (r.text or "").encode() for r in rows.collect()}
    key = lambda d: (zlib.crc32(texts[d]), hashlib.md5(texts[d]).hexdigest(), d)
    order = sorted(texts, key=key)
    total, start, want, slots = sum(len(t) + 16 for t in texts.values()), 0, {}, {}
    for d in order:
        size = len(texts[d]) + 16
        shard = min(39, (2 * start + size) * 40 // (2 * total))
        slots[shard] = slots.get(shard, -1) + 1
        want[d] = (size, zlib.crc32(texts[d]), shard, slots[shard])
        start += size
    got = {(r.doc_id if r.doc_id is not None else -1): (r["size"], r.text_crc32, r.shard, r.slot) for r in out}
    assert got == want and {r.law for r in out} == {"bytes"}
    assert sharding.byte_shards(empty(spark), 40).count() == 0


# 8


def plain_prints(spark, texts):
    """Fingerprints by counting the votes of every shingle's hashes one by one."""
    split = __import__("re").compile("[ \t\n\x0b\x0c\r]+")
    out = []
    for text in texts:
        words = [w for w in split.split(text) if w]
        whole = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string").select("i", F.xxhash64("w").alias("h"))
        if not words:
            hashes = []
        elif len(words) < 5:
            hashes = [spark.range(1).select(F.xxhash64(F.lit(" ".join(words)))).first()[0]]
        else:
            h = [r.h for r in whole.orderBy("i").collect()]
            five = [tuple(h[i : i + 5]) for i in range(len(h) - 4)]
            hashes = [r[0] for r in spark.createDataFrame([(i, *f) for i, f in enumerate(five)], "i int, a long, b long, c long, d long, e long").orderBy("i").select(F.xxhash64(*"abcde")).collect()]
        second = [r[0] for r in spark.createDataFrame([(h,) for h in hashes], "h long").select(F.xxhash64("h", F.lit(1))).collect()]
        low, high = (sum(1 << i for i in range(63) if 2 * sum((x >> i) & 1 for x in xs) > len(xs)) for xs in (hashes, second))
        out.append(f"{high:016x}{low:016x}")
    return out


def test_simhash_of_texts_and_edits(spark):
    draw = random.Random(6)
    texts = [" ".join(draw.choice("ab cd ef gh ijk lé".split()) for _ in range(draw.randint(0, 25))) for _ in range(8)] + [None, ""]
    df = spark.createDataFrame([(i * 3, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for buckets in (1, 4):
        got = {r.doc_id: r for r in simhash.edited_fingerprints(df, buckets).collect()}
        order = sorted(got, reverse=True)
        assert len(order) == len(texts)
        full = {i * 3: t or "" for i, t in enumerate(texts)}
        edited = {}
        for at, d in enumerate(order):
            other = full[order[(at + 1) % len(order)]]
            half = len(full[d]) // 2
            edited[d] = full[d][: len(full[d]) - half] + other[:half]
            assert got[d].n_chars == len(full[d])
            assert got[d].edited_sha256 == hashlib.sha256(edited[d].encode()).hexdigest(), (d, buckets)
        own, changed = (plain_prints(spark, [t[d] for d in order]) for t in (full, edited))
        assert [got[d].fingerprint for d in order] == own
        assert [got[d].edited_fingerprint for d in order] == changed
        bits = lambda a, b: 1 - (int(a, 16) ^ int(b, 16)).bit_count() / 126
        assert all(abs(got[d].near_edited - bits(a, b)) < 1e-12 for d, a, b in zip(order, own, changed))
        assert all(abs(got[d].near_next - bits(a, b)) < 1e-12 for d, a, b in zip(order, own, own[1:] + own[:1]))
    assert simhash.edited_fingerprints(empty(spark)).count() == 0


def test_simhash_neighbours_are_all_found(spark):
    draw = random.Random(8)
    prints = [(draw.getrandbits(63), draw.getrandbits(63)) for _ in range(40)]
    for low, high in prints[:20]:
        for _ in range(3):
            a, b = low, high
            for _ in range(draw.randint(0, 9)):
                bit = draw.randrange(126)
                a, b = (a ^ (1 << bit), b) if bit < 63 else (a, b ^ (1 << (bit - 63)))
            prints.append((a, b))
    df = spark.createDataFrame(prints + prints[:5], "low long, high long")
    got = [(r.q_low, r.q_high, r.low, r.high) for r in simhash.neighbours(df, df, 6).collect()]
    every = set(prints)
    want = {(*p, *q) for p in every for q in every if (p[0] ^ q[0]).bit_count() + (p[1] ^ q[1]).bit_count() <= 6}
    assert set(got) == want and len(got) == len(want)


# 9


def test_part_distance():
    draw = random.Random(2)
    for _ in range(200):
        a, b = ("".join(draw.choice("abc") for _ in range(draw.randint(0, 12))) for _ in range(2))
        assert decontaminate.part_distance(a, b) == brute.edit_in(a, b)


def test_leaks_against_every_pair(spark, docs):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").limit(12)
    rows = [(i, t) for i, t in docs.limit(40).select("doc_id", "text").collect()]
    draw, texts = random.Random(5), [decontaminate.normal(r.text) for r in items.collect()]
    for n in range(12):
        words = texts[n].split()
        words[draw.randrange(len(words))] = "changed"
        rows.append((1000 + n, " ".join(["Before, this"] + words + ["and after!"]).upper()))
    rows += [(2000, None), (2001, ""), (2002, "!!")]
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    want = set()
    for item in items.collect():
        own = decontaminate.normal(item.text)
        for d, t in rows:
            if d >= 1000 or own in decontaminate.normal(t):
                if brute.edit_in(own, decontaminate.normal(t or "")) <= int(decontaminate.EDITS * len(own)):
                    want.add((d, item.item_id))
    assert got == want and len(want) >= 12
    assert decontaminate.leaks(empty(spark), items).count() == 0
    assert decontaminate.leaks(docs, items.limit(0)).count() == 0


def edited(text, n, draw):
    """The text after n substitutions, deletions and insertions of single characters."""
    out = list(text)
    for _ in range(n):
        kind, at = draw.randrange(3), draw.randrange(len(out))
        if kind == 0:
            out[at] = draw.choice("abcdefghijklmnopqrstuvwxyz")
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, draw.choice("abcdefghijklmnopqrstuvwxyz"))
    return "".join(out)


@pytest.mark.parametrize("percent", [2, 4, 6, 8, 10])
def test_no_copy_edited_in_characters_is_missed(spark, percent):
    rows = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()]
    items, draw, found = decontaminate.Items(rows), random.Random(percent), 0
    for k, own in enumerate(items.texts):
        text = "words before " + edited(own, len(own) * percent // 100, draw) + " and after"
        distance = brute.edit_in(own, decontaminate.normal(text))
        want = distance if distance <= int(decontaminate.EDITS * len(own)) else None
        assert {i: d for _, i, d in items.leaks([b"other", text.encode()])}.get(k) == want
        found += want is not None
    assert found >= 0.9 * len(rows)


@pytest.mark.parametrize("edits", [0.0, 0.1, 0.3, 0.6])
def test_leaks_of_short_and_foreign_texts_against_every_pair(edits):
    draw = random.Random(9)
    letters = "ab é日"
    rows = [(k, "".join(draw.choice(letters) for _ in range(draw.randint(0, 40)))) for k in range(40)]
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 80))) for _ in range(40)] + [t for _, t in rows[:10]]
    items = decontaminate.Items(rows, edits)
    want = {}
    for k, own in enumerate(items.texts):
        for t, text in enumerate(texts):
            distance = brute.edit_in(own, decontaminate.normal(text))
            if own and distance <= int(edits * len(own)):
                want[t, k] = distance
    assert {(t, k): d for t, k, d in items.leaks([t.encode() for t in texts])} == want and want


# 10


@pytest.mark.parametrize("percent,region", [(85, 1000), (60, 3)])
def test_components_against_every_pair(docs, plain, percent, region):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_components(docs, percent, region=region).collect()}
    assert got == brute.near_components(plain, percent)


def test_components_of_odd_rows(spark):
    df, rows = odd(spark)
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in minhash.near_components(df, 85).collect())
    want = brute.near_components([r for r in rows if r[0]], 85)
    n_long = want[6][0]
    assert got == sorted([(i, *want[i], want[i][1] == i) for i, _ in rows if i] + [(0, n_long, 0, True)])
    assert minhash.near_components(empty(spark), 85).count() == 0
    assert minhash.keep_one(df).columns == df.columns


def test_chain_of_links_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 200), (150, 200)], "a long, b long")
    got = {r.node: r.component for r in minhash.components(edges).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, 100: 100, 200: 100, 150: 100}


# pipeline


def test_pipeline_stages(spark):
    import corpus_pipeline
    from domloom.llm import stages

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash_near_dedup", "suffix_array_dedup", "benchmark_decontamination", "best_fit_packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = stages.drop_near_copies(spark, docs, SF)
    want = {d for d, (_, c) in brute.near_components([(r.doc_id, r.text) for r in docs.collect()], 80).items() if d == c}
    assert {r.doc_id for r in kept.collect()} == want and kept.columns == docs.columns
    cut = stages.cut_repeats(spark, docs, SF)
    flags = brute.repeats([(r.doc_id, r.text) for r in docs.collect()])
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = {d: bytes(x for x, g in zip(t.encode(), flags[d]) if not g).decode(errors="ignore") for d, t in texts.items()}
    assert {r.doc_id: r.text for r in cut.collect()} == {d: t for d, t in want.items() if t.strip() or not any(flags[d])}
    clean = stages.drop_contaminated(spark, docs, SF)
    leaks = {r.doc_id for r in decontaminate.leaks(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert {r.doc_id for r in clean.collect()} == set(texts) - leaks
    out = corpus_pipeline.run(spark, SF)
    assert 0 < out.count() and "doc_id" in out.columns


def test_entry_lists_every_operator():
    spec = importlib.util.spec_from_file_location("entry", Path(__file__).parents[2] / "__spark_entry__.py")
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    names = [n.split("_")[0] for n in entry.queries()]
    assert all(f"op{n}" in names for n in range(1, 14)) and "pipeline" in entry.queries()
