"""Operators 11 to 13 against plain versions on small inputs, with null, empty, long, repeated and clashing cases."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest

from domloom.llm import merkle, periodic, permutation
from domloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# 11


def plain_runs(words, least=24, times=3):
    """Every maximal stretch with a period, by comparing all words at every distance; the least period of each."""
    best = {}
    for p in range(1, len(words) // times + 1):
        i = 0
        while i + p < len(words):
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(least, times * p):
                best.setdefault((i, j - i + p), p)
            i = j
    return sorted(((s, n, p) for (s, n), p in best.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = [w for w in (text or "").encode().replace(b"\x0b", b" ").replace(b"\x0c", b" ").split() if w]
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n = len(words)
    if h % 10 == 0 and n:
        a = (h // 10) % n
        p = 1 + (n - a) // (3 + (h // 10) % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = plain_runs(words)
    dropped = {i for s, m, p in found for i in range(s + p, s + m)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else None
    listed = "".join(f"{s},{m},{p}\n" for s, m, p in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *top, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def same_rows(got, want):
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


def test_runs_of_whole_documents(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 6000]
    want = [plain_row(*r) for r in rows]
    assert sum(r[1] > 0 for r in want) > 5
    same_rows(QUERIES["op11_periodic_runs"](spark, SF).join(spark.createDataFrame([(d,) for d, _ in rows], "doc_id long"), "doc_id").collect(), want)


def test_runs_of_made_up_words():
    rng = random.Random(5)

    def made():
        k, words = rng.choice([1, 2, 3, 8]), []
        while len(words) < rng.randint(0, 300):
            if rng.random() < 0.5:
                base = [rng.randrange(k) for _ in range(rng.randint(1, 30))]
                words += (base * rng.randint(1, 8))[: rng.randint(1, 200)]
            else:
                words += [rng.randrange(k + 3) for _ in range(rng.randint(1, 20))]
        return words

    total = 0
    for _ in range(120):
        texts = [made() for _ in range(rng.randint(1, 6))]
        numbers = np.array(sum(texts, []), np.int32)
        got = periodic.runs(numbers, np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in texts]))
        want, start = [], 0
        for t in texts:
            want += [(s + start, n, p) for s, n, p in plain_runs(t)]
            start += len(t)
        assert [tuple(r) for r in got.tolist()] == sorted(want, key=lambda r: (r[0], r[2]))
        total += len(want)
    assert total > 200


def test_runs_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(periodic, "PIECE", 50)
    long = " ".join(f"w{i % 37}" for i in range(9_000))
    texts = [(1, None), (2, ""), (3, " \n\x0b\t"), (4, "a b"), (5, "x " * 40), (5, "x " * 40), (None, "y\x0cy\n" * 30), (7, long), (8, "é ü " * 30), (9, "z" * 5000)]
    frame = spark.createDataFrame([(i, t, 1, "n", 2) for i, t in texts], "doc_id long, text string, period long, runs_sha256 string, start long")
    same_rows(periodic.periodic_runs(frame).collect(), [plain_row(*r) for r in texts])
    assert periodic.periodic_runs(frame.limit(0)).count() == 0


def test_words_part_where_split_parts_them():
    text = "a  b\tc\nd\x0be\x0cf\rg\x1ch i j ".encode()
    for piece in (1, 3, 100):
        periodic.PIECE, old = piece, periodic.PIECE
        try:
            assert [w for part in periodic.words(text * 7) for w in part] == (text * 7).split()
        finally:
            periodic.PIECE = old


# 12


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, low=False):
    out = ""
    for name in merkle.FIELDS:
        value = row[name]
        if value is None:
            out += "-"
            continue
        value = str(value)
        if low and name == "text":
            value = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in value)
        out += f"{len(value.encode())}:{value}"
    return h(out)


def plain_tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def plain_siblings(levels, i):
    out = []
    for nodes in levels[:-1]:
        a = i // 8 * 8
        out.append((nodes[a:i], nodes[i + 1 : a + 8]))
        i //= 8
    return out


def plain_manifest(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r), r))
    order = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    for own in groups.values():
        own.sort(key=lambda x: x[:3])
    trees = {k: plain_tree([x[2] for x in own]) for k, own in groups.items()}
    top = plain_tree([trees[k][-1][0] for k in order])
    out = []
    for g, k in enumerate(order):
        for i, (_, _, leaf, r) in enumerate(groups[k]):
            path = plain_siblings(trees[k], i) + plain_siblings(top, g)
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
            folded = plain_leaf(r, True) if hit else leaf
            for a, b in path:
                folded = h(*a, folded, *b)
            out.append((r["doc_id"], leaf, trees[k][-1][0], top[-1][0], h(*[x for a, b in path for x in a + b]), folded, folded == top[-1][0]))
    return out


def test_manifest_of_documents(spark, docs):
    want = plain_manifest([r.asDict() for r in docs.collect()])
    got = [tuple(r) for r in QUERIES["op12_merkle_manifest"](spark, SF).collect()]
    assert sorted(got) == sorted(want)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("stride", [1, 3])
def test_manifest_over_several_written_levels_and_many_groups(spark, monkeypatch, stride):
    monkeypatch.setattr(merkle, "STRIDE", stride)
    monkeypatch.setattr(merkle, "SPAN", 8**stride)
    rows = [{"doc_id": i, "source": f"s{i % 3}", "lang": "hot" if i % 2 else f"l{i % 41}", "n_chars": i, "text": f"Text {i}"} for i in range(300)]
    got = merkle.tampered(spark.createDataFrame([tuple(r.values()) for r in rows], "doc_id long, source string, lang string, n_chars long, text string"))
    assert sorted(tuple(r) for r in got.collect()) == sorted(plain_manifest(rows))


def test_manifest_of_odd_rows(spark):
    names = ("doc_id", "source", "lang", "n_chars", "text")
    values = [(1, None, None, None, None), (2, "s", "", 0, ""), (2, "s", "", 0, ""), (2, "s", "", 0, "B"), (None, "s", "é", 3, "ABC"), (None, None, "é", 3, "abc"), (3, "=", "-", 1, "X" * 100_000), (-5, "s", "z", 4, "É"), (6, "s", "Z", 4, "q")]
    rows = [dict(zip(names, v)) for v in values]
    frame = spark.createDataFrame([(*v, "k", 1, "p", 2) for v in values], "doc_id long, source string, lang string, n_chars long, text string, key string, rank long, path string, _part int")
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted((tuple(r) for r in merkle.tampered(frame).collect()), key=key) == sorted(plain_manifest(rows), key=key)
    assert merkle.tampered(frame.limit(0)).count() == 0
    alone = merkle.manifest(frame.where("doc_id = 1")).collect()
    assert len(alone) == 1 and alone[0].leaf == alone[0].root and alone[0].verified and alone[0].proof_sha256 == h()


# 13


def plain_nearest(rows, k=20, every=20):
    ok = [(i, v) for i, v in {(i, tuple(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}]
    width = max((len(v) for _, v in ok), default=1)
    ids = np.array([i for i, _ in ok])
    x = np.array([list(v) + [0.0] * (width - len(v)) for _, v in ok], np.float64)
    out = {}
    for n in np.flatnonzero(ids % every == 0):
        scores = (x * x[n]).sum(1)
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[n]][:k]
        out[int(ids[n])] = [(int(ids[j]), scores[j]) for j in order]
    return out


def found(frame):
    out = collections.defaultdict(list)
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(out[r.query_id]) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return dict(out)


def recall(got, want):
    return sum(len({i for i, _ in got[q]} & {i for i, _ in w}) for q, w in want.items()) / sum(map(len, want.values()))


def test_neighbours_of_the_given_vectors(spark):
    for sf in ("sf0.001", "sf0.1"):
        rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()]
        want, got = plain_nearest(rows), found(QUERIES["op13_permutation_neighbours"](spark, f"/root/testdata/{sf}"))
        assert got.keys() == want.keys() and all(len(got[q]) == len(w) for q, w in want.items())
        assert recall(got, want) >= 0.95
        for q, own in got.items():
            known = dict(plain_nearest([r for r in rows if r[0] in {q} | {i for i, _ in own}])[q])
            assert all(abs(known[i] - s) < 1e-12 for i, s in own)
            assert own == sorted(own, key=lambda x: (-x[1], x[0]))


def test_neighbours_over_blocks_with_norms_copies_and_clusters(spark, monkeypatch):
    monkeypatch.setattr(permutation, "BLOCK", 16_000)
    monkeypatch.setattr(permutation, "QUERIES", 40)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 16)) * rng.lognormal(0, 0.3, (3000, 1))
    x[::3] = x[0]  # a third of all rows is one vector
    x[1::9] = x[1] + rng.normal(size=(len(x[1::9]), 16)) * 0.02
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = plain_nearest(rows)
    assert recall(found(permutation.nearest(frame)), want) >= 0.9
    exact = found(permutation.nearest(frame, reranked=1.0))
    assert {q: [i for i, _ in w] for q, w in exact.items()} == {q: [i for i, _ in w] for q, w in want.items()}


def test_neighbours_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (20, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, []), (40, [0.0, -0.0]), (5, [nan, 1.0]), (60, [inf, 1.0]), (7, [None, 2.0]), (None, [3.0, 1.0]), (8, [2.0]), (9, [0.5, 0.5, 0.5]), (80, [0.0, 1.0])]
    frame = spark.createDataFrame([(i, v, 1, 2, 3, "s") for i, v in rows], "vec_id long, embedding array<double>, h1 long, h2 long, id long, score string")
    got = found(permutation.nearest(frame))
    assert got == plain_nearest(rows) and got[0] == [(8, 2.0), (1, 1.0), (20, 1.0), (9, 0.5), (80, 0.0)]
    assert permutation.nearest(frame.limit(0)).count() == 0
    assert permutation.nearest(frame.limit(1)).count() == 0
