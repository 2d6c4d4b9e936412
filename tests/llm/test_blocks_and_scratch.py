"""What the operators do in blocks, in caches and in the shared folder gives the same as doing it plainly."""

import random
import sys
import time
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402

from domloom.llm import minhash, repeats, tokens  # noqa: E402
from domloom.llm.common import cut, settled  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_components_dealt_in_many_small_blocks(spark, monkeypatch):
    """A large family of near copies of one text, half of them too far from each other, beside other documents."""
    monkeypatch.setattr(minhash, "SIGNATURES", 7)
    monkeypatch.setattr(minhash, "SHINGLES", 300)
    rng = random.Random(6)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(60)] = f"x{rng.randrange(5)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(f"v{rng.randrange(40)}" for _ in range(30))) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for percent in (80, 85):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_components(frame, percent, region=10).collect()}
        assert got == brute.near_components(rows, percent)
    assert len({c for _, c in got.values()}) > 45


def test_trees_follow_the_bound():
    for percent in (60, 80, 85, 95):
        n, p = minhash.trees(percent), (percent / 100) ** minhash.DEPTH
        assert (1 - p) ** n <= minhash.MISSED < (1 - p) ** (n - 1)


@pytest.mark.parametrize("cached", [50, 500_000])
def test_counts_of_stretches_between_any_blanks(monkeypatch, cached):
    monkeypatch.setattr(tokens, "CACHED", cached)
    counter = tokens.Counter50k(public_tokenizers.path("byte_bpe_50k.json"))
    assert counter.by_rank is not None
    rng = random.Random(3)
    parts = ["a", "b", "don't", "'s", " ", "  ", "\n", "\t", "\r\n", "\x0b", "　", "\xa0", "“", "世界", ".", "12", "\x1c", "\x85", "é", "’", "é", "<|endoftext|>", " \n ", " x", "qzj"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert counter.count(text) == counter.encode(text), repr(text)
    letters = [chr(c) for c in [*range(0x21, 0x7F), *range(0xA1, 0x250)]]
    for _ in range(5000):
        word = "".join(rng.choice(letters) if rng.random() < 0.4 else rng.choice(["the", "in", "er", "on", "ing", "st"]) for _ in range(rng.randint(1, 10)))
        assert counter.count("a " + word) == counter.encode("a " + word), word
    assert len(counter.cache) <= cached


def test_a_tokenizer_without_merge_order_is_asked_itself(tmp_path):
    import json

    spec = json.loads(Path(public_tokenizers.path("byte_bpe_50k.json")).read_text())
    merges = spec["model"]["merges"]
    spec["model"]["merges"] = merges[:2000][::-1] + merges[2000:]
    (tmp_path / "odd.json").write_text(json.dumps(spec))
    counter = tokens.Counter50k(str(tmp_path / "odd.json"))
    assert counter.by_rank is None
    assert counter.count("the other  thing is\nthere") == counter.encode("the other  thing is\nthere")


def test_scratch_goes_when_the_decision_is_kept(spark):
    base = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(base.glob("scratch-*"))
    kept = settled(spark, lambda: cut(spark.range(1000).repartition(4)).where("id % 2 = 0"))
    assert set(base.glob("scratch-*")) == before
    assert kept.count() == 500 and cut(kept).count() == 500
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert minhash.keep_one(docs).count() == docs.count() - sum(d != c for d, (_, c) in brute.near_components([(r.doc_id, r.text) for r in docs.collect()], 80).items())


def kept_rows(spark):
    """Folders of rows kept by ``cut`` and still there."""
    return set(Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")).glob("**/rdd-*"))


def test_a_decision_within_a_decision_goes_with_its_scratch(spark):
    before = kept_rows(spark)
    kept = settled(spark, lambda: settled(spark, lambda: cut(spark.range(100))).where("id < 10"))
    assert kept.count() == 10 and len(kept_rows(spark) - before) == 1


def test_names_are_gone_when_the_texts_are_moved(spark):
    docs, before = spark.read.parquet(f"{SF}/documents.parquet"), kept_rows(spark)
    repeats.covered(docs)
    assert len(kept_rows(spark) - before) == 4  # rows, owners, asked names, marks


def shuffles(spark):
    """Numbers of the shuffles that have files on disk."""
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {int(f.name.split("_")[1]) for folder in folders for f in Path(folder).glob("*/shuffle_*")}


def test_shuffle_files_go_with_their_round(spark):
    """A chain takes many rounds; the files of all of them stayed until the driver happened to collect its garbage."""
    before = shuffles(spark)
    chain = spark.range(1, 3000).selectExpr("(id * 7) % 3000 as a", "((id - 1) * 7) % 3000 as b")
    found = minhash.components(chain)
    made, until = max(shuffles(spark)) - max(before, default=-1), time.time() + 10
    while len(shuffles(spark) - before) > made / 2 and time.time() < until:  # Spark deletes in the background
        time.sleep(0.1)
    assert made > 30 and len(shuffles(spark) - before) <= made / 2
    assert found.count() == 3000 and found.where("component <> 0").isEmpty()


def test_contraction_ends_at_stars(spark, monkeypatch):
    """Edges that are stars already take no round; two stars with a common node take some."""
    rounds, contracted = [], minhash._contracted
    monkeypatch.setattr(minhash, "_contracted", lambda edges: rounds.append(1) or contracted(edges))

    def found(edges):
        rounds.clear()
        return dict(map(tuple, minhash.components(spark.createDataFrame(edges, "a long, b long")).collect())), len(rounds)

    assert found([(1, 5), (6, 1), (1, 1), (8, 7), (8, 7), (7, 8)]) == ({1: 1, 5: 1, 6: 1, 7: 7, 8: 7}, 0)
    assert found([(3, 1), (3, 2)]) == ({1: 1, 2: 1, 3: 1}, 1)
    assert found([(3, 2), (2, 1)]) == ({1: 1, 2: 1, 3: 1}, 1)
    assert found([]) == ({}, 0)


@pytest.mark.parametrize("buckets", [64, 700])
def test_samples_are_spread_evenly_over_the_buckets(buckets):
    """Names are least hashes, so their own high bits gather in the first buckets (the largest had 16 times the mean)."""
    rng = np.random.default_rng(1)
    _, names, valid, _ = repeats._names([bytes(rng.integers(97, 123, 2000, dtype=np.uint8)) for _ in range(2000)], buckets)
    sizes = np.bincount(np.unique(names[valid]) >> 40, minlength=buckets)
    assert len(sizes) == buckets
    assert sizes.max() < 1.5 * sizes.mean() and sizes.min() > 0.5 * sizes.mean()
