"""SetSketch near-duplicates against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

from rivulet.llm import setsketch
from tests_llm_tools import empty

def shingles(text, n=3):
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()

def brute(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        known = [x for x in (d, least.get(find(i))) if x is not None]
        least[find(i)] = min(known, default=None)
    return sorted(map(repr, ((d, len(sets[i]), least[find(i)], d is not None and d == least[find(i)])
                             for i, (d, _) in enumerate(rows))))

def chains(seed, families=6, size=40, words=120):
    """Texts that differ from their parent in one to six words, so that links form chains."""
    rng = random.Random(seed)
    rows = []
    for f in range(families):
        texts = [[f"w{rng.randrange(400)}" for _ in range(words)]]
        while len(texts) < size:
            text = list(rng.choice(texts[-8:]))
            for _ in range(rng.randrange(1, 7)):
                text[rng.randrange(len(text))] = f"v{rng.randrange(10_000)}"
            texts.append(text)
        rows += [" ".join(t) for t in texts] + [" ".join(texts[0])] * 3
    rng.shuffle(rows)
    return list(enumerate(rows))

@pytest.mark.parametrize(("bucket", "part"), [(4096, 2_000_000), (8, 2_000_000), (4096, 900), (5, 500)])
def test_against_all_pairs(spark, bucket, part):
    rows = chains(3)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    found = setsketch.near_classes(docs, bucket=bucket, part=part)
    assert sorted(map(repr, (tuple(r) for r in found.collect()))) == brute(rows)

def test_messy_rows(spark, messy):
    rows = [(r["doc_id"], r["text"]) for r in messy.collect()]
    found = setsketch.near_classes(messy)
    got = sorted(map(repr, (tuple(r) for r in found.collect())))

    assert got == brute(rows)
    assert setsketch.near_classes(empty(messy)).collect() == []

def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(1)
    errors = []
    for share in (0.3, 0.6, 0.85, 0.95):
        for _ in range(40):
            common = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
            own = int(1000 * (1 - share) / share / 2)
            a = np.unique(np.concatenate([common, rng.integers(0, 1 << 63, own, dtype=np.uint64)]))
            b = np.unique(np.concatenate([common, rng.integers(0, 1 << 63, own, dtype=np.uint64)]))
            sa, sb = setsketch.sketch(a), setsketch.sketch(b)
            assert (setsketch.merge(sa, sb) == setsketch.sketch(np.union1d(a, b))).all()
            above, below = np.array([(sa > sb).sum()]), np.array([(sa < sb).sum()])
            equal = setsketch.REGISTERS - above - below
            grid = np.linspace(0, 1, 201)
            best = grid[np.argmax([setsketch.log_likelihood(s, len(a), np.array([float(len(b))]), above, below, equal)[0]
                                   for s in grid])]
            errors.append(best - share)
            if share >= 0.85:
                assert setsketch.plausible(sa, len(a), sb[None], np.array([len(b)]), 85)[0]
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.06

def test_exact_threshold_and_short_texts(spark):
    base = [f"w{i}" for i in range(102)]
    rows = [(1, " ".join(base)), (2, " ".join(base[:87])), (3, " ".join(base[:86])),  # 85 and 84 of 100 shingles
            (4, "one two"), (5, "ONE\ttwo"), (6, "one"), (7, "one two three"), (8, ""), (9, " \n"), (10, None),
            (11, "word " * 50_000), (12, "word word word")]
    found = {r["doc_id"]: tuple(r)[1:] for r in setsketch.near_classes(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert sorted(map(repr, ((d, *v) for d, v in found.items()))) == brute(rows)
    assert found[2] == (85, 1, False) and found[5] == (1, 4, False) and found[9] == (0, 9, True)
    assert found[12] == (1, 11, False)
