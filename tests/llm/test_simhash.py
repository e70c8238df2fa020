import random
import re

import numpy as np
import pytest
import xxhash

from adpulse.llm import simhash
from adpulse.llm.graph import components


def plain(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not w:
        return 0
    grams = [" ".join(w)] if len(w) < 3 else [" ".join(w[i:i + 3]) for i in range(len(w) - 2)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, distance=3):
    """Smallest member of each value's class, by comparing all pairs."""
    values = sorted(set(values))
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for i, a in enumerate(values):
        for j in range(i):
            if bin(a ^ values[j]).count("1") <= distance:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return {v: values[find(i)] for i, v in enumerate(values)}


@pytest.fixture(scope="module")
def fingerprints():
    rng = random.Random(9)
    out = {0, (1 << 64) - 1, 1 << 63}
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(60):  # a dense ball and chains that leave it
            x = centre
            for _ in range(rng.randrange(0, 5)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    out |= {rng.getrandbits(64) for _ in range(300)}
    return sorted(out)


PLANS = {
    "four": [(list(range(k, 64, 4)), 0) for k in range(4)],
    "three": [(list(range(0, 22)), 1), (list(range(22, 43)), 0), (list(range(43, 64)), 0)],
    "two": [(list(range(0, 64, 2)), 1), (list(range(1, 64, 2)), 1)],
    "one-sided": [(list(range(0, 20)), 2), (list(range(20, 64)), -1), ],
}


@pytest.mark.parametrize("name", ["four", "three", "two"])
def test_no_link_is_lost(spark, fingerprints, name):
    signed = [simhash._signed(x) for x in fingerprints]
    distinct = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(5)
    links = simhash.verified_links(simhash.signatures(distinct, PLANS[name]))
    pairs = links.collect()
    assert all(bin((a ^ b) & (1 << 64) - 1).count("1") <= 3 for a, b in pairs)
    label = {r.v: r.label for r in components(links).collect()}
    groups = {}
    for x in signed:
        groups.setdefault(label.get(x, x), set()).add(x & (1 << 64) - 1)
    want = {}
    for x, least in classes(fingerprints).items():
        want.setdefault(least, set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_thresholds_satisfy_the_pigeonhole():
    rng = np.random.default_rng(2)
    bits = (rng.random((500, 64)) < 0.5).astype(float)
    for n in (10, 10_000, 10_000_000, 10 ** 11):
        plan = simhash.allocate(n, bits.T @ bits * n / 500)
        assert sorted(b for group, _ in plan for b in group) == list(range(64))
        assert sum(t for _, t in plan) == 3 - len(plan) + 1


def test_correlated_bits_are_grouped():
    rng = np.random.default_rng(3)
    bits = (rng.random((4000, 64)) < 0.5).astype(float)
    bits[:, 40] = bits[:, 3]
    group = next(g for g in simhash.correlated_groups(4000, bits.T @ bits, 4) if 3 in g)
    assert 40 in group


def test_odd_rows(odd):
    out = simhash.near_duplicates(odd).collect()
    prints = {r.text: plain(r.text) for r in out}
    least = classes(prints.values())
    for r in out:
        assert r.fingerprint == f"{prints[r.text]:016x}"
        ids = [x.doc_id for x in out if x.doc_id is not None and least[prints[x.text]] == least[prints[r.text]]]
        assert r.component_id == min(ids, default=None)
    kept = [least[prints[r.text]] for r in out if r.kept]
    assert len(kept) == len(set(kept)) == len(set(least.values()))
    assert simhash.without_near_duplicates(odd).columns == odd.columns


def test_empty_table(none):
    assert simhash.near_duplicates(none).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, k) for k in range(2, 60)] + [(200, 200)]
    got = {}
    for r in components(spark.createDataFrame(edges, "a long, b long")).collect():
        got.setdefault(r.label, set()).add(r.v)
    assert sorted(map(len, got.values())) == [59, 61]
