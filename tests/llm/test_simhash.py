"""Fingerprints and components against plain versions."""

import random

import numpy as np
import pytest
import xxhash

from flowkit.llm.components import component_roots
from flowkit.llm.simhash import close_prints, keep_one_of_each, near_duplicates, simhash
from tests.llm.helpers import clashing, corpus, frame


def plain_print(text, size=3):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def close_pairs(prints, distance=3):
    return [(a, b) for i, a in enumerate(prints) for b in prints[i + 1 :] if (a ^ b).bit_count() <= distance]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("text", ["", "one", "One TWO", "a b c", "É é A a " * 9, "x\x0by\x0cz\tw " * 700])
def test_fingerprint(text):
    assert simhash(text.encode()) == plain_print(text)


@pytest.mark.parametrize("bucket", [4096, 4])
def test_links_join_what_close_pairs_join(spark, bucket):
    r = random.Random(5)
    prints = {r.getrandbits(64) for _ in range(30)}
    for p in list(prints):  # chains, and a dense group
        for _ in range(4):
            for b in r.sample(range(64), r.randint(1, 4)):
                p ^= 1 << b
            prints.add(p)
    dense = r.getrandbits(64)
    prints |= {dense ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(12, 24)}
    prints = sorted(prints)
    links = close_prints(spark.createDataFrame([(signed(p),) for p in prints], "print long"), 3, bucket).collect()
    found = [(a % (1 << 64), b % (1 << 64)) for a, b in ((x.u, x.v) for x in links)]
    assert all((a ^ b).bit_count() <= 3 for a, b in found)
    assert groups(prints, found) == groups(prints, close_pairs(prints))


@pytest.mark.parametrize("bucket", [2000, 100, 3])
def test_buckets_are_split_until_they_are_small(spark, bucket):
    """Two thousand fingerprints in a small corner, and chains through it, at any size of a bucket."""
    r = random.Random(9)
    corner = r.getrandbits(64)
    places = r.sample(range(32, 64), 13)
    prints = set()
    while len(prints) < 2000:
        p = corner
        for b in places:
            p ^= r.getrandbits(1) << b
        prints.add(p ^ (1 << r.randrange(32)) if r.random() < 0.2 else p)
    far = {corner ^ 0xFF00FF00 ^ (k << 40) for k in range(0, 255, 7)}
    prints = sorted(prints | far)
    links = close_prints(spark.createDataFrame([(signed(p),) for p in prints], "print long"), 3, bucket).collect()
    found = [(a % (1 << 64), b % (1 << 64)) for a, b in ((x.u, x.v) for x in links)]
    assert all((a ^ b).bit_count() <= 3 for a, b in found)
    assert groups(prints, found) == groups(prints, close_pairs(prints))


def test_variants_need_a_small_distance(spark):
    with pytest.raises(ValueError):
        close_prints(spark.createDataFrame([], "print long"), 4)


def test_component_roots(spark):
    r = random.Random(6)
    edges = [(i, i + 1) for i in range(100, 140)] + [(r.randint(0, 60), r.randint(0, 60)) for _ in range(40)] + [(7, 7)]
    got = {x.node: x.root for x in component_roots(spark.createDataFrame(edges, "u long, v long")).collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert got == groups(sorted(nodes), edges and [e for e in edges if e[0] != e[1]])
    assert component_roots(spark.createDataFrame([], "u long, v long")).count() == 0


def rows_with_edges():
    base = "the quick brown fox jumps over the lazy dog and runs far away from here today " * 6
    return [
        *corpus(7, 30),
        (3000, base),
        (2000, base + "once"),
        (2000, base + "once"),  # a repeated row
        (2000, base + "once more"),  # its id with another text
        (None, base),
        (4000, None),
        (4001, ""),
        (4002, " \n"),
        (None, "alone with no id but with words of its own that nobody else has"),
    ]


def test_near_duplicates(spark):
    rows = rows_with_edges()
    got = near_duplicates(clashing(frame(spark, rows))).collect()
    prints = [plain_print(t or "") for _, t in rows]
    assert sorted(repr((x.doc_id, x.print)) for x in got) == sorted(repr((i, signed(p))) for (i, _), p in zip(rows, prints))
    root = groups(sorted(set(prints)), close_pairs(sorted(set(prints))))
    least = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            least[root[p]] = min(least.get(root[p], i), i)
    assert {(x.print, x.component_id) for x in got} == {(signed(p), least.get(root[p])) for p in prints}
    assert near_duplicates(frame(spark, [])).count() == 0


def test_one_row_of_each_component_stays(spark):
    rows = rows_with_edges()
    docs = clashing(frame(spark, rows))
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    prints = [plain_print(t or "") for _, t in rows]
    root = groups(sorted(set(prints)), close_pairs(sorted(set(prints))))
    least = {}
    for (i, _), p in zip(rows, prints):
        least.setdefault(root[p], []).append(i)
    want = sorted(repr(min((i for i in ids if i is not None), default=None)) for ids in least.values())
    assert sorted(repr(x.doc_id) for x in got) == want
    assert keep_one_of_each(frame(spark, [])).count() == 0


def test_a_group_of_near_copies_gives_few_links(spark):
    r = np.random.default_rng(8)
    center = int(r.integers(1 << 62))
    prints = sorted({center ^ (1 << int(a)) ^ (1 << int(b)) for a, b in r.integers(0, 40, (600, 2))})
    links = close_prints(spark.createDataFrame([(p,) for p in prints], "print long"))
    assert links.count() < 64 * len(prints)
