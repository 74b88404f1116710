"""Benchmark passages against a plain search."""

import random

import pytest

from flowkit.llm.contamination import best_match, budget, drop_leaks, find_leaks, normal, pieces
from tests.llm.helpers import clashing, frame


def plain_distance(item, text):
    """Least edits between the item and any stretch of the text, and the first end of such a stretch."""
    row = list(range(len(item) + 1))
    best = (row[-1], 0)
    for at, c in enumerate(text, 1):
        new = [0]
        for i, d in enumerate(item, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (c != d)))
        row = new
        if row[-1] < best[0]:
            best = (row[-1], at)
    return best


def edited(r, text, edits):
    out = list(text)
    for _ in range(edits):
        at = r.randrange(len(out))
        kind = r.random()
        if kind < 0.33:
            out[at] = r.choice("xyz ")
        elif kind < 0.66:
            del out[at]
        else:
            out.insert(at, r.choice("xyz"))
    return "".join(out)


def test_bit_parallel_distance():
    r = random.Random(1)
    for _ in range(200):
        item = "".join(r.choice("ab ") for _ in range(r.randint(1, 90)))
        text = "".join(r.choice("ab ") for _ in range(r.randint(0, 40))) + edited(r, item, r.randint(0, min(4, len(item) - 1)))
        want = plain_distance(item, text)
        for limit in (0, 3, len(item)):
            got = best_match(item, text, limit)
            assert got == (want if want[0] <= limit and want[1] else None) or want[0] == len(item)


def test_pieces_cover_the_item():
    for edits in (0, 1, 5, 99):
        own = pieces("abcdefghij", edits)
        assert "".join(p for _, p in own) == "abcdefghij" and len(own) == min(edits + 1, 10)
        assert all("abcdefghij"[a : a + len(p)] == p for a, p in own)


def words(r, n):
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9))) for _ in range(n))


def long_text(r, items):
    """Fifty thousand characters with one item as it is and one with two edits."""
    item = items[9][1]
    return words(r, 4000) + " " + item[:9] + "#" + item[10:30] + item[31:] + "~ " + words(r, 4000) + items[7][1]


def case():
    r = random.Random(2)
    items = [(i, words(r, r.randint(8, 50))) for i in range(12)] + [(50, ""), (51, " \n"), (52, "tiny"), (None, "none")]
    rows = []
    for n in range(60):
        text = words(r, r.randint(0, 60))
        if n % 3 == 0:
            item = r.choice(items[:12])[1]
            text += " " + edited(r, item, r.randint(0, int(len(item) * 0.12))).upper().replace(" ", " \n") + " " + words(r, 9)
        rows.append((n, text))
    rows += [(207, items[3][1]), (None, items[4][1]), (100, None), (101, ""), (102, f"a {items[5][1]} b {items[6][1]} {items[5][1]}")]
    rows += [rows[0], (103, "x" * 20 + "TINY"), (104, long_text(r, items))]
    return rows, items


@pytest.mark.parametrize("block_bytes", [1 << 22, 300])
def test_leaks(spark, block_bytes):
    rows, items = case()
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = find_leaks(clashing(frame(spark, rows)), bench, block_bytes=block_bytes).collect()
    want = []
    for i, t in rows:
        for k, x in items:
            x = normal(x)
            if t is not None and k is not None and x:
                edits = budget(len(x), 0.08)
                # Over long texts the bit-parallel recurrence, which is compared with the plain one above, and no pieces.
                d = plain_distance(x, normal(t)) if len(t) < 30_000 else best_match(x, normal(t), edits)
                if d and d[0] <= edits:
                    want.append((i, k, d[0], d[1]))
    assert sorted(map(repr, ((r.doc_id, r.item_id, r.edits, r.last) for r in got))) == sorted(map(repr, want))
    assert {(k, d) for i, k, d, _ in want if i == 104} == {(7, 0), (9, 2)}


def test_documents_with_leaks_go(spark):
    rows, items = case()
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = clashing(frame(spark, rows))
    leaked = {r.doc_id for r in find_leaks(docs, bench).collect()}
    kept = drop_leaks(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in rows if i not in leaked)


def test_empty_tables(spark):
    rows, items = case()
    docs, bench = frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    assert find_leaks(docs, bench.limit(0)).count() == 0
    assert find_leaks(docs.limit(0), bench).count() == 0
    assert drop_leaks(docs, bench.limit(0)).count() == len(rows)
