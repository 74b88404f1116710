"""Archives written and read back, with magics where none should count."""

import hashlib
import random

import pytest

from flowkit.llm.warc import archive_pages, reachable, read_warc
from flowkit.session import scratch_dir
from tests.llm.helpers import clashing

SCHEMA = "page_id long, url string, html string"
MAGIC = "WARC/1.1\r\n"
RECORD = MAGIC + "WARC-Type: response\r\nWARC-Record-ID: <urn:x-page:999>\r\nContent-Length: 4\r\n\r\nevil\r\n\r\n"


def plain(rows):
    """What reading back must give, straight from the definition."""
    raw = [(i, (h or "").encode()) for i, _, h in rows]
    out = []
    for i, b in raw:
        same = [k for k, c in raw if c == b and k is not None]
        first = min(same, default=None)
        revisit = len(b) >= 100 and first is not None and (i is None or i > first)
        kind = "revisit" if revisit else "response"
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), kind, first if revisit else None, True))
    return sorted(out, key=repr)


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def pages():
    long = "<p>" + "wörter " * 40
    rows = [
        (1, "http://a.org/", long),
        (2, "http://b.org/", long),
        (3, None, None),
        (4, "http://c.org/\r\nWARC-Type: evil", ""),
        (5, "", "short"),
        (6, "x", "short"),
        (7, "x", MAGIC * 30),
        (8, "x", "before" + RECORD * 3 + "after" * 30),
        (9, "x", "before" + RECORD * 3 + "after" * 30),
        (10, "x", RECORD),
        (11, "x", "\r\n\r\n" + RECORD + "\r\n\r\n\r\n\r\n"),
        (12, "x", long),
        (12, "x", long),
        (1, "x", long),
        (None, "x", long),
        (None, "x", "only here and with no id " * 9),
        (13, "x", "y" * 300_000),
    ]
    r = random.Random(3)
    for n in range(100, 160):
        rows.append((n, f"http://h{n}.org/", "".join(r.choice(["a", MAGIC, "\r\n", RECORD, "é" * 50]) for _ in range(r.randint(0, 12)))))
    return rows


@pytest.mark.parametrize("per_file", [100_000, 7, 1])
def test_round_trip(spark, per_file):
    rows = pages()
    docs = clashing(spark.createDataFrame(rows, SCHEMA))
    assert found(archive_pages(docs, records_per_file=per_file)) == plain(rows)


def test_files_in_many_splits(spark):
    rows = pages()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        assert found(archive_pages(spark.createDataFrame(rows, SCHEMA).coalesce(1))) == plain(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_no_pages(spark):
    assert archive_pages(spark.createDataFrame([], SCHEMA)).count() == 0


def test_what_follows_a_broken_header_is_not_reached(spark):
    path = scratch_dir(spark, "broken")
    good = MAGIC + "WARC-Type: response\r\nWARC-Record-ID: <urn:x-page:{}>\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    text = good.format(1) + good.format(2) + MAGIC + "WARC-Type: response\r\nContent-Length: x\r\n\r\nab\r\n\r\n" + good.format(3)
    spark.createDataFrame([(text,)], "value string").write.option("lineSep", "\r\n").text(path)
    assert sorted(r.record_id for r in read_warc(spark, path).collect()) == ["<urn:x-page:1>", "<urn:x-page:2>"]


@pytest.mark.parametrize(
    "length", [3 * 10**9, 2**63 - 1, -(2**63), 2**63, "+5", " 7 ", "", 0, "5\r\nContent-Length: 9"]
)
def test_any_length_inside_a_payload(spark, length):
    evil = f"{MAGIC}Content-Length: {length}\r\n\r\n"
    rows = [(1, "x", "before" + evil + "after"), (2, "x", evil), (3, "x", evil * 3 + "y" * 200), (4, "x", evil * 3 + "y" * 200)]
    assert found(archive_pages(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


@pytest.mark.parametrize("length", [3 * 10**9, 2**63 - 1, -(2**63), -1, 9])
def test_a_record_longer_than_its_file_is_none(spark, length):
    path = scratch_dir(spark, "longer")
    head = MAGIC + "WARC-Type: response\r\nWARC-Record-ID: <urn:x-page:{}>\r\nContent-Length: {}\r\n\r\nab\r\n\r\n"
    text = head.format(1, 2) + head.format(2, length)
    # The writer ends the file with its separator, which is none of the record's.
    spark.createDataFrame([(text[:-2],)], "value string").write.option("lineSep", "\r\n").text(path)
    assert [r.record_id for r in read_warc(spark, path).collect()] == ["<urn:x-page:1>"]


def test_reachable_is_the_chain_from_the_start(spark):
    r = random.Random(4)
    rows, want = [], set()
    for f in range(6):
        starts = sorted({0, *r.sample(range(1, 3000), 200)})
        after = {}
        for n, s in enumerate(starts):
            later = starts[n + 1 :]
            # Most lead to the next, some skip, some lead nowhere.
            after[s] = later[0] if later and r.random() < 0.7 else r.choice([*later[:9], s + 1])
        rows += [(str(f), s, after[s]) for s in starts]
        at = 0
        while at in after:
            want.add((str(f), at))
            at = after[at]
    got = reachable(spark.createDataFrame(rows, "file string, start long, next long"))
    assert {(x.file, x.start) for x in got.collect()} == want
