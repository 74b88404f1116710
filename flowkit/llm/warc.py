"""WARC archives: pages written as records, and records found again by their chain of boundaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowkit.session import materialize, scratch_dir

# Fixed values of the format.
_MAGIC = "WARC/1.1\r\n"
_END = "\r\n\r\n"


def _header(*lines: Column) -> Column:
    return F.concat_ws("\r\n", *lines)


def _line(name: str, value: Column) -> Column:
    """A header line; NULL, which ``concat_ws`` leaves out, without a value."""
    bare = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(F.lit(f"{name}: "), bare)


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def first_copies(pages: DataFrame, least_bytes: int) -> DataFrame:
    """``digest`` and smallest page id ``first`` of payloads that several pages share.

    Written as a table, so that the join with the pages knows its size.
    """
    shared = (
        pages.where(F.col("bytes") >= least_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
    )
    return materialize(shared.select("digest", "first"), "first-copies")


def write_warc(
    pages: DataFrame,
    path: str,
    least_bytes: int = 100,
    records_per_file: int = 100_000,
    date: str = "2024-01-01T00:00:00Z",
) -> None:
    """One record per row of ``page_id``, ``url``, ``html`` into the files of a new folder.

    The payload is the html in UTF-8, NULL is empty, behind an HTTP header. Of
    equal payloads of at least ``least_bytes`` bytes the one with the smallest
    ``page_id`` is a response; the others are revisits, which hold the header
    and refer to it. Rows that repeat the smallest id are responses too, and
    so are rows with a NULL id where no other row has one. Line ends in a url
    are percent-encoded. Payloads are moved only if the table of shared ones
    is too large to broadcast.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    plain = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html")
    ).withColumns({"digest": F.sha2("html", 256), "bytes": F.octet_length("html")})
    copies = first_copies(plain.select("page_id", "digest", "bytes"), least_bytes)
    # A short payload is in no row of the table unless it is as long as it says.
    revisit = F.col("first").isNotNull() & (F.coalesce(F.col("page_id") > F.col("first"), F.lit(True)))
    http = _header(
        F.lit("HTTP/1.1 200 OK"),
        F.lit("Content-Type: text/html; charset=utf-8"),
        _line("Content-Length", F.col("bytes").cast("string")),
    )
    block = F.concat(http, F.lit(_END), F.when(F.col("revisit"), F.lit("")).otherwise(F.col("html")))
    record = _header(
        F.lit(_MAGIC.strip()),
        F.concat(F.lit("WARC-Type: "), F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", _record_id(F.col("page_id"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        F.when(F.col("revisit"), _line("WARC-Refers-To", _record_id(F.col("first")))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        _line("Content-Length", F.octet_length("block").cast("string")),
    )
    (
        plain.join(copies, "digest", "left")
        .withColumn("revisit", revisit)
        .withColumn("block", block)
        .select(F.concat(record, F.lit(_END), F.col("block")).alias("value"))
        .write.option("lineSep", _END)
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


def _field(header: Column, name: str) -> Column:
    found = F.regexp_extract(header, rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1)
    return F.when(found != "", found)


def _parsed(value: Column) -> list[Column]:
    """What a chunk behind a magic says, read as a record."""
    header = F.substring_index(value, _END, 1)
    length = _field(header, "Content-Length").try_cast("long")
    begin = F.octet_length(header) + len(_END)
    ended = F.octet_length(value) >= begin
    # Compared with the bytes at hand first: a header may say any number.
    at_hand = F.least(F.greatest(length, F.lit(0)), F.octet_length(value)).cast("int")
    block = F.substring(value.cast("binary"), begin + 1, at_hand)
    http = F.octet_length(F.substring_index(block.cast("string"), _END, 1)) + len(_END)
    payload = F.substring(block, http + 1, F.length(block))
    return [
        F.when(ended & (length >= 0), F.try_add(begin, length)).alias("says"),
        F.when(ended & (length >= 0), _field(header, "WARC-Type")).alias("record_type"),
        _field(header, "WARC-Record-ID").alias("record_id"),
        _field(header, "WARC-Refers-To").alias("refers_to"),
        _field(header, "WARC-Payload-Digest").alias("named_digest"),
        F.sha2(payload, 256).alias("digest"),
        F.length(payload).cast("long").alias("payload_bytes"),
    ]


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """What stands between two magics, with the file and a number that follows its order there."""
    return (
        spark.read.option("lineSep", _MAGIC)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.struct(
                F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")
            ).alias("at"),
            "value",
        )
    )


def _placed(chunks: DataFrame) -> DataFrame:
    """Adds ``start``, where the magic of a chunk stands, ``end``, where the next one does, and ``last``, the file's end."""
    size = F.col("size") + len(_MAGIC)
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(size).over(before), F.lit(0)) - len(_MAGIC)
    placed = chunks.withColumn("start", start).withColumn("end", F.col("start") + size)
    return placed.withColumn("last", F.max("end").over(Window.partitionBy("file")))


def reachable(candidates: DataFrame) -> DataFrame:
    """Of candidate records ``file``, ``start``, ``next``, those that the chain from a file's start reaches.

    A candidate whose successor is the next candidate belongs to one run with
    it, so a run has one exit. Pointer jumping over runs doubles the reach of
    every run in each round until none is new; runs are as many as false
    magics and gaps, not as records.
    """
    order = Window.partitionBy("file").orderBy("start")
    broken = F.coalesce(F.lag("next").over(order) != F.col("start"), F.lit(True))
    rows = materialize(
        candidates.withColumn("new", broken.cast("int")).withColumn(
            "run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0))
        ),
        "candidates",
    )
    exits = rows.groupBy("file", "run").agg(F.max_by("next", "start").alias("start"))
    jumps = materialize(
        exits.join(rows.select("file", "start", F.col("run").alias("to")), ["file", "start"])
        .select("file", "run", "to", F.col("start").alias("entry")),
        "jumps",
    )
    reached = rows.where("start = 0").select("file", "run", F.lit(0).cast("long").alias("entry"))
    while not jumps.isEmpty():
        step = jumps.select("file", "run", F.col("to").alias("next_run"), F.col("entry").alias("next_entry"))
        further = reached.join(step, ["file", "run"]).select(
            "file", F.col("next_run").alias("run"), F.col("next_entry").alias("entry")
        )
        new = materialize(further.join(reached.select("file", "run"), ["file", "run"], "left_anti"), "reached")
        if new.isEmpty():
            break
        reached = materialize(reached.union(new), "reached")
        doubled = step.alias("a").join(
            jumps.alias("b"), (F.col("a.file") == F.col("b.file")) & (F.col("a.next_run") == F.col("b.run"))
        )
        jumps = materialize(doubled.select("a.file", "a.run", "b.to", "b.entry"), "jumps")
    return rows.join(reached, ["file", "run"]).where("start >= entry").drop("new", "run", "entry")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives in a folder, without payloads: their type, ids, digest and size.

    Files are read in splits. Each magic makes a candidate whose header names
    its successor; only candidates on the chain from the file's start are
    records, so magics inside payloads are not. A record that such a magic
    cuts is put together again from the chunks up to its successor. What
    follows a broken header is unreachable and left out, and so is a record
    that a header makes longer than its file, by any number. A record is
    shorter than 2 GB, the most that a value of Spark holds; a longer one
    fails the read. ``digest`` and
    ``payload_bytes`` are those of the payload read, ``named_digest`` is what
    the header says.
    """
    chunks = _chunks(spark, path).select("file", "at", F.octet_length("value").alias("size"), *_parsed(F.col("value")))
    placed = materialize(_placed(materialize(chunks, "chunks")), "placed")
    first = F.col("start") + len(_MAGIC)
    following = F.try_add(first + len(_END), F.col("says"))
    # What would end behind its file has no successor there and is no record.
    candidates = placed.where("start >= 0").withColumn("next", following).where("next <= last").drop("last")
    found = materialize(reachable(candidates), "records")
    whole = found.where("next <= end")
    fields = ["record_type", "record_id", "refers_to", "named_digest", "digest", "payload_bytes"]
    cut = found.where("next > end")
    if cut.isEmpty():
        return whole.select(*fields)
    # Only files with a cut record are read again, and only the chunks of such records are moved.
    files = cut.select("file").distinct()
    again = _placed(
        _chunks(spark, path).join(files, "file").withColumn("size", F.octet_length("value"))
    ).where("start >= 0")
    owners = found.select("file", "start", F.col("start").alias("owner"), F.col("next").alias("until"))
    order = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    owned = (
        again.select("file", "start", "end", "value")
        .join(owners, ["file", "start"], "left")
        .withColumn("owner", F.last("owner", True).over(order))
        .withColumn("until", F.last("until", True).over(order))
        .join(cut.select("file", F.col("start").alias("owner")), ["file", "owner"], "left_semi")
        .where("start < until")
    )
    parts = F.transform(F.array_sort(F.collect_list(F.struct("start", "value"))), lambda x: x["value"])
    joined = owned.groupBy("file", "owner").agg(F.array_join(parts, _MAGIC).alias("value"))
    mended = joined.select(*_parsed(F.col("value")))
    return whole.select(*fields).union(mended.select(*fields))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Adds to revisits the digest and size of the payload they refer to.

    Returns ``page_id``, ``payload_bytes``, ``payload_digest``,
    ``record_type``, ``refers_to`` (a page id) and ``digest_ok``: whether the
    payload has the digest that the record names.
    """
    number = lambda c: F.regexp_extract(c, r"<urn:x-page:(-?\d*)>", 1).try_cast("long")
    rows = records.select(
        number(F.col("record_id")).alias("page_id"),
        number(F.col("refers_to")).alias("refers_to"),
        "record_type",
        "digest",
        "payload_bytes",
        F.substring_index("named_digest", ":", -1).alias("named"),
    )
    answers = rows.where("record_type <> 'revisit'").withColumn("refers_to", F.lit(None).cast("long"))
    revisits = materialize(rows.where("record_type = 'revisit'").select("page_id", "refers_to", "named"), "revisits")
    # A page id that several responses carry: the one with the digest counts.
    origin = (
        answers.select(F.col("page_id").alias("refers_to"), F.col("digest").alias("named"), "payload_bytes").distinct()
    )
    found = revisits.join(origin, ["refers_to", "named"], "left").select(
        "page_id",
        "refers_to",
        F.lit("revisit").alias("record_type"),
        F.col("named").alias("digest"),
        "payload_bytes",
        F.when(F.col("payload_bytes").isNotNull(), F.col("named")).alias("named"),
    )
    return answers.unionByName(found).select(
        "page_id",
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        "record_type",
        "refers_to",
        F.coalesce(F.col("digest") == F.col("named"), F.lit(False)).alias("digest_ok"),
    )


def archive_pages(pages: DataFrame, records_per_file: int = 100_000, path: str | None = None) -> DataFrame:
    """Write pages as archives into the shared folder (or ``path``), read them back and resolve revisits."""
    spark = pages.sparkSession
    path = path or scratch_dir(spark, "warc")
    write_warc(pages, path, records_per_file=records_per_file)
    return resolve_revisits(materialize(read_warc(spark, path), "read"))
