"""Fixity audit of WARC archives by Merkle trees.

Records lie in volumes, compressed files, at ordered offsets. They are read back from the files by the
lengths in their headers. A leaf hashes a record's place and content; a node hashes the digests of up
to 16 neighbours, in order, with the byte range that they span. Two replicas compare roots, then
descend level by level into mismatching nodes only, down to the damaged records.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recontact.sources.storage import delete, fresh_path, release, written_once

FAN = 16
VOLUME_BYTES = 8 << 20
END = "\r\n\r\n"
_LENGTH = re.compile(rb"^Content-Length: ([0-9]{1,18})$", re.MULTILINE)
_PAGE = re.compile(rb"^WARC-Record-ID: <urn:page:(-?[0-9]{1,19})>\r$", re.MULTILINE)


def record_text(page_id: Column, uri: Column, payload: Column) -> Column:
    """A WARC/1.1 resource record with its closing blank lines; nulls are empty. Line ends in an address
    become spaces, as they would end the header."""
    body = F.coalesce(payload, F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.translate(F.coalesce(uri, F.lit("")), "\r\n", "  "),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit(END),
    )
    return F.concat(head, body, F.lit(END))


def volume_count(pages: DataFrame, volume_bytes: int = VOLUME_BYTES) -> int:
    total = pages.agg(F.sum(F.octet_length("html").cast("long"))).first()[0]
    return max(1, -(-(total or 0) // volume_bytes))


def _number(*parts: Column) -> Column:
    """52 bits of the MD5 of the parts; nulls are empty."""
    key = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long")


def volume_of(volumes: int) -> Column:
    """Volume of a page by a hash of id, address and content, so copies spread."""
    own = _number(F.col("page_id"), F.col("url"), F.md5(F.coalesce("html", F.lit(""))))
    return F.pmod(own, F.lit(volumes)).cast("int")


def write_archive(pages: DataFrame, path: str, volumes: int, decayed: bool = False) -> None:
    """The archive as WARC files, one folder ``volume=N`` for each, compressed.

    Order within a volume is by page id, nulls first, then digest. Repeated rows are records of their
    own. With ``decayed`` a replica that has suffered: the first byte of a hundredth of the bodies is
    another one, in every seventh volume a hundredth has grown by a byte, which moves what lies
    behind, and every fifth volume has lost its last record. Which, hashes of the page ids tell.
    """
    rows = pages.select("page_id", "url", "html", volume_of(volumes).alias("volume"))
    rows = rows.withColumn("digest", F.sha2(record_text(F.col("page_id"), F.col("url"), F.col("html")), 256))
    rows = rows.repartition(volumes, "volume")
    if decayed:
        last = F.row_number().over(Window.partitionBy("volume").orderBy(F.desc("page_id"), F.desc("digest")))
        rows = rows.withColumn("_last", last).filter("NOT (volume % 5 = 0 AND _last = 1)").drop("_last")
        body = F.when(rotten(), F.concat(F.lit(">"), F.expr("substring(html, 2)"))).otherwise(F.col("html"))
        rows = rows.withColumn("html", F.when(grown(), F.concat(F.coalesce(body, F.lit("")), F.lit("x"))).otherwise(body))
    # The writer adds the closing blank lines.
    bare = F.expr("substring(record, 1, length(record) - 4)")
    rows = rows.withColumn("record", record_text(F.col("page_id"), F.col("url"), F.col("html")))
    rows = rows.sortWithinPartitions("volume", "page_id", "digest").select("volume", bare.alias("value"))
    rows.write.option("lineSep", END).option("compression", "gzip").partitionBy("volume").text(path)


def rotten() -> Column:
    own = F.pmod(_number(F.concat(F.lit("rot"), F.col("page_id").cast("string"))), F.lit(101)) == 7
    return F.col("page_id").isNotNull() & own & F.col("html").startswith("<")


def grown() -> Column:
    own = F.pmod(_number(F.concat(F.lit("grow"), F.col("page_id").cast("string"))), F.lit(101)) == 9
    return F.col("page_id").isNotNull() & own & (F.col("volume") % 7 == 3)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Records of the WARC files at ``path``: ``volume``, ``seq``, ``page_id``, ``start``, ``end`` and ``digest``.

    Offsets are those of the uncompressed volume. A record ends where its header says; bytes that are
    no record, or one that ends beyond the file, are one last record without page id. A volume is read
    whole by one task, so memory is bounded by the size of a volume or of a larger single record.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.gz").option("recursiveFileLookup", "true").load(path)
    files = files.select(F.regexp_extract("path", "volume=([0-9]+)", 1).cast("int").alias("volume"), "content")
    names = ["volume", "seq", "page_id", "start", "end", "digest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for volume, blob in zip(batch["volume"].to_pylist(), batch["content"], strict=True):
                rows = list(records_of(zlib.decompress(blob.as_py(), wbits=31)))
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
                page, start, end, digest = (pa.array(c, k) for c, k in zip(columns, kinds, strict=True))
                first = [pa.array([volume] * len(rows), pa.int32()), pa.array(range(len(rows)), pa.int64())]
                yield pa.RecordBatch.from_arrays([*first, page, start, end, digest], names=names)

    return files.mapInArrow(run, "volume int, seq long, page_id long, start long, end long, digest string")


def records_of(data: bytes) -> Iterator[tuple[int | None, int, int, str]]:
    """Page id, range and digest of each record of a volume."""
    start = 0
    while start < len(data):
        body = data.find(b"\r\n\r\n", start)
        head = data[start:body] + b"\r" if body >= 0 else b""
        size = _LENGTH.search(head.replace(b"\r", b"")) if head.startswith(b"WARC/") else None
        end = body + 8 + int(size[1]) if size else len(data) + 1
        page = _PAGE.search(head) if end <= len(data) else None
        end = min(end, len(data))
        yield int(page[1]) if page else None, start, end, hashlib.sha256(data[start:end]).hexdigest()
        start = end


def leaves(records: DataFrame) -> DataFrame:
    """Level 0 of the trees: a node for each record, its hash over range and content."""
    digest = F.sha2(F.concat_ws("|", F.lit("leaf"), "start", "end", "digest"), 256)
    return records.select("volume", F.col("seq").alias("node"), "start", "end", digest.alias("digest"))


def parents(level: DataFrame) -> DataFrame:
    """The nodes above: up to ``FAN`` neighbours each, so a group is bounded."""
    child = F.struct("node", "digest")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(child)), lambda c: c["digest"]), "")
    rows = level.groupBy("volume", F.floor(F.col("node") / FAN).alias("parent")).agg(
        F.min("start").alias("start"), F.max("end").alias("end"), joined.alias("_all")
    )
    digest = F.sha2(F.concat_ws("|", F.lit("node"), "start", "end", "_all"), 256)
    return rows.select("volume", F.col("parent").alias("node"), "start", "end", digest.alias("digest"))


def tree(records: DataFrame, depth: int) -> list[DataFrame]:
    """Levels of the volume trees from the leaves to the volumes' roots, one node each at the top."""
    levels = [leaves(records)]
    for _ in range(depth):
        # Written, so plans stay short; a level has a sixteenth of the nodes below.
        levels.append(written_once(parents(levels[-1]), "nodes"))
    return levels


def roots(level: DataFrame, volumes: int) -> list[DataFrame]:
    """Levels above the volumes' roots up to the one root of the archive."""
    above = [level.select(F.lit(0).alias("volume"), F.col("volume").cast("long").alias("node"), F.lit(0).cast("long").alias("start"), F.col("end"), "digest")]
    width = volumes
    while width > 1:
        above.append(written_once(parents(above[-1]), "nodes"))
        width = -(-width // FAN)
    return above


def depth_of(records: DataFrame) -> int:
    """Levels above the leaves until every volume has one node."""
    most = records.agg(F.max("seq")).first()[0] or 0
    depth = 1
    while FAN**depth <= most:
        depth += 1
    return depth


def _differing(left: DataFrame, right: DataFrame, within: DataFrame | None) -> DataFrame:
    """Nodes whose digests differ or that one side lacks; below mismatching parents only."""
    key = ["volume", "node"]
    if within is not None:
        up = within.select("volume", F.col("node").alias("parent"))

        def below(level: DataFrame) -> DataFrame:
            parent = F.floor(F.col("node") / FAN)
            return level.withColumn("parent", parent).join(up, ["volume", "parent"], "left_semi").drop("parent")

        left, right = below(left), below(right)
    a = left.select(*key, F.col("digest").alias("_a"))
    b = right.select(*key, F.col("digest").alias("_b"))
    return a.join(b, key, "full").filter(~F.col("_a").eqNullSafe(F.col("_b"))).select(*key)


def audit(left: DataFrame, right: DataFrame, volumes: int) -> DataFrame:
    """Records of ``left`` and ``right`` that differ: ``volume``, ``seq`` and ``status``.

    ``status`` is ``corrupt`` where both have the record with other content, ``moved`` where the content is
    the same at another place, ``missing`` where the right replica lacks it, ``extra`` where the left one
    does. Equal archives, and empty ones, give no rows. Each level of a descent joins mismatching nodes
    with their children only.
    """
    depth = max(depth_of(left), depth_of(right))
    a, b = tree(left, depth), tree(right, depth)
    found = None
    above = [roots(a[-1], volumes), roots(b[-1], volumes)]
    for x, y in reversed(list(zip(*above, strict=True))):
        found = written_once(_differing(x, y, found), "mismatches")
    # Nodes of the lowest upper level are volumes; their roots have number 0.
    found = found.select(F.col("node").cast("int").alias("volume"), F.lit(0).cast("long").alias("node"))
    for x, y in reversed(list(zip(a[:-1], b[:-1], strict=True))):
        found = written_once(_differing(x, y, found), "mismatches")
    release(*a[1:], *b[1:], *above[0][1:], *above[1][1:])
    here = left.select("volume", F.col("seq").alias("node"), F.col("digest").alias("l"))
    there = right.select("volume", F.col("seq").alias("node"), F.col("digest").alias("r"))
    told = found.join(here, ["volume", "node"], "left").join(there, ["volume", "node"], "left")
    status = (
        F.when(F.col("r").isNull(), "missing").when(F.col("l").isNull(), "extra")
        .when(F.col("l") == F.col("r"), "moved").otherwise("corrupt")
    )
    return told.select("volume", F.col("node").alias("seq"), status.alias("status"))


def audited_pages(pages: DataFrame) -> DataFrame:
    """Every record of an archive of ``pages``, read from its files, and what the audit says of a replica.

    Both replicas are written as WARC files in the shared folder and read back; the second one has
    decayed. The files go once they are read.
    """
    spark, pages = pages.sparkSession, pages.select("page_id", "url", "html")
    volumes = volume_count(pages)
    read = []
    for decayed in (False, True):
        path = fresh_path(spark, "warc")
        write_archive(pages, path, volumes, decayed)
        read.append(written_once(read_archive(spark, path), "records"))
        delete(spark, path)
    told = audit(*read, volumes)
    status = F.coalesce("status", F.lit("intact")).alias("status")
    return read[0].join(told, ["volume", "seq"], "left").select(
        "page_id", "volume", "seq", "start", "end", "digest", status
    )


def audit_sql(volume_bytes: int = VOLUME_BYTES, volumes_of: str = "pages") -> str:
    """The same in DuckDB, by comparing every record."""
    line = "chr(13) || chr(10)"
    record = (
        f"'WARC/1.1' || {line} || 'WARC-Type: resource' || {line} || 'WARC-Record-ID: <urn:page:' || coalesce(page_id::VARCHAR, '') "
        f"|| '>' || {line} || 'WARC-Target-URI: ' || translate(coalesce(url, ''), {line}, '  ') || {line} || 'Content-Type: text/html' "
        f"|| {line} || 'Content-Length: ' || strlen(coalesce(html, '')) || repeat({line}, 2) || coalesce(html, '') || repeat({line}, 2)"
    )
    number = "CAST('0x' || substr(md5({}), 1, 13) AS BIGINT)"
    place = "coalesce(page_id::VARCHAR, '') || '|' || coalesce(url, '') || '|' || md5(coalesce(html, ''))"
    return f"""
WITH v AS (SELECT greatest(1, ceil(coalesce(sum(strlen(html)), 0) / {volume_bytes}.0))::BIGINT AS n FROM {volumes_of}),
r AS (SELECT page_id, html, ({number.format(place)} % (SELECT n FROM v))::INT AS volume, {record} AS rec FROM {volumes_of}),
d AS (SELECT *, strlen(rec)::BIGINT AS size, sha256(rec) AS digest, strlen(coalesce(html, ''))::BIGINT AS body,
    coalesce(html LIKE '<%' AND {number.format("'rot' || page_id")} % 101 = 7, false) AS rotten,
    coalesce(volume % 7 = 3 AND {number.format("'grow' || page_id")} % 101 = 9, false) AS grown FROM r),
o AS (SELECT *, row_number() OVER w - 1 AS seq, sum(size) OVER w AS stop, lead(1) OVER w IS NULL AS last,
    count_if(grown) OVER w > grown::INT AS moved FROM d
  WINDOW w AS (PARTITION BY volume ORDER BY page_id NULLS FIRST, digest ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT page_id, volume, seq::BIGINT AS seq, (stop - size)::BIGINT AS "start", stop::BIGINT AS "end", digest,
  CASE WHEN last AND volume % 5 = 0 THEN 'missing' WHEN rotten OR grown THEN 'corrupt' WHEN moved THEN 'moved' ELSE 'intact' END AS status
FROM o"""
