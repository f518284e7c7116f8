"""WARC archives as a chunked record table (operator 7).

A record with a large payload is a chain of segments: one ``response`` and ``continuation`` records after it, each a row
(record id, chunk number, data) and each a WARC record of its own in the files, by the segmentation rules of the format.
No step holds a payload that is larger than a chunk once it has left the input row, and SHA-256 is carried from chunk to chunk.
In files a record is a gzip member of its own; reading takes heads and ``Content-Length``, so it takes archives of any origin.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.arrow import column_bytes
from corpusloom.llm.common import load, new_folder, stored, width

CHUNK = 1 << 16
LEAST = 100
DATE = "2024-01-01T00:00:00Z"
END = "\r\n\r\n"
MEMBER = 1 << 23
START = "WARC/1.1\r\n"
MOST_SHARED, HOT = 100_000, 10_000
#: What stands before the payload in a response, as the format asks for.
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def originals(pages: DataFrame, least: int = LEAST, payload: str = "html", key: str = "page_id") -> DataFrame:
    """``pages`` with payload_bytes, payload_digest and refers_to: the smallest page_id of an equal payload of ``least`` bytes
    or more, or null where the row is that one or the payload is smaller.

    Digests are counted with map-side combine, and only those of several rows are joined back: broadcast up to 100,000 of them
    (counted), so that payloads aren't shuffled; beyond, over salts that follow the number of rows of a digest, so that a payload of
    a third of all rows doesn't meet in one task. Rows that repeat the smallest page_id are all originals. A null page_id
    names no record: such a row is an original, and what equals its payload refers to the smallest known page_id.
    """
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.withColumn("payload_bytes", F.octet_length(body).cast("long")).withColumn("payload_digest", F.sha2(F.encode(body, "UTF-8"), 256))
    shared = rows.where(F.col("payload_bytes") >= least).groupBy("payload_digest").agg(F.count(key).alias("_known"), F.min(key).alias("_first")).where(F.col("_known") > 1)
    shared = stored(shared, "shared")
    if shared.count() <= MOST_SHARED:
        met = rows.join(F.broadcast(shared.select("payload_digest", "_first")), "payload_digest", "left")
    else:
        hot = shared.where(F.col("_known") > HOT).select(F.col("payload_digest").alias("_hot"), F.ceil(F.col("_known") / HOT).cast("int").alias("_salts"))  # one for each 10,000 rows at most
        dealt = rows.join(hot, F.col("payload_digest") == F.col("_hot"), "left").withColumn("_salt", F.pmod(F.xxhash64(key, F.monotonically_increasing_id()), F.coalesce("_salts", F.lit(1))).cast("int")).drop("_hot", "_salts")
        spread = shared.select("payload_digest", "_first", F.explode(F.sequence(F.lit(0), F.ceil(F.col("_known") / HOT).cast("int") - 1)).alias("_salt"))
        met = dealt.join(spread, ["payload_digest", "_salt"], "left").drop("_salt")
    return met.withColumn("refers_to", F.when(F.col("_first") < F.col(key), F.col("_first"))).drop("_first")


def chunks(rows: DataFrame, chunk: int = CHUNK, payload: str = "html", key: str = "page_id", url: str = "url") -> DataFrame:
    """The chunked record table: record_id, chunk, n_chunks, data and the record's headers; revisits have one empty chunk.

    Payloads are cut after ``chunk`` bytes (four or more), less the up to three that would part a character. Chunk numbers are
    exploded, not chunks, and each is cut from the payload's bytes at its place, so no row holds an array of them.
    """
    rows = rows.withColumn("record_id", F.concat(F.lit("urn:warc:"), F.md5(F.concat_ws("|", F.col(key).cast("string"), F.col(url), F.col("payload_digest"))), F.lit("-"), F.monotonically_increasing_id().cast("string")))
    rows = rows.withColumn("_b", F.when(F.col("refers_to").isNotNull(), F.lit("")).otherwise(F.coalesce(F.col(payload), F.lit(""))).cast("binary"))
    rows = rows.withColumn("n_chunks", F.greatest(F.lit(1), F.ceil(F.octet_length("_b") / chunk).cast("int")))
    kept = rows.select("record_id", F.col(key), F.col(url), "payload_bytes", "payload_digest", "refers_to", "n_chunks", "_b", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1)).alias("chunk"))
    inside = lambda p: F.hex(F.substring("_b", p + 1, F.lit(1))).between("80", "BF")  # noqa: E731  the byte at p goes on with a character
    place = lambda p: p - F.when(~inside(p), 0).when(~inside(p - 1), 1).when(~inside(p - 2), 2).otherwise(3)
    start = F.when(F.col("chunk") == 0, 0).otherwise(place(F.col("chunk") * chunk))
    stop = F.when(F.col("chunk") == F.col("n_chunks") - 1, F.octet_length("_b")).otherwise(place((F.col("chunk") + 1) * chunk))
    return kept.withColumn("data", F.substring("_b", start + 1, stop - start).cast("string")).drop("_b")


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records as gzip members without their last byte, which is zero: it is the highest of the length, and a member holds
    8 MB at most (a longer record is several members in a row, which read as one text)."""
    for batch in batches:
        off, data = column_bytes(batch.column(0))
        out, view = [], memoryview(data)
        for a, b in zip(off[:-1], off[1:]):
            for at in range(a, b, MEMBER):
                one = zlib.compressobj(6, zlib.DEFLATED, 31)
                out.append((one.compress(view[at : min(b, at + MEMBER)]) + one.flush())[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])


def archive(table: DataFrame, key: str = "page_id", url: str = "url") -> str:
    """Write the chunk rows as ``.warc.gz`` files, one record a row and one gzip member a record, and return their folder."""
    revisit = F.col("refers_to").isNotNull()
    kind = F.when(revisit, "revisit").when(F.col("chunk") > 0, "continuation").otherwise("response")
    line = lambda name, value: F.concat(F.lit(name + ": "), value.cast("string"), F.lit("\r\n"))
    maybe = lambda when, text: F.when(when, text).otherwise(F.lit(""))
    clean = F.regexp_replace(F.coalesce(F.col(url), F.lit("")), r"[\r\n]", "%0A")
    several = F.col("n_chunks") > 1
    head = F.concat(
        F.lit(START), line("WARC-Type", kind),
        line("WARC-Record-ID", F.concat(F.lit("<"), F.col("record_id"), maybe(F.col("chunk") > 0, F.concat(F.lit("."), F.col("chunk"))), F.lit(">"))),
        line("WARC-Date", F.lit(DATE)), maybe(F.col("chunk") == 0, line("WARC-Target-URI", clean)),
        maybe(F.col(key).isNotNull(), line("X-Page-ID", F.col(key))), line("X-Payload-Length", F.col("payload_bytes")), line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        maybe(revisit, F.concat(line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), line("X-Refers-To-Page-ID", F.coalesce(F.col("refers_to").cast("string"), F.lit(""))))),
        maybe(several, F.concat(line("WARC-Segment-Number", F.col("chunk") + 1), maybe(F.col("chunk") > 0, line("WARC-Segment-Origin-ID", F.concat(F.lit("<"), F.col("record_id"), F.lit(">")))), maybe(F.col("chunk") == F.col("n_chunks") - 1, line("WARC-Segment-Total-Length", F.col("payload_bytes"))))),
        maybe(F.col("chunk") == 0, line("Content-Type", F.lit("application/http; msgtype=response"))), line("Content-Length", F.octet_length("data") + F.when(F.col("chunk") == 0, len(HTTP)).otherwise(0)), F.lit("\r\n"), maybe(F.col("chunk") == 0, F.lit(HTTP)))
    folder = new_folder(table.sparkSession, "warc")
    members = table.select(F.concat(head, F.col("data"), F.lit(END)).alias("value")).mapInArrow(_members, "value binary")
    members.select(F.col("value").cast("string")).write.option("lineSep", "\0").text(folder)  # the zero that each member ends in
    where = table.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
    files = where.getFileSystem(table.sparkSession._jsc.hadoopConfiguration())
    for f in files.listStatus(where):
        name = f.getPath().getName()
        if name.endswith(".txt"):
            files.rename(f.getPath(), f.getPath().suffix(".warc.gz"))
    return folder


class _Frames:
    """The records of one WARC stream that is fed in pieces: a head up to its empty line, then ``Content-Length`` bytes, which
    go out in parts of ``most`` bytes. It holds one part, one head and the piece at hand."""

    def __init__(self, most: int):
        self.most, self.held, self.head, self.left, self.part = most, b"", None, 0, 0

    def feed(self, piece: bytes, last: bool = False) -> Iterator[tuple]:
        """(head, part, rest, http, data) of each part that is whole; ``last`` ends the stream and gives what is there."""
        data, at = self.held + piece, 0
        while True:
            if self.head is None:
                while data[at : at + 1] in (b"\r", b"\n"):
                    at += 1
                if not b"WARC/".startswith(data[at : at + 5]):
                    raise ValueError("no WARC record where one should begin")
                end = data.find(b"\r\n\r\n", at)
                if end < 0:
                    if last and at < len(data):
                        raise ValueError("a WARC stream ends inside the head of a record")
                    break
                self.head = data[at : end + 2].decode("utf-8", "replace")
                size = re.search(r"(?im)^content-length:[ \t]*(\d+)", self.head)
                if not size:
                    raise ValueError("a WARC record without Content-Length")
                at, self.left, self.part = end + 4, int(size[1]), 0
            take = min(self.left, self.most)
            if len(data) - at < take:
                if not last:
                    break
                take = len(data) - at
            block, at, self.left = data[at : at + take], at + take, self.left - take
            http = 0
            if not self.part and block.startswith(b"HTTP/") and re.search(r"(?im)^content-type:[ \t]*application/http", self.head):
                http = block.find(b"\r\n\r\n") + 4 if b"\r\n\r\n" in block else len(block)
            yield self.head, self.part, self.left, http, block
            self.part += 1
            if not self.left or last and at == len(data):
                self.head = None
        self.held = data[at:]


def _framed(most: int):
    """Lines of files, in order, as the parts of their records."""
    schema = pa.schema([("head", pa.string()), ("part", pa.int32()), ("rest", pa.int64()), ("http", pa.int32()), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)
        now, frames = None, _Frames(most)
        for batch in batches:
            files, rows = batch.column(1).to_numpy(), []
            cuts = [0, *(np.flatnonzero(files[1:] != files[:-1]) + 1).tolist(), len(files)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                if files[a] != now:
                    rows += frames.feed(b"", last=True)
                    now, frames = files[a], _Frames(most)
                rows += frames.feed(b"\n".join(batch.column(0).slice(a, b - a).to_pylist()) + b"\n")
            if rows:
                yield pack(rows)
        rows = list(frames.feed(b"", last=True))
        if rows:
            yield pack(rows)

    return run


def framed(spark, folder: str, most: int = 5 * CHUNK) -> DataFrame:
    """Records of WARC files of any origin as rows (head, part, rest, http, data): the head's lines, the number of a part of the
    block, how many bytes follow it, how many of its first bytes are an HTTP head, and its bytes.

    Records are framed by ``Content-Length``, whatever their blocks hold, and a block of more than ``most`` bytes is several rows.
    Files come as streams of lines, so a task holds a batch of lines and one part; a single line of the file is
    the least it holds. Each file is read by one task: gzip files always are, plain ones up to ``spark.sql.files.maxPartitionBytes``;
    a larger plain file raises an error. In a stream that ends early the last part says how much is missing; one that ends in
    a head, or holds something else, raises an error. Empty files have no records.
    """
    whole = F.when(F.col("_metadata.file_block_start") > 0, F.raise_error(F.lit("a plain WARC file of more than one split: compress it")).cast("long"))
    lines = spark.read.option("lineSep", "\n").text(folder).select(F.col("value").cast("binary").alias("value"), whole.otherwise(F.xxhash64("_metadata.file_path")).alias("file"))
    return lines.mapInArrow(_framed(most), "head string, part int, rest long, http int, data binary")


def records(spark, folder: str, most: int = 5 * CHUNK) -> DataFrame:
    """Read WARC files back: kind, record_id (of the first segment), chunk, part, several, page_id, payload_bytes,
    payload_digest, refers_to, url and data (the payload's bytes as text). What ``archive`` writes is one part a record. In
    archives of other origin page_id, payload_bytes and refers_to are null, and payload_digest is what stands in the head."""
    raw = framed(spark, folder, most).withColumn("head", F.concat(F.lit("\r\n"), F.col("head")))
    field = lambda name: F.nullif(F.regexp_extract("head", rf"(?i)\r\n{name}:[ \t]*([^\r]*)", 1), F.lit(""))
    number = field("WARC-Segment-Number").cast("int")
    return raw.select(
        field("WARC-Type").alias("kind"), F.coalesce(field("WARC-Segment-Origin-ID"), field("WARC-Record-ID")).alias("record_id"), (F.coalesce(number, F.lit(1)) - 1).alias("chunk"), "part",
        (number.isNotNull() | (F.col("part") > 0) | (F.col("rest") > 0)).alias("several"), field("X-Page-ID").cast("long").alias("page_id"), field("X-Payload-Length").cast("long").alias("payload_bytes"),
        F.substring_index(field("WARC-Payload-Digest"), ":", -1).alias("payload_digest"), field("X-Refers-To-Page-ID").cast("long").alias("refers_to"), field("WARC-Target-URI").alias("url"),
        F.substring("data", F.col("http") + 1, F.octet_length("data")).cast("string").alias("data"))


def _digesting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of a record come in order: carry its SHA-256 and length; a row goes out when the next record begins."""
    last, sha, size, page = None, None, 0, None
    schema = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])
    for batch in batches:
        off, data = column_bytes(batch.column(2))
        view = memoryview(data)
        out: list[tuple] = []
        for i, (record, number) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            if record != last:
                if last is not None:
                    out.append((last, page, size, sha.hexdigest()))
                last, sha, size, page = record, hashlib.sha256(), 0, number
            sha.update(view[off[i] : off[i + 1]])
            size += int(off[i + 1] - off[i])
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)] if out else [pa.array([], f.type) for f in schema], schema=schema)
    if last is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((last, page, size, sha.hexdigest()), schema)], schema=schema)


def digests(found: DataFrame) -> DataFrame:
    """record_id, page_id, payload_bytes, payload_digest, record_type and refers_to of ``records``: of responses from their bytes,
    of revisits from their heads. Records of one row stay where they were read; only the rows of larger ones are brought
    together and ordered, and pass as a stream."""
    told = F.col("kind") == "revisit"
    one = found.where(F.col("kind").isin("response", "revisit") & ~F.col("several")).select(
        "record_id", "page_id", F.when(told, F.col("payload_bytes")).otherwise(F.octet_length("data").cast("long")).alias("payload_bytes"),
        F.when(told, F.col("payload_digest")).otherwise(F.sha2(F.col("data").cast("binary"), 256)).alias("payload_digest"), F.col("kind").alias("record_type"), "refers_to")
    many = found.where(F.col("kind").isin("response", "continuation") & F.col("several")).select("record_id", "page_id", "data", "chunk", "part")
    many = many.repartition(width(found.sparkSession), "record_id").sortWithinPartitions("record_id", "chunk", "part")
    many = many.mapInArrow(_digesting, "record_id string, page_id long, payload_bytes long, payload_digest string")
    return one.unionAll(many.select("*", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to")))


def op7_warc(spark, sf_dir: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every page, from archives written and read back.

    The five columns of a response come from its chunks, those of a revisit from its headers. Null html is an empty payload,
    a null url an empty target; repeated rows are records of their own; other columns aren't read; no page, no record.
    """
    table = chunks(originals(load(spark, sf_dir, "pages").select("page_id", "url", "html")))
    return digests(records(spark, archive(table))).drop("record_id")


SQL = """
with p as (select page_id, coalesce(html, '') as body from pages),
q as (select page_id, octet_length(encode(body))::bigint as payload_bytes, sha256(body) as payload_digest from p),
r as (select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) end as first_id from q)
select page_id, payload_bytes, payload_digest, case when first_id < page_id then 'revisit' else 'response' end as record_type,
  case when first_id < page_id then first_id end as refers_to from r
"""
