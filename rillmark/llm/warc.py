"""Web archives: write records, keep an index of where each lies, read chosen records back by byte range.

Every record is a gzip member of its own, so any of them can be read alone. The index row of a record (file, offset, length, url,
digest) is the only thing that makes it part of the archive: a task that is run again writes files of new names, and files of
which no index row tells are no part of it. Readers sort the chosen index rows by place and join near ones into one read.

Defined cases: a null payload counts as empty; a null url is left out of the record; of rows that repeat the largest id among equal
payloads all are responses, and payloads seen only with null ids too; an empty table writes nothing and reads back no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.session import work_path

from .common import map_frames, staged

HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "file string, offset long, length long, url string, digest string, record_type string, page_id long"
RECORD = "file string, offset long, page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"


def store(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a folder all executors can reach, and the path there."""
    return arrow_fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", re.sub("^file:/(?!/)", "file:///", uri)))


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record as a gzip member; a revisit has the payload's length and digest, but not the payload."""
    name = "" if page_id is None else page_id
    revisit = refers_to is not None
    block = HTTP if revisit else HTTP + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:x-page:{name}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url))
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}"]
    if revisit:
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    pack = zlib.compressobj(5, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + pack.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of one record."""
    head, _, rest = zlib.decompress(member, 31).partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def decide(pages: DataFrame, least: int = 0) -> DataFrame:
    """Pages with the id they revisit: of equal payloads of at least ``least`` bytes all but that with the largest id."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("same", F.when(F.octet_length("payload") >= least, F.sha2("payload", 256)))
    newest = rows.where("same is not null").groupBy("same").agg(F.max("page_id").alias("newest"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    # Structs built right before the join: both sides are plain shuffles, and the runtime can split the rows of a payload that many pages have.
    newest = newest.select(F.struct("same").alias("known"), "newest")
    joined = rows.withColumn("key", F.struct("same")).join(newest, F.col("key") == F.col("known"), "left")
    return joined.select("page_id", "url", "payload", F.when(F.expr("newest is not null and not (page_id <=> newest)"), F.col("newest")).alias("refers_to"))


def write(rows: DataFrame, folder: str, date: str = "2020-01-01T00:00:00Z", most: int = 256 << 20) -> DataFrame:
    """Write the rows of ``decide`` to archives below ``folder``, at most about ``most`` bytes each; the staged index."""

    def run(batches):
        fs, path = store(folder)
        fs.create_dir(path)
        name, out, at = None, None, 0
        for pdf in batches:
            index = []
            for page_id, url, payload, refers_to in zip(pdf["page_id"], pdf["url"], pdf["payload"], pdf["refers_to"]):
                if out is None or at >= most:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{path}/{name}", compression=None)
                page_id = None if pd.isna(page_id) else int(page_id)
                refers_to = None if pd.isna(refers_to) else int(refers_to)
                payload, digest = bytes(payload), base32_sha1(payload)
                member = record(page_id, url, payload, digest, refers_to, date)
                out.write(member)
                index.append((name, at, len(member), url, digest, "response" if refers_to is None else "revisit", page_id))
                at += len(member)
            yield pd.DataFrame(index, columns=["file", "offset", "length", "url", "digest", "record_type", "page_id"], dtype=object)
        if out is not None:
            out.close()

    return staged(map_frames(rows, run, INDEX), "warc-index")


def runs(places: list[tuple[str, int, int]], gap: int, most: int) -> Iterator[list[tuple[str, int, int]]]:
    """Sorted places cut where the file changes, a gap is wide or a read would get long."""
    run: list[tuple[str, int, int]] = []
    for p in places:
        if run and (p[0] != run[0][0] or p[1] - (run[-1][1] + run[-1][2]) > gap or p[1] + p[2] - run[0][1] > most):
            yield run
            run = []
        run.append(p)
    if run:
        yield run


def read(index: DataFrame, folder: str, gap: int = 64 << 10, most: int = 8 << 20, payload: bool = True) -> DataFrame:
    """The records of the given index rows, in place order within a task; each payload is held against its digest.

    With ``payload`` false the payload is still read and checked but not handed on.
    """

    def run(batches):
        fs, path = store(folder)
        for pdf in batches:
            out = []
            for near in runs(list(zip(pdf["file"], pdf["offset"], pdf["length"])), gap, most):
                name, start = near[0][0], near[0][1]
                with fs.open_input_file(f"{path}/{name}") as file:
                    data = file.read_at(near[-1][1] + near[-1][2] - start, start)
                for _, offset, length in near:
                    fields, body = parse(data[offset - start : offset - start + length])
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    size = int(fields["X-Payload-Length"])
                    if fields["WARC-Type"] == "response" and (digest != base32_sha1(body) or size != len(body)):
                        raise ValueError(f"damaged record in {name} at {offset}")
                    number = {k: int(v) if (v := fields.get(k, "").removeprefix("<urn:x-page:").removesuffix(">")) else None for k in ("WARC-Record-ID", "WARC-Refers-To")}
                    out.append((name, offset, number["WARC-Record-ID"], fields.get("WARC-Target-URI"), fields["WARC-Type"], number["WARC-Refers-To"], size, digest, body))
            got = pd.DataFrame(out, columns=["file", "offset", "page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"], dtype=object)
            yield got if payload else got.drop(columns="payload")

    # Index rows are small, what they stand for is not: the number of tasks follows the bytes to read.
    spark = index.sparkSession
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // (64 << 20) + 1)
    places = index.select("file", "offset", "length").repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return map_frames(places, run, RECORD + (", payload binary" if payload else ""))


def archive(spark: SparkSession, pages: DataFrame, least: int = 0) -> tuple[DataFrame, str]:
    """Archive the pages in a new folder; the index and the folder."""
    folder = work_path(spark, "llm-warc")
    return write(decide(pages, least), folder), folder
