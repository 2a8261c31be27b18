"""WARC archives with revisit records instead of repeated payloads.

Every record is a gzip member of its own, so it can be read alone by its file, offset and length, which the
index holds. A task writes one archive under another name and renames it when it is whole, so a repeated task leaves one file.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import math
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakecat.llm.common import batches, text_or_empty
from lakecat.llm.token_files import store
from lakecat.session import fresh_path, written

END = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payload bytes of one archive file, before compression. A larger payload has a file of its own size.
FILE_BYTES = 16 << 20
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload string"


def with_roles(headers: DataFrame, least_bytes: int = 100) -> DataFrame:
    """Headers (page_id, payload_digest, payload_bytes, ...) with record_type and refers_to.

    Only digests that occur twice with `least_bytes` or more are shuffled back to their headers, so a
    hot payload costs one row per task in the count and AQE may split it in the join. The
    smallest page_id of a digest is the response. Rows without a page_id are responses. Of
    rows with the response's page_id all are responses.
    """
    repeated = (
        headers.filter((F.col("payload_bytes") >= least_bytes) & F.col("page_id").isNotNull())
        .groupBy("payload_digest").agg(F.min("page_id").alias("original"), F.count("*").alias("copies"))
        .filter("copies > 1").drop("copies")
    )
    revisit = F.col("original").isNotNull() & (F.col("page_id") > F.col("original"))
    return (
        headers.join(repeated, "payload_digest", "left")
        .withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(revisit, F.col("original"))).drop("original")
    )


def one_line(value: Column) -> Column:
    """A header value with control characters percent-encoded."""
    for code in (37, 10, 13):
        value = F.replace(value, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return value


def record_text() -> Column:
    """A record up to its closing line ends, from the columns of `with_roles` plus url and payload."""
    def urn(column: str) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit("none")), F.lit(">"))

    revisit = F.col("record_type") == "revisit"
    block = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), urn("page_id")),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z"),
        F.concat(F.lit("WARC-Target-URI: "), one_line(F.col("url"))),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("payload_digest")),
        F.concat(F.lit("X-Payload-Length: "), F.col("payload_bytes").cast("string")),
        F.when(revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), urn("refers_to"))),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    return F.concat(F.concat_ws(END, *lines), F.lit(END + END), block)


def write_archives(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", body: str = "html", least_bytes: int = 100,
) -> DataFrame:
    """Write gzipped archives of `pages` below `path`, each distinct payload once; the index of their records.

    The index is a written table: page_id, file (its name below `path`), offset, length, of the compressed record.
    Headers are written first and given their roles by digest; the pages then meet their role by
    (digest, key). A null body is an empty payload; a null url leaves its header out; other
    columns are left alone. Repeated rows are records of their own.
    """
    payload = text_or_empty(body)
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload"),
        F.sha2(payload, 256).alias("payload_digest"), F.octet_length(payload).cast("long").alias("payload_bytes"))
    headers = written(rows.drop("payload", "url"), "warc-headers")
    roles = written(
        with_roles(headers, least_bytes).filter("record_type = 'revisit'")
        .select("page_id", "payload_digest", "record_type", "refers_to").distinct(), "warc-revisits")
    total = headers.agg(F.sum("payload_bytes")).first()[0] or 0
    files = max(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / FILE_BYTES))
    typed = rows.join(roles, ["page_id", "payload_digest"], "left").withColumn(
        "record_type", F.coalesce("record_type", F.lit("response")))
    folder, name = store(path)
    folder.create_dir(name, recursive=True)  # also where there is no record
    records = typed.select(
        "page_id", record_text().alias("value"), F.xxhash64("page_id", "url", "payload_digest").alias("spread"))

    def write(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        file, at, out = f"archive-{TaskContext.get().partitionId():06d}.warc.gz", 0, None
        for batch in batches(found, 4 << 20):
            if out is None:
                where, name = store(f"{path}/{file}")
                where.create_dir(name.rsplit("/", 1)[0], recursive=True)
                draft = f"{name}.{uuid.uuid4().hex}.draft"
                out = where.open_output_stream(draft)
            sizes = []
            for value in batch.column("value").cast(pa.binary()):
                member = gzip.compress(value.as_py() + (END + END).encode(), 6, mtime=0)
                out.write(member)
                sizes.append(len(member))
            offsets = [at]
            for size in sizes:
                offsets.append(offsets[-1] + size)
            at = offsets.pop()
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), pa.array([file] * len(sizes)), pa.array(offsets, pa.int64()), pa.array(sizes, pa.int64())],
                names=["page_id", "file", "offset", "length"])
        if out is not None:
            out.close()
            where.move(draft, name)

    return written(records.repartition(files, "spread").select("page_id", "value").mapInArrow(
        write, "page_id long, file string, offset long, length long"), "warc-index")


def parse_records(data: bytes) -> Iterator[dict]:
    """The records of one archive, by their Content-Length."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(data)), 1 << 20)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(": ")
            fields[name] = value
        size = int(fields["Content-Length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("an archive ends within a record")
        yield fields | {"block": block}


def page_number(urn: str | None) -> int | None:
    value = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(value) if value and value != "none" else None


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below `path`, as `RECORDS`; a revisit has no payload of its own.

    The digest of a response is computed from its block and must be the one in its header.
    """
    def read(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
            ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.string())])
        for batch in found:
            for content in batch.column("content"):
                rows, held = [], 0
                for record in parse_records(content.as_py()):
                    digest = record["WARC-Payload-Digest"].removeprefix("sha256:")
                    kept = record["WARC-Type"] == "response"
                    if kept and hashlib.sha256(record["block"]).hexdigest() != digest:
                        raise ValueError(f"payload of {record['WARC-Record-ID']} differs from its digest")
                    uri = record.get("WARC-Target-URI")
                    for code in (13, 10, 37):
                        uri = uri and uri.replace(f"%{code:02X}", chr(code))
                    rows.append({
                        "page_id": page_number(record["WARC-Record-ID"]), "url": uri, "record_type": record["WARC-Type"],
                        "refers_to": page_number(record.get("WARC-Refers-To")), "payload_digest": digest,
                        "payload_bytes": len(record["block"]) if kept else int(record["X-Payload-Length"]),
                        "payload": record["block"].decode() if kept else None})
                    held += len(record["block"])
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(read, RECORDS)


def read_record(path: str, file: str, offset: int, length: int) -> dict:
    """One record by its place in the index: only its own bytes are read."""
    where, name = store(f"{path}/{file}")
    with where.open_input_file(name) as archive:
        return next(parse_records(archive.read_at(length, offset)))


def resolve(records: DataFrame, *taken: str) -> DataFrame:
    """`records` (a written table, or cheap to compute twice) with the columns `taken` of every revisit from its response.

    A revisit meets its response by (refers_to, payload_digest); one without a response fails the job.
    Only those columns and the keys are shuffled, and a hot response is one row.
    """
    originals = records.filter("record_type = 'response' AND page_id IS NOT NULL").select(
        F.col("page_id").alias("refers_to"), "payload_digest", *[F.col(c).alias(f"_own_{c}") for c in taken],
        F.lit(True).alias("_found")).dropDuplicates(["refers_to", "payload_digest"])
    revisit = F.col("record_type") == "revisit"
    lost = F.raise_error(F.concat(F.lit("no response for the revisit of page "), F.coalesce(F.col("refers_to").cast("string"), F.lit("none"))))
    joined = records.join(originals, ["refers_to", "payload_digest"], "left")
    kept = [c for c in records.columns if c not in taken]
    return joined.select(*kept, *[
        F.when(revisit, F.when(F.col("_found"), F.col(f"_own_{c}")).otherwise(lost)).otherwise(F.col(c)).alias(c) for c in taken])


def round_trip(pages: DataFrame, payloads: bool = True, **options) -> DataFrame:
    """Write `pages` to new archives in the shared folder and read their records back, `RECORDS`.

    The length of a revisit's payload, and with `payloads` the payload too, come from the response that it refers to, not from its header.
    """
    path = fresh_path(pages.sparkSession, "warc")
    write_archives(pages, path, **options)
    read = read_archives(pages.sparkSession, path)
    if not payloads:
        return resolve(written(read.drop("payload"), "warc-records"), "payload_bytes")
    return resolve(read, "payload_bytes", "payload")
