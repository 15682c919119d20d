"""A deterministic, sharded WARC writer, and a reader.

``write_warc`` deals pages to shards by ranges of their id and sorts each shard, so the
archives hold all records in id order. The ranges come from a sample of the ids that depends
on the ids alone; every record's headers and digests are made anew from its page, its date is
a parameter and its record id a function of page and payload: the same pages give the same
bytes, whatever the cluster. A shard's files roll over by compressed size.

Commit: tasks write under ``_temporary/<attempt>``; the rows of the attempts that succeeded
name their files; a second job renames those to their final names (a repeated rename is
harmless) and the manifest is written last. Readers go by the manifest, so a failed or
speculative attempt's file is never seen.

Revisits: of pages with equal payloads of ``revisit_bytes`` or more, the largest id holds the
payload. Payload groups are found with partial aggregates over digests, and the few notes
about revisits travel to the shards beside the pages: html is shuffled once.

Defined results: a null html is an empty payload; rows with a null id are responses and come
first; repeated rows with the largest id of their group are each a response; a null url is
left out of the headers; an empty table makes a manifest without files; further columns are
ignored.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qalens.llm._shared import materialise
from qalens.llm._text import text_parts, tidy
from qalens.session import shared_dir

REVISIT_BYTES = 1000
SHARD_BYTES = 32 << 20
FILE_BYTES = 8 << 20
DATE = "2000-01-01T00:00:00Z"
#: Sampled ids per shard, for the shards' ranges, and the most shards: beyond, shards grow (their
#: files do not), so that what the driver holds does not depend on the data's size.
SAMPLE, MAX_SHARDS = 32, 1 << 14
_READ = 1 << 20
_OUT = 4 << 20


def _fs(uri: str):
    """The store behind a path, from the driver or any executor, and the path within it."""
    from pyarrow import fs

    if re.match(r"file:/+", uri):
        uri = "/" + re.sub(r"^file:/+", "", uri)
    return fs.FileSystem.from_uri(uri)


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:{digest}')}>"


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *[f"{k}: {v}" for k, v in headers], f"Content-Length: {len(block)}", "", ""]
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + squeeze.flush()


def _http(size: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()


def _clean(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url)


def _id_header(page: str) -> str:
    """An id as a header value: what could end or trim the line is written as %XX."""
    return re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m.group()):02X}", page)


def _id(header: str | None) -> str | None:
    return None if header is None else unquote(header)


def page_record(page: str | None, url: str | None, payload: bytes, refers_to: str | None, date: str = DATE) -> bytes:
    """One gzip member: a response, or a revisit of the page ``refers_to``."""
    digest = _digest(payload)
    name = "" if page is None else page
    head, block = [("WARC-Type", "response" if refers_to is None else "revisit")], _http(len(payload))
    head += [("WARC-Record-ID", _record_id(name, digest)), ("WARC-Date", date)]
    if url is not None:
        head.append(("WARC-Target-URI", _clean(url)))
    if refers_to is None:
        block += payload
    else:
        head += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", _record_id(refers_to, digest)),
            ("X-Refers-To-Page", _id_header(refers_to)),
        ]
    head += [("WARC-Payload-Digest", digest), ("WARC-Block-Digest", _digest(block)), ("X-Payload-Length", str(len(payload)))]
    if page is not None:
        head.append(("X-Page", _id_header(page)))
    head.append(("Content-Type", "application/http; msgtype=response"))
    return _member(head, block)


def _info(name: str, date: str) -> bytes:
    body = f"software: qalens\r\nformat: WARC File Format 1.1\r\nisPartOf: {name}\r\n".encode()
    head = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id(name, "info")), ("WARC-Date", date)]
    return _member([*head, ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], body)


def _shard_of(page: Column, bounds: list) -> Column:
    """How many bounds are at most ``page``, in two steps of about the root of their number."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    blocks = [bounds[i : i + step] for i in range(0, len(bounds), step)]

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b <= page))

    whole = F.greatest(below(F.lit([b[0] for b in blocks])) - 1, F.lit(0))
    inner = F.array(*[F.lit(b) for b in blocks])
    return F.when(page.isNull(), F.lit(0)).otherwise(whole * step + below(F.get(inner, whole)))


def _bounds(sized: DataFrame, shard_bytes: int) -> list:
    """Ids at which shards begin, so that each holds about ``shard_bytes``.

    The sample holds about ``SAMPLE`` ids per shard, those with the least remainder of a hash:
    the same ids on every run. Only the ranges depend on it; every row is written.
    """
    rows, size = sized.agg(F.count("*"), F.coalesce(F.sum("payload_bytes"), F.lit(0))).first()
    shards = min(-(-int(size) // shard_bytes), MAX_SHARDS)
    if shards <= 1:
        return []
    every = max(1, rows // (SAMPLE * shards))
    sample = (
        sized.where("page IS NOT NULL")
        .where(F.pmod(F.xxhash64("page"), F.lit(every)) == 0)
        .groupBy("page").agg(F.sum("payload_bytes").alias("weight")).orderBy("page")
    ).collect()
    if not sample:
        return []
    total = np.cumsum([r["weight"] + 1 for r in sample])
    at = {bisect.bisect_left(total, total[-1] * k / shards) for k in range(1, shards)}
    return sorted({sample[i]["page"] for i in at if i})


def _revisits(sized: DataFrame, revisit_bytes: int) -> DataFrame:
    """``(page, payload_key, refers_to)`` of every page whose payload another page holds."""
    large = sized.where((F.col("payload_bytes") >= revisit_bytes) & F.col("page").isNotNull())
    groups = large.groupBy("payload_key").agg(F.count("*").alias("n"), F.max("page").alias("holder")).where("n > 1")
    return (
        large.join(groups, "payload_key").where("page <> holder")
        .select("page", "payload_key", F.col("holder").cast("string").alias("refers_to")).distinct()
    )


_MANIFEST = "shard int, file int, written string, name string, records long, bytes long, sha1 string"


def write_warc(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    shard_bytes: int = SHARD_BYTES,
    file_bytes: int = FILE_BYTES,
    revisit_bytes: int = REVISIT_BYTES,
    date: str = DATE,
) -> DataFrame:
    """Write the pages under ``path`` and return the manifest (also in ``path/_manifest``)."""
    body = F.coalesce(F.col(html), F.lit(""))
    records = pages.select(
        F.col(page_id).alias("page"), F.col(url).alias("url"), body.alias("html"),
        F.sha2(body, 256).alias("payload_key"), F.octet_length(body).cast("bigint").alias("payload_bytes"),
    )
    sized = records.select("page", "payload_key", "payload_bytes")
    bounds = _bounds(sized, shard_bytes)
    notes = _revisits(sized, revisit_bytes).select(
        "page", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), "payload_key", F.lit(0).alias("kind"), "refers_to"
    )
    both = notes.union(records.select("page", "url", "html", "payload_key", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("refers_to")))
    dealt = (
        both.withColumn("shard", _shard_of(F.col("page"), bounds))
        .repartitionById(len(bounds) + 1, F.col("shard"))
        .sortWithinPartitions("shard", "page", "payload_key", "kind", "url")
        .select("shard", F.col("page").cast("string").alias("page"), "payload_key", "kind", "refers_to", "url", "html")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _fs(path)
        folder = f"{base}/_temporary/{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex}"
        out, done, note, state = None, [], None, {"shard": None, "file": 0}

        def close():
            nonlocal out
            if out is not None:
                out.close()
                name = state["name"]
                done.append((state["shard"], state["file"], f"{folder}/{name}", f"{base}/{name}", state["records"], state["bytes"], state["sha1"].hexdigest()))
                state["file"] += 1
                out = None

        def put(member: bytes, records: int):
            out.write(member)
            state["sha1"].update(member)
            state["bytes"] += len(member)
            state["records"] += records

        for part in (p for batch in batches for p in text_parts(batch, 6)):
            for row in part.to_pylist():
                if row["shard"] != state["shard"]:
                    close()
                    state |= {"shard": row["shard"], "file": 0}
                if row["kind"] == 0:
                    note = (row["page"], row["payload_key"], row["refers_to"])
                    continue
                refers_to = note[2] if note and note[:2] == (row["page"], row["payload_key"]) else None
                if out is None:
                    state |= {"name": f"pages-{row['shard']:06d}-{state['file']:05d}.warc.gz", "records": 0, "bytes": 0, "sha1": hashlib.sha1()}
                    fs.create_dir(folder, recursive=True)
                    out = fs.open_output_stream(f"{folder}/{state['name']}", compression=None)
                    put(_info(state["name"], date), 0)
                put(page_record(row["page"], row["url"], row["html"].encode(), refers_to, date), 1)
                if state["bytes"] >= file_bytes:
                    close()
        close()
        if done:
            columns = [pa.array(list(c)) for c in zip(*done)]
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([c.cast(k) for c, k in zip(columns, kinds)], ["shard", "file", "written", "name", "records", "bytes", "sha1"])

    written = materialise(dealt.mapInArrow(tidy(write), _MANIFEST), "warc-written")

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as kinds

        fs, _ = _fs(path)
        for batch in batches:
            for row in batch.to_pylist():
                if fs.get_file_info(row["written"]).type != kinds.FileType.NotFound:
                    fs.move(row["written"], row["name"])
                elif fs.get_file_info(row["name"]).size != row["bytes"]:
                    raise OSError(f"{row['name']}: lost before it was committed")
            yield batch

    written.mapInArrow(tidy(rename), _MANIFEST).drop("written").write.parquet(f"{path}/_manifest")
    fs, base = _fs(path)
    from pyarrow import fs as kinds

    if fs.get_file_info(f"{base}/_temporary").type == kinds.FileType.Directory:
        fs.delete_dir(f"{base}/_temporary")
    return manifest(pages.sparkSession, path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_MANIFEST.replace("written string, ", "")).parquet(f"{path}/_manifest")


def _members(stream) -> Iterator[bytes]:
    """Each gzip member of a file, read in blocks."""
    data, squeeze, parts = stream.read(_READ), zlib.decompressobj(31), []
    while data:
        parts.append(squeeze.decompress(data))
        if squeeze.eof:
            yield b"".join(parts)
            data, squeeze, parts = squeeze.unused_data, zlib.decompressobj(31), []
            if data:
                continue
        data = stream.read(_READ)
    if parts:
        raise OSError("the file ends within a record")


def _parse(member: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = member.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    if "WARC-Block-Digest" in headers and _digest(block) != headers["WARC-Block-Digest"]:
        raise OSError(f"{headers['WARC-Record-ID']}: its block does not match its digest")
    return headers, block


def read_warc(spark: SparkSession, path: str, page_type: str = "long", payloads: bool = True) -> DataFrame:
    """The records of the manifest's files: ``page_id``, ``url``, ``record_type``,
    ``payload_bytes``, ``payload_digest`` (lower-case hex SHA-1), ``refers_to`` and, if asked
    for, ``payload`` (null for revisits). Digests are checked against what was read."""
    files = manifest(spark, path).select("name")
    n = max(1, files.count())
    schema = "page string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string" + ", payload binary" * payloads
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = _fs(path)

        def flush(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds[: len(names)])], names)

        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(name, compression=None) as stream:
                    for member in _members(stream):
                        h, block = _parse(member)
                        if h["WARC-Type"] == "warcinfo":
                            continue
                        payload = block.partition(b"\r\n\r\n")[2] if h["WARC-Type"] == "response" else None
                        if payload is not None and (_digest(payload) != h["WARC-Payload-Digest"] or len(payload) != int(h["X-Payload-Length"])):
                            raise OSError(f"{h['WARC-Record-ID']}: its payload does not match its headers")
                        digest = base64.b32decode(h["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                        rows.append((_id(h.get("X-Page")), h.get("WARC-Target-URI"), h["WARC-Type"], int(h["X-Payload-Length"]), digest, _id(h.get("X-Refers-To-Page")), payload))
                        held += len(payload or b"") * payloads + 200
                        if held >= _OUT:
                            yield flush(rows)
                            rows, held = [], 0
                if rows:
                    yield flush(rows)

    records = files.repartitionByRange(n, "name").mapInArrow(tidy(read), schema)
    return records.select(
        F.col("page").cast(page_type).alias("page_id"), "url", "record_type", "payload_bytes", "payload_digest",
        F.col("refers_to").cast(page_type).alias("refers_to"), *(["payload"] * payloads),
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from qalens.sources.supplied import read_supplied

    path = shared_dir(spark, "warc")
    write_warc(read_supplied(spark, sf_dir, "pages"), path)
    return read_warc(spark, path, payloads=False).drop("url")


OP10_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
h AS (SELECT html, max(page_id) AS holder FROM p WHERE n >= {REVISIT_BYTES} GROUP BY html)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN holder <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN holder <> page_id THEN holder END AS refers_to
FROM p LEFT JOIN h ON p.html = h.html
"""
