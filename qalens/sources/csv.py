"""Delimited text with quoted multi-line fields (the site's CSV exports)."""

from __future__ import annotations

import re
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from qalens.session import private_session
from qalens.sources.csv_split import SPLIT_BYTES, split_records

# The CSV dialect. Quoted fields may hold line breaks, commas and
# doubled quotes; whitespace is data; an empty field is NULL.
CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "mode": "PERMISSIVE",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


#: Lines that a task of the header census takes at a time, and the size from which a file is
#: left after its header (leaving one costs a new Python worker, as much as reading this).
CENSUS_LINES, LEAVE_BYTES = 64, 2 << 20
#: Options of the reader that choose files.
_FILE_OPTIONS = ("pathGlobFilter", "recursiveFileLookup", "modifiedBefore", "modifiedAfter")


def _header(spark: SparkSession, path: str | list[str], opts: dict[str, str]) -> tuple[str, ...]:
    return tuple(spark.read.options(**{**opts, "inferSchema": "false"}).csv(path).columns)


def _first_records(quote: bytes, early: bool):
    """The first record of each file of the task: the lines up to the first with closed quotes.

    ``early``: the task leaves a long file after its header (it has no other file)."""

    def scan(batches):
        found: dict[tuple[str, int], list[bytes]] = {}
        done: set[tuple[str, int]] = set()
        for batch in batches:
            for file, size, line in zip(*[c.to_pylist() for c in batch.columns]):
                key, line = (file, size), line.removesuffix(b"\r")
                if key in done or (not line and key not in found):  # empty lines before the header
                    continue
                found.setdefault(key, []).append(line)
                if sum(x.count(quote) for x in found[key]) % 2 == 0:
                    done.add(key)
            if early and any(size > LEAVE_BYTES for _, size in done):
                break
        if found:
            rows = [{"file": f, "size": n, "header": b"\n".join(lines)} for (f, n), lines in found.items()]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("file", pa.string()), ("size", pa.int64()), ("header", pa.binary())]))

    return scan


def _plain(uri: str) -> str:
    """A file's path as readers take it (listings encode it, in one of two spellings)."""
    return unquote(re.sub(r"^([A-Za-z0-9+.-]+:)///", r"\1/", uri))


def header_census(spark: SparkSession, path: str | list[str], opts: dict[str, str]) -> dict[tuple[str, ...], dict[str, int]]:
    """The files of ``path``, with their bytes, by the columns their headers name.

    One job reads the first lines of every file, a task a file, and groups the files by the
    header's text; one more job for every *different* header turns it into names. So the
    number of jobs does not depend on the number of files. Files without a line are left out.
    """
    quote = opts.get("quote", CSV_OPTIONS["quote"]).encode()
    own = private_session(spark, {
        # no file is cut, and none shares a task
        "spark.sql.files.maxPartitionBytes": 1 << 50, "spark.sql.files.openCostInBytes": 1 << 50,
        "spark.sql.execution.arrow.maxRecordsPerBatch": CENSUS_LINES,
    })

    def census(files: str | list[str], early: bool) -> tuple[DataFrame, dict[bytes, dict[str, int]]]:
        raw = own.read.options(lineSep="\n", **{k: v for k, v in opts.items() if k in _FILE_OPTIONS}).text(files)
        lines = raw.where("_metadata.file_block_start = 0").select("_metadata.file_path", "_metadata.file_size", F.col("value").cast("binary"))
        firsts = lines.mapInArrow(_first_records(quote, early), "file string, size long, header binary")
        grouped = firsts.groupBy("header").agg(F.collect_list(F.struct("file", "size")).alias("files")).collect()
        return raw, {bytes(r.header): {_plain(f.file): f.size for f in r.files} for r in grouped}

    raw, texts = census(path, True)
    seen = {f for files in texts.values() for f in files}
    if rest := [f for f in map(_plain, raw.inputFiles()) if f not in seen]:
        # empty files, or files that had to share a task after all
        for header, files in census(rest, False)[1].items():
            texts.setdefault(header, {}).update(files)
    out: dict[tuple[str, ...], dict[str, int]] = {}
    for _, files in sorted(texts.items()):
        out.setdefault(_header(spark, min(files), opts), {}).update(files)
    return dict(sorted(out.items()))


def _own_schema(header: tuple[str, ...], schema: StructType, opts: dict[str, str]) -> StructType:
    typed = {f.name: f for f in schema.fields}
    own = StructType([typed.get(name, StructField(name, StringType(), True)) for name in header])
    torn = opts.get("columnNameOfCorruptRecord")
    return own.add(torn, StringType()) if torn and torn not in header else own


def _by_header(
    spark: SparkSession, path: str | list[str], header, schema: StructType, opts: dict[str, str], split: int | None
) -> DataFrame:
    own = _own_schema(header, schema, opts)
    if split is None:
        return spark.read.options(**opts).schema(own).csv(path)
    sep = opts.get("sep", opts.get("delimiter", ","))
    records = split_records(spark, path, sep=sep, quote=opts["quote"], split_bytes=split)
    parsing = {k: v for k, v in opts.items() if k not in ("header", "multiLine", *_FILE_OPTIONS)}
    ddl = ", ".join("`{}` {}".format(f.name.replace("`", "``"), f.dataType.simpleString()) for f in own.fields)
    return records.select(F.from_csv("record", ddl, parsing).alias("r")).select("r.*")


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    *,
    by_header: bool = False,
    split: bool | int = False,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Read CSV with an explicit schema (``StructType`` or DDL text; never inferred).

    ``by_header=True``: each file's own header decides its column order; columns
    of ``schema`` are typed and any other column is read as text, so files
    holding more columns than the schema, or in another order, still load by
    name. Files with equal headers are read together and the groups appended by
    name (a column that a group lacks is NULL there, unless the schema asks for
    it: then the read fails). All headers are read by one job
    (:func:`header_census`).

    ``split=True`` (or the bytes of a range): files longer than a range are read by ranges, also
    where quoted fields hold line breaks (:mod:`qalens.sources.csv_split`); it needs
    ``header`` and the dialect's doubled quotes.

    A gzip file is one task whatever its size; convert such inputs once with
    :func:`qalens.sources.tables.convert_to_parquet` and query the Parquet.
    """
    opts = dict(CSV_OPTIONS)
    opts.update(options or {})
    if isinstance(schema, str):  # DDL text, e.g. "Id long, Name string"
        schema = StructType.fromDDL(schema)
    ranges = (SPLIT_BYTES if split is True else int(split)) if split else None
    if ranges and (opts["header"] != "true" or opts["escape"] != opts["quote"] or "encoding" in opts):
        raise ValueError("split reading needs a header, doubled quotes and UTF-8")
    if not by_header:
        if ranges:
            return _by_header(spark, path, schema.fieldNames(), schema, opts, ranges)
        return spark.read.options(**opts).schema(schema).csv(path)
    if "encoding" in opts:  # the census reads UTF-8
        files = spark.read.options(**opts).schema(schema).csv(path).inputFiles()
        groups: dict[tuple[str, ...], dict[str, int]] = {}
        for f in files:
            if header := _header(spark, f, opts):
                groups.setdefault(header, {})[f] = 0
    else:
        groups = header_census(spark, path, opts)
    out = None
    for header, members in groups.items():
        missing = [c for c in schema.fieldNames() if c not in header]
        if missing and len(groups) > 1:
            raise ValueError(f"columns {missing} not found in the header of {min(members)}")
        cut = ranges if ranges and max(members.values()) > ranges else None
        part = _by_header(spark, sorted(members) if len(groups) > 1 else path, header, schema, opts, cut)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out if out is not None else spark.createDataFrame([], schema)
