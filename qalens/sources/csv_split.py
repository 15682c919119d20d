"""Delimited text with quoted line breaks, read in byte ranges.

Spark reads such files whole, one task each, because a range cannot tell whether it starts
inside a quoted field. Here it is found out. Each range (a split of Spark's own text reader)
first walks its lines twice over: as if it started between records, and as if it started
inside a quoted field. What each walk ends in is a map of two states; composing the ranges'
maps in file order (one small row a range) gives every range its true start. Then the ranges
are read again, each giving the records that begin and end in it; a record that crosses
ranges is put together from the pieces the first walk kept.

A quoted field starts at the beginning of a field only, a doubled quote inside it is a quote,
and a quote inside an unquoted field is an ordinary character. A record ends at a line feed
outside quotes; a carriage return before it belongs to the line end. Everything inside quotes
is kept as it is (Spark's whole-file reader may rewrite CRLF there).
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from qalens.session import bound_to, private_session, shared_dir

#: Bytes of a range, and of a piece of a record that the first walk keeps.
SPLIT_BYTES = 64 << 20
KEPT_BYTES = 1 << 16
OUTSIDE, INSIDE = 0, 1
_EMPTY = pa.array([b"", b"\r"], type=pa.binary())


class _Quotes:
    """Where a line leaves us: outside or inside a quoted field."""

    def __init__(self, sep: str, quote: str):
        self.quote = quote.encode()
        q, s = re.escape(self.quote), re.escape(sep.encode())
        body = b"(?:[^%s]|%s%s)*+" % (q, q, q)
        field = b"(?:%s%s%s[^%s]*+|[^%s%s][^%s]*+|)" % (q, body, q, s, q, s, s)
        self._opens = re.compile(b"(?:%s%s)*+%s%s" % (field, s, q, body), re.S)
        self._closes = re.compile(b"%s%s[^%s]*+" % (body, q, s), re.S)

    def after(self, line: bytes, state: int, at: int = 0) -> int:
        if state == INSIDE:
            closed = self._closes.match(line, at)
            if closed is None:
                return INSIDE
            if closed.end() == len(line):
                return OUTSIDE
            at = closed.end() + 1
        return INSIDE if self._opens.fullmatch(line, at) else OUTSIDE


class _Walk:
    """One reading of a range's lines: where it stands, and the record that is open."""

    def __init__(self, start: int, kept: int | None):
        self.state, self.kept = start, kept
        self.open: list[bytes] | None = [] if start == INSIDE else None
        self.size, self.head = 0, None
        self.closed = start == OUTSIDE  # whether the record open at the start has ended
        self.ended = False  # whether any record has ended

    def add(self, lines: list[bytes]) -> None:
        self.size += sum(map(len, lines)) + len(lines)
        if self.open is not None and self.kept is not None and self.size > self.kept:
            self.open = None  # too long to keep; only that it is open is known
        if self.open is not None:
            self.open += lines

    def close(self) -> bytes | None:
        """End the open record; its lines, if they were kept."""
        text = None if self.open is None else b"\n".join(self.open)
        if not self.closed:
            self.head, self.closed = text, True
        self.state, self.open, self.size, self.ended = OUTSIDE, None, 0, True
        return text

    def begin(self, line: bytes) -> None:
        self.state, self.open, self.size = INSIDE, [], 0
        self.add([line])

    @property
    def tail(self) -> bytes | None:
        return b"\n".join(self.open) if self.state == INSIDE and self.open is not None else None


def _ranges(batches) -> Iterator[tuple[str, int, pa.Array]]:
    """Runs of lines of one range, in order."""
    for batch in batches:
        files, starts, lines = batch.columns
        if not batch.num_rows:
            continue
        starts_np = starts.to_numpy()
        change = pc.not_equal(files[1:], files[:-1]).to_numpy(zero_copy_only=False) | (starts_np[1:] != starts_np[:-1])
        edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(edges, edges[1:]):
            yield files[lo].as_py(), int(starts_np[lo]), lines.slice(lo, hi - lo)


def _quoted(lines: pa.Array, quote: bytes) -> np.ndarray:
    return np.flatnonzero(pc.match_substring(lines, quote).to_numpy(zero_copy_only=False))


def _walk(walk: _Walk, quotes: _Quotes, lines: list[bytes], marked: list[int]) -> None:
    at = 0
    for i in marked:
        if walk.state == INSIDE:
            walk.add(lines[at : i + 1])
            if quotes.after(lines[i], INSIDE) == OUTSIDE:
                walk.close()
        else:
            walk.ended |= i > at
            if quotes.after(lines[i], OUTSIDE) == INSIDE:
                walk.begin(lines[i])
            else:
                walk.ended = True
        at = i + 1
    if walk.state == INSIDE:
        walk.add(lines[at:])
    else:
        walk.ended |= len(lines) > at


_STATES = (
    "file string, start long, end_out int, end_in int, closes boolean, first_open boolean, "
    "head binary, tail_out binary, tail_in binary"
)


def _both_ways(sep: str, quote: str, kept: int):
    """Each range walked from both states; one row a range."""
    schema = _arrow(_STATES)

    def row(file: str, start: int, walks: list[_Walk]) -> dict:
        out, in_ = walks
        head = in_.head if in_.closed else in_.tail
        first_open = start == 0 and out.state == INSIDE and not out.ended
        values = (file, start, out.state, in_.state, in_.closed, first_open, head, out.tail, in_.tail if in_.closed else None)
        return dict(zip(schema.names, values))

    def scan(batches):
        quotes, now, walks, merged, rows = _Quotes(sep, quote), None, [], False, []
        for file, start, array in _ranges(batches):
            if (file, start) != now:
                if now is not None:
                    rows.append(row(*now, walks))
                now, walks, merged = (file, start), [_Walk(OUTSIDE, kept), _Walk(INSIDE, kept)], False
            marked = _quoted(array, quotes.quote).tolist()
            if not marked and all(w.state == OUTSIDE for w in walks):
                walks[0].ended = True
                continue
            lines = array.to_pylist()
            _walk(walks[0], quotes, lines, marked)
            if merged:
                walks[1].state, walks[1].open, walks[1].size = walks[0].state, walks[0].open, walks[0].size
            else:
                _walk(walks[1], quotes, lines, marked)
                # both between records at the same line: from here on they are one
                merged = walks[1].closed and walks[0].state == walks[1].state == OUTSIDE
        if now is not None:
            rows.append(row(*now, walks))
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return scan


def _arrow(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(StructType.fromDDL(ddl))


def compose(maps: list[tuple[str, int, int, int, bool]]) -> dict[str, dict[int, tuple[int, int]]]:
    """For every file, the ranges that start inside a quoted field, with the range in which
    that record began: from ``(file, start, end_out, end_in, closes)`` of every range."""
    inside: dict[str, dict[int, tuple[int, int]]] = defaultdict(dict)
    file = state = owner = None
    for name, start, end_out, end_in, closes in sorted(maps):
        if name != file:
            file, state, owner = name, OUTSIDE, None
        if state == OUTSIDE:
            state = end_out
            owner = start if state == INSIDE else None
            continue
        inside[name][start] = (owner, int(closes))
        if closes:
            owner = start if end_in == INSIDE else None
        state = end_in
    return dict(inside)


def _whole_records(sep: str, quote: str, inside: dict, header: bool):
    """The records that begin and end in their range."""

    def records(walk: _Walk, quotes: _Quotes, lines: list[bytes], marked: list[int]) -> list[bytes]:
        out, at = [], 0
        for i in marked:
            if walk.state == INSIDE:
                walk.add(lines[at : i + 1])
                if quotes.after(lines[i], INSIDE) == OUTSIDE:
                    whole, text = walk.closed, walk.close()
                    if whole:
                        out.append(text)
            else:
                out += lines[at:i]
                if quotes.after(lines[i], OUTSIDE) == INSIDE:
                    walk.begin(lines[i])
                else:
                    out.append(lines[i])
            at = i + 1
        if walk.state == INSIDE:
            walk.add(lines[at:])
        else:
            out += lines[at:]
        return out

    def scan(batches):
        quotes, now, walk, skip = _Quotes(sep, quote), None, None, False
        for file, start, array in _ranges(batches):
            if (file, start) != now:
                now, skip = (file, start), header and start == 0
                walk = _Walk(INSIDE if start in inside.get(file, ()) else OUTSIDE, None)
            marked = _quoted(array, quotes.quote).tolist()
            if marked or walk.state == INSIDE:
                found = records(walk, quotes, array.to_pylist(), marked)
                array = pa.array(found, type=pa.binary())
            array = array.cast(pa.binary())
            array = array.filter(pc.invert(pc.is_in(array, value_set=_EMPTY)))
            if skip and len(array):
                array, skip = array.slice(1), False
            if len(array):
                yield pa.RecordBatch.from_arrays([array], names=["record"])

    return scan


def _long_pieces(sep: str, quote: str, inside: dict):
    """Heads and tails of ranges whatever their length: ``(file, owner, start, piece)``."""
    schema = _arrow("file string, owner long, start long, piece binary")

    def done(file: str, start: int, walk: _Walk) -> list[dict]:
        began = inside.get(file, {}).get(start)
        out = []
        if began:
            head = walk.head if walk.closed else walk.tail
            out.append({"file": file, "owner": began[0], "start": start, "piece": head})
        if walk.state == INSIDE and walk.closed:
            out.append({"file": file, "owner": start, "start": start, "piece": walk.tail})
        return out

    def scan(batches):
        quotes, now, walk, rows = _Quotes(sep, quote), None, None, []
        for file, start, array in _ranges(batches):
            if (file, start) != now:
                if now is not None:
                    rows += done(*now, walk)
                now = (file, start)
                walk = _Walk(INSIDE if start in inside.get(file, ()) else OUTSIDE, None)
            marked = _quoted(array, quotes.quote).tolist()
            if marked or walk.state == INSIDE:
                _walk(walk, quotes, array.to_pylist(), marked)
        if now is not None:
            rows += done(*now, walk)
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return scan


def split_records(
    spark: SparkSession,
    path: str | list[str],
    *,
    sep: str = ",",
    quote: str = '"',
    header: bool = True,
    split_bytes: int = SPLIT_BYTES,
    kept_bytes: int = KEPT_BYTES,
) -> DataFrame:
    """``record``: the text of every record of the files but each one's header and empty lines.

    A file is read by as many tasks as it has ranges of ``split_bytes`` (a compressed file
    that cannot be split is one range). Two passes; the first runs at once, the second when
    the result is used. One row of a few bytes a range comes to the driver. Pieces of records
    longer than ``kept_bytes`` cost one more pass over the files that hold them.
    """
    # a session of its own fixes the ranges: they must be the same in every pass
    own = private_session(
        spark, {"spark.sql.files.maxPartitionBytes": split_bytes, "spark.sql.files.minPartitionNum": 1, "spark.sql.files.openCostInBytes": 0},
    )
    raw = own.read.option("lineSep", "\n").text(path)
    place = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    lines = raw.select(*place, F.col("value").cast("binary").alias("line"))
    kept = shared_dir(spark, "csv-ranges")
    lines.mapInArrow(_both_ways(sep, quote, kept_bytes), _STATES).write.parquet(kept)
    walked = spark.read.schema(_STATES).parquet(kept)
    inside = compose([tuple(r) for r in walked.select("file", "start", "end_out", "end_in", "closes").collect()])
    records = lines.select(*lines.columns).mapInArrow(_whole_records(sep, quote, inside, header), "record binary")
    whole = bound_to(spark, records)
    if inside:
        found = [(f, s, owner) for f, ranges in inside.items() for s, (owner, _) in ranges.items()]
        known = spark.createDataFrame(found, "file string, start long, owner long")
        placed = walked.join(known, ["file", "start"], "left")
        head = F.when(F.col("owner").isNotNull(), F.struct("owner", "start", F.col("head").alias("piece")))
        # the piece that begins in this range, if one does
        open_out = F.when(F.col("owner").isNull() & (F.col("end_out") == INSIDE), F.col("tail_out"))
        open_in = F.when(F.col("owner").isNotNull() & F.col("closes") & (F.col("end_in") == INSIDE), F.col("tail_in"))
        begins = (F.col("owner").isNull() & (F.col("end_out") == INSIDE)) | (F.col("owner").isNotNull() & F.col("closes") & (F.col("end_in") == INSIDE))
        tail = F.when(begins, F.struct(F.col("start").alias("owner"), "start", F.coalesce(open_out, open_in).alias("piece")))
        pieces = placed.select("file", F.explode(F.array_compact(F.array(head, tail))).alias("p")).select("file", "p.*")
        if pieces.where("piece IS NULL").limit(1).count():  # some were too long to keep
            long_files = [r.file for r in pieces.where("piece IS NULL").select("file").distinct().collect()]
            again = lines.where(F.col("file").isin(long_files)).mapInArrow(_long_pieces(sep, quote, inside), "file string, owner long, start long, piece binary")
            pieces = pieces.where(~F.col("file").isin(long_files)).unionByName(bound_to(spark, again))
        if header:  # a header that goes on in the next range is no record either
            headers = walked.where("first_open").select("file", F.col("start").alias("owner"))
            pieces = pieces.join(headers, ["file", "owner"], "left_anti")
        ordered = F.array_sort(F.collect_list(F.struct("start", "piece")))
        joined = pieces.groupBy("file", "owner").agg(ordered.alias("parts"))
        texts = F.transform("parts", lambda p: p["piece"].cast("string"))
        whole = whole.select(F.col("record").cast("string")).unionByName(joined.select(F.array_join(texts, "\n").alias("record")))
    else:
        whole = whole.select(F.col("record").cast("string"))
    text = F.when(F.right("record", F.lit(1)) == "\r", F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    return whole.select(text.alias("record")).where("record <> ''")
