"""Shards of equal bytes by histogram sort (DataFrame functions only).

Rows are ordered by a key: a digest of the text, then one of the row's id, then one of the
row's place in its input. Copies of a text therefore stand together. A splitter is the key
at which a shard begins; its target is an equal share of all bytes. Splitters are found by
rounds: the bytes and rows below each of some thousands of candidate boundaries around
every open target are counted exactly, in all partitions at once, and the interval that
holds the target becomes the next round's range of candidates. Only these counts reach the
driver (at most ``MAX_COUNTS`` a round, whatever the data's size). Then every row, text and
all, is exchanged once, sorted and written.

A splitter settles at the boundary between two different texts that is nearest to its
target, if that is within ``tolerance`` (a share of a shard's bytes); otherwise a group of
copies is cut, at the nearest boundary between two rows. So copies share a shard unless the
group alone would unbalance it, a text with a third of all rows is spread like any other,
and the splitters are a function of the rows alone: not of their partitions, nor of how
the rounds went. The shards differ by at most twice the tolerance, or by the rows that lie
across a target.

A shard is written as one or more sorted pieces of about ``piece_bytes``, each by one task;
which piece a row goes to is a digest of its key, so no text or id makes a piece large.

Defined results: a null text counts no bytes but the overhead, and stands with the empty
texts; repeated rows (equal in text and id) are told apart by their place in the input, so
even they are spread; an empty table has no rows and no shards; fewer rows than shards leave
some shards empty; extra columns are kept whatever they are called.
"""

from __future__ import annotations

import os
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from qalens.llm._shared import materialise, pack, unpack
from qalens.session import shared_dir
from qalens.sources.supplied import read_supplied

SHARDS = 24
OVERHEAD = 8
TOLERANCE = 0.005
PIECE_BYTES = 256 << 20
#: Counts that come to the driver in one round.
MAX_COUNTS = 1 << 16
#: Length of the text's digest in the key: boundaries up to here lie between different texts.
GROUP = 32
#: Pieces up to this many are looked up through a broadcast of their offsets (24 bytes each).
MAX_BROADCAST_PIECES = 1 << 18
#: Greater than every digit of a key.
_AFTER = "g"


def sort_key(text: str, id: str) -> Column:
    """The row's place in the order, as fixed-length lower-case digits."""
    place = F.lower(F.lpad(F.hex(F.xxhash64(F.monotonically_increasing_id())), 16, "0"))
    return F.concat(F.md5(F.coalesce(F.col(text), F.lit(""))), F.md5(F.coalesce(F.col(id).cast("string"), F.lit(""))), place)


def byte_size(text: str, overhead: int = OVERHEAD) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + overhead


class _Target:
    """One splitter while it is sought: its range is the keys that start with ``prefix``."""

    def __init__(self, place: int):
        self.place, self.prefix, self.below, self.group_cut = place, "", 0, None

    def settle(self, found: list, total: int, shards: int, tolerance: float) -> str | None:
        """The splitter, if the counts decide it; otherwise the range becomes the interval that
        holds the target. ``found``: (digits, bytes, rows, least key, greatest key), in order."""
        goal = self.place * total  # of shards * bytes
        ends = list(accumulate((f[1] for f in found), initial=self.below))
        at = next((i for i in range(len(found)) if shards * ends[i + 1] > goal), len(found) - 1)
        _, _, rows, least, greatest = found[at]
        left, right = goal - shards * ends[at], shards * ends[at + 1] - goal
        nearest, gap = (least, left) if left <= right else (greatest + _AFTER, right)
        one_group = least[:GROUP] == greatest[:GROUP]
        if self.group_cut is None and one_group and len(self.prefix) < GROUP:
            # the interval is one text: its ends are the nearest boundaries between texts
            if gap <= tolerance * total:
                return nearest[:GROUP] if left <= right else greatest[:GROUP] + _AFTER
            self.group_cut = True
        if rows == 1 or least == greatest:
            return nearest
        self.below = ends[at]
        self.prefix = os.path.commonprefix([least, greatest])
        if not one_group:
            self.prefix = self.prefix[: GROUP - 1]
        return None


def find_splitters(keys: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[str]:
    """The keys at which the shards after the first begin, from ``(key, size)`` rows that are
    read once a round (about one round for every factor of 4,096 in the number of rows)."""
    total = keys.agg(F.sum("size")).first()[0]
    if not total:
        return []
    opened, settled = [_Target(i) for i in range(1, shards)], {}
    while opened:
        ranges: dict[str, list[_Target]] = {}
        for t in opened:
            ranges.setdefault(t.prefix, []).append(t)
        digits = max(d for d in (1, 2, 3) if d == 1 or len(ranges) * 16**d <= MAX_COUNTS)
        by_length: dict[int, list[str]] = {}
        for p in ranges:
            by_length.setdefault(len(p), []).append(p)
        counted = None
        for size, prefixes in by_length.items():
            inside = keys if size == 0 else keys.where(F.substring("key", 1, size).isin(prefixes))
            part = inside.groupBy(F.substring("key", 1, size).alias("p"), F.substring("key", size + 1, digits).alias("d"))
            part = part.agg(F.sum("size").alias("s"), F.count("*").alias("n"), F.min("key").alias("a"), F.max("key").alias("z"))
            counted = part if counted is None else counted.union(part)
        found: dict[str, list] = {}
        for p, *count in sorted(map(tuple, counted.collect())):
            found.setdefault(p, []).append(count)
        still = []
        for t in opened:
            cut = t.settle(found[t.prefix], total, shards, tolerance)
            if cut is None:
                still.append(t)
            else:
                settled[t.place] = cut
        opened = still
    return [settled[i] for i in sorted(settled)]


def shard_of(key: Column, splitters: list[str]) -> Column:
    """How many splitters the key has reached, by binary search in a constant array."""
    if not splitters:
        return F.lit(0)
    bits = len(splitters).bit_length()
    full = F.array(*[F.lit(s) for s in splitters + ["~"] * (2**bits - 1 - len(splitters))])
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])
    return F.aggregate(steps, F.lit(0), lambda at, s: F.when(F.element_at(full, at + s) <= key, at + s).otherwise(at))


def write_shards(
    rows: DataFrame,
    path: str,
    shards: int = SHARDS,
    *,
    id: str = "doc_id",
    text: str = "text",
    overhead: int = OVERHEAD,
    tolerance: float = TOLERANCE,
    piece_bytes: int = PIECE_BYTES,
) -> int:
    """Write the rows under ``path`` as ``shard=I/piece=J`` folders of one sorted Parquet file;
    the number of pieces of a shard is returned."""
    if shards < 1 or {id, text} & {"shard", "slot"}:
        raise ValueError("at least one shard, and no id or text column called shard or slot")
    named = pack(rows, text)
    own = "_text" if id == text else f"_row.`{id}`"
    keys = materialise(named.select(sort_key("_text", own).alias("key"), byte_size("_text", overhead).alias("size")), "shard-keys")
    splitters = find_splitters(keys, shards, tolerance)
    total = keys.agg(F.sum("size")).first()[0] or 0
    pieces = max(1, -(-total // (shards * piece_bytes)))
    placed = named.withColumn("_key", sort_key("_text", own))
    placed = placed.withColumn("shard", shard_of(F.col("_key"), splitters))
    placed = placed.withColumn("piece", F.pmod(F.xxhash64("_key"), F.lit(pieces)).cast("int"))
    dealt = placed.repartition("shard", "piece").sortWithinPartitions("shard", "piece", "_key")
    dealt.drop("_key").write.partitionBy("shard", "piece").parquet(path)
    return pieces


def read_shards(rows: DataFrame, path: str, shards: int, pieces: int, *, text: str = "text") -> DataFrame:
    """The written rows: the columns of ``rows`` (as they were given to :func:`write_shards`),
    ``shard`` and ``slot``, the row's place in its shard from 0, without gaps. A column of the
    rows with one of these names is replaced.

    The files' row counts (from their footers) give each piece its offset; the place in the
    file does the rest, so nothing is sorted or numbered again."""
    schema = StructType([*pack(rows, text).schema.fields, StructField("shard", IntegerType()), StructField("piece", IntegerType())])
    written = rows.sparkSession.read.schema(schema).parquet(path)
    counts = written.groupBy("shard", "piece").count()
    before = F.expr("sum(`count`) OVER (PARTITION BY shard ORDER BY piece ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    offsets = counts.select("shard", "piece", F.coalesce(before, F.lit(0)).alias("_before"))
    if shards * pieces <= MAX_BROADCAST_PIECES:
        offsets = F.broadcast(offsets)
    placed = written.withColumn("_at", F.col("_metadata.row_index")).join(offsets, ["shard", "piece"])
    kept = [c for c in rows.columns if c not in ("shard", "slot")]
    return unpack(placed, kept, text, "shard", (F.col("_before") + F.col("_at")).alias("slot"))


def op13_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of equal bytes, read back from the written shards."""
    documents = read_supplied(spark, sf_dir, "documents")
    path = shared_dir(spark, "shards")
    pieces = write_shards(documents, path, SHARDS)
    shards = read_shards(documents, path, SHARDS, pieces)
    return shards.select(
        "doc_id", byte_size("text").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


#: DuckDB has no CRC-32: it is computed here from its polynomial, a byte at a time.
OP13_SQL = f"""
WITH RECURSIVE poly(b, k, c) AS (
  SELECT b::BIGINT, 0, b::BIGINT FROM range(256) r(b)
  UNION ALL
  SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM poly WHERE k < 8
), crc AS (SELECT list(c ORDER BY b) AS steps FROM poly WHERE k = 8),
keyed AS (
  SELECT doc_id, coalesce(text, '') AS t, md5(coalesce(text, '')) AS g, md5(coalesce(doc_id::VARCHAR, '')) AS i,
         strlen(coalesce(text, '')) + {OVERHEAD} AS size
  FROM documents
), placed AS (
  SELECT *, (sum(size) OVER (ORDER BY g, i) - size)::BIGINT AS below, sum(size) OVER ()::BIGINT AS total FROM keyed
), row_cuts AS (SELECT DISTINCT below AS edge FROM placed UNION SELECT DISTINCT total AS edge FROM placed),
group_cuts AS (SELECT min(below) AS edge FROM placed GROUP BY g UNION SELECT DISTINCT total AS edge FROM placed),
goals AS (SELECT k, total, k * total AS goal FROM range(1, {SHARDS}) r(k), (SELECT DISTINCT total FROM placed)),
cuts AS (
  SELECT k,
         CASE WHEN (SELECT min(abs({SHARDS} * edge - goal)) FROM group_cuts) <= {TOLERANCE} * total
              THEN (SELECT edge FROM group_cuts ORDER BY abs({SHARDS} * edge - goal), edge LIMIT 1)
              ELSE (SELECT edge FROM row_cuts ORDER BY abs({SHARDS} * edge - goal), edge LIMIT 1) END AS edge
  FROM goals
), dealt AS (
  SELECT *, (SELECT count(*) FROM cuts WHERE edge <= below) AS shard FROM placed
)
SELECT doc_id, size, xor(list_reduce(list_prepend(4294967295,
         list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda x: ('0x' || x)::BIGINT)),
         lambda c, b: xor(c >> 8, crc.steps[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32,
       'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY g, i) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM dealt, crc
"""
