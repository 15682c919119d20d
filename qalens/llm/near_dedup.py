"""MinHash near-duplicate detection with an LSH forest.

Each document's set of word shingles gets ``TREES * STEP`` minhash values. Tree ``t`` of the
forest is one sorted order of the documents: by the signature read from value ``t * STEP``
on. In a sorted order the documents that agree longest with a document stand next to it, so
candidates are neighbours with a common prefix. The depth asked for adapts to the region: one
shared value is enough between adjacent documents, more the further apart two stand
(``DEEPEST`` at most), so where nobody else is near, a short prefix does.

Candidates whose signatures agree in fewer than ``LEAST_AGREEING`` places (4 bits of each
value are compared) are put aside. Of the others each document asks for the best few per order,
and every pair asked for is confirmed on the full sets. Documents with more candidates than that
(dense regions) enter further rounds, which look only at neighbours that are not yet in the same
component, until a round finds no link.

None of this decides what is found, only how soon. Before the forest, shingles are counted
(``shared_counts``): a text that shares too few of them with other texts to have a partner
is left out of all that follows, and of the others none is. After the last round all of these
are joined among themselves on their shingles (``join_crowded``): each takes the prefix of its
set, rarest shingles first, in which any partner of the similarity sought must share one;
shingles that a single component holds are compared with none. There is no limit on candidates
there, and no sketch is asked, so a pair that an order, its depth, its limits or
``LEAST_AGREEING`` put aside is found all the same. Pairs within a component are not formed, so
no group of copies is expanded into its pairs.

Identical word sequences are one class before any of this. Links join classes; connected
components name each document's group by its smallest id. Only hashes stand for equality:
64 bits a shingle and, in the count, a text; 128 bits a class.

Defined results: a null or blank text has the empty set and is linked with nothing; fewer
words than a shingle are one shingle; a row without an id is returned with a null component
and kept; rows that repeat an id are judged each by its own text; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qalens.llm._components import connected_components
from qalens.llm._shared import materialise
from qalens.llm._text import CHUNK_BYTES, LOWER_ASCII, SPACE_WORDS, Words, mix, stream, tidy, window_hashes, word_chunks

SHINGLE = 5
TREES = 24
STEP = 4
DEPTH = 12
#: The most shared values asked of two documents of an order, however far apart.
DEEPEST = 4
#: For 96 values and a similarity of 0.75; of pairs at 0.3, 1 in 80 agrees in as many.
LEAST_AGREEING = 44
#: (places looked ahead, candidates asked for by a document per order): first, later rounds.
FIRST_ROUND, LATER_ROUNDS = (32, 1), (64, 4)
#: Shingles that are counted at a time: of a task's texts, of a range of hashes.
AT_ONCE, RANGE = 1 << 18, 1 << 19
#: Holders of one shingle that the exact join compares with as many others at a time.
BLOCK = 1024


def shingle_hashes(chunk: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every distinct shingle, sorted by both."""
    word, counts = chunk.hashes(), chunk.counts
    starts = chunk.window_starts(size)
    full = window_hashes(word, starts, size)
    few = np.flatnonzero((counts > 0) & (counts < size))
    rest = mix(window_hashes(word, chunk.first[few], counts[few]) + counts[few].astype(np.uint64))
    room = np.maximum(counts - (size - 1), 0)
    row = np.concatenate((np.repeat(np.arange(len(counts)), room), few))
    value = np.concatenate((full, rest))
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]


def minhashes(row: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows that have shingles, and ``n`` 32-bit minhash values of each."""
    rows, at = np.unique(row, return_index=True)
    short = (value >> np.uint64(32)).astype(np.uint32)
    flip, times = stream(21, n).astype(np.uint32), stream(22, n).astype(np.uint32) | np.uint32(1)
    out = np.empty((len(rows), n), dtype=np.uint32)
    for k in range(n):
        out[:, k] = np.minimum.reduceat((short ^ flip[k]) * times[k], at) if len(at) else 0
    return rows, out


def sign(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, values: int = TREES * STEP) -> DataFrame:
    """Per document: shingle count, a 128-bit hash of its word sequence, its signature."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in word_chunks(batch.column(1), SPACE_WORDS, LOWER_ASCII):
                n = chunk.hi - chunk.lo
                row, value = shingle_hashes(chunk, shingle)
                have, signature = minhashes(row, value, values)
                signatures, sketches = [b""] * n, [b""] * n
                nibbles = (signature & 15).astype(np.uint8)
                for r, s, k in zip(have.tolist(), (signature & 0xFFFF).astype(">u2"), nibbles[:, 0::2] | nibbles[:, 1::2] << 4):
                    signatures[r], sketches[r] = s.tobytes(), k.tobytes()
                word = chunk.hashes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.lo, n),
                        pa.array(np.bincount(row, minlength=n)),
                        pa.array(window_hashes(word, chunk.first[:-1], chunk.counts).view(np.int64)),
                        pa.array(window_hashes(mix(word + np.uint64(7)), chunk.first[:-1], chunk.counts).view(np.int64)),
                        pa.array(signatures, pa.binary()),
                        pa.array(sketches, pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "text_a", "text_b", "signature", "sketch"],
                )

    kind = documents.schema[doc_id].dataType.simpleString()
    return documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        tidy(rows), f"doc_id {kind}, n_shingles long, text_a long, text_b long, signature binary, sketch binary"
    )


def _agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places at which two sketches hold the same 4 bits."""
    x = a ^ b
    return ((x & 15) == 0).sum(axis=1) + ((x >> 4) == 0).sum(axis=1)


def _neighbours(rows: pa.RecordBatch, new: int, depth: int, percent: int, agreeing: int, ahead: int, best: int):
    """Candidate pairs among rows in sorted order, and the documents that had more of them (or
    may have, further on). Only pairs with one of the last ``new`` rows are looked at."""
    n = rows.num_rows
    trees, ids, sizes, groups = (rows.column(i).to_numpy() for i in (0, 2, 3, 5))
    keys = np.frombuffer(b"".join(rows.column(1).to_pylist()), dtype=np.uint16).reshape(n, depth)
    sketches = np.frombuffer(b"".join(rows.column(4).to_pylist()), dtype=np.uint8).reshape(n, -1)
    left, right, agree, crowded = [], [], [], []
    at = np.arange(n - 1)
    for gap in range(1, ahead + 1):
        at = at[at + gap < n]
        same = (keys[at] == keys[at + gap]) & (trees[at] == trees[at + gap])[:, None]
        common = np.where(same.all(axis=1), depth, same.argmin(axis=1))
        at = at[common >= min(gap, DEEPEST)]  # prefixes only get shorter further on
        if not len(at):
            break
        near = at[at + gap >= n - new]
        small, large = np.minimum(sizes[near], sizes[near + gap]), np.maximum(sizes[near], sizes[near + gap])
        near = near[(100 * small >= percent * large) & (groups[near] != groups[near + gap])]
        places = _agreeing(sketches[near], sketches[near + gap])
        left.append(near[places >= agreeing])
        right.append(left[-1] + gap)
        agree.append(places[places >= agreeing])
    else:
        crowded += [at, at + ahead]
    if not left:
        none = np.empty(0, dtype=np.int64)
        return none, none, none
    a, b, places = np.concatenate(left), np.concatenate(right), np.concatenate(agree)
    # each document asks for its best; ties go to the smaller id
    asking, asked, places = np.concatenate((a, b)), np.concatenate((b, a)), np.concatenate((places, places))
    order = np.lexsort((ids[asked], -places, asking))
    asking, asked = asking[order], asked[order]
    rank = np.arange(len(asking)) - np.searchsorted(asking, asking)
    crowded.append(asking[rank >= best])
    a, b = ids[asking[rank < best]], ids[asked[rank < best]]
    return np.minimum(a, b), np.maximum(a, b), np.unique(ids[np.concatenate(crowded)])


_ROWS = "tree int, key binary, doc_id long, n_shingles long, sketch binary, component long"
_KINDS = (pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.int64())


def forest(
    signed: DataFrame, ahead: int, best: int, trees: int = TREES, step: int = STEP, depth: int = DEPTH, percent: int = 75, agreeing: int = LEAST_AGREEING
) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs ``(a, b)``, ``a < b``, of documents in different components, and the
    ids ``a`` of those that had more candidates than they asked for.

    Rows are range-partitioned by (tree, signature, id), so a region of any density is
    spread over as many tasks as its size needs. A task keeps only the last few rows of its
    order; the rows at the two ends of each task are paired in a second, small job.
    """
    order = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(t).alias("tree"),
                    F.substring(F.concat("signature", "signature"), 2 * step * t + 1, 2 * depth).alias("key"),
                )
                for t in range(trees)
            ]
        )
    )
    columns = [x.split()[0] for x in _ROWS.split(", ")]
    rows = signed.select(order.alias("o"), *columns[2:]).select("o.tree", "o.key", *columns[2:])
    ordered = rows.repartitionByRange("tree", "key", "doc_id").sortWithinPartitions("tree", "key", "doc_id")

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", *columns]

        def edge(batch):
            none = pa.nulls(batch.num_rows, pa.int64())
            return pa.RecordBatch.from_arrays([none, none, *batch.columns], names)

        def found(a, b):
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), *[pa.nulls(len(a), k) for k in _KINDS]], names)

        held, begun = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if begun < ahead:
                yield edge(batch.slice(0, ahead - begun))
                begun += min(ahead - begun, batch.num_rows)
            full = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            a, b, crowded = _neighbours(full, batch.num_rows, depth, percent, agreeing, ahead, best)
            yield found(a, b)
            yield found(crowded, [None] * len(crowded))
            held = full.slice(max(0, full.num_rows - ahead))
        if held is not None:
            yield edge(held)

    found = materialise(ordered.mapInArrow(tidy(pair), f"a long, b long, {_ROWS}"), "forest")
    # ends of tasks: a few rows for each partition of the orders, not for each document
    ends = found.where("tree IS NOT NULL").select(*columns).distinct().coalesce(1).sortWithinPartitions("tree", "key", "doc_id")

    def pair_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in pair(batches):
            yield out.select([0, 1])

    both = found.select("a", "b").union(ends.mapInArrow(tidy(pair_ends), "a long, b long")).where("a IS NOT NULL").distinct()
    both = materialise(both, "candidates")
    return both.where("b IS NOT NULL"), both.where("b IS NULL").select("a")


def confirm(pairs: DataFrame, texts: DataFrame, shingle: int = SHINGLE, percent: int = 75) -> DataFrame:
    """The pairs of ``texts (id, text)`` whose full shingle sets have a similarity of ``percent``
    or more."""
    both = (
        pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
        .select("a", "b", "text_a", "text_b")
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n = batch.column(0), batch.column(1), batch.num_rows
            # both texts of a pair next to each other; a part holds whole pairs of bounded size
            mixed = pa.concat_arrays([batch.column(2), batch.column(3)]).take(pa.array(np.arange(2 * n).reshape(2, n).T.ravel()))
            ends = np.cumsum(pc.binary_length(mixed).to_numpy(zero_copy_only=False).astype(np.int64))[1::2]
            lo = 0
            while lo < n:
                limit = (ends[lo - 1] if lo else 0) + CHUNK_BYTES
                hi = min(n, max(lo + 1, int(np.searchsorted(ends, limit, side="right"))))
                (chunk,) = word_chunks(mixed.slice(2 * lo, 2 * (hi - lo)), SPACE_WORDS, LOWER_ASCII, 1 << 62)
                row, value = shingle_hashes(chunk, shingle)
                size = np.bincount(row, minlength=2 * (hi - lo))
                own = row // 2
                at = np.lexsort((value, own))
                own, value = own[at], value[at]
                twin = (own[1:] == own[:-1]) & (value[1:] == value[:-1])
                shared = np.bincount(own[1:][twin], minlength=hi - lo)
                union = size[0::2] + size[1::2] - shared
                good = pa.array(np.flatnonzero((100 * shared >= percent * union) & (union > 0)) + lo)
                yield pa.RecordBatch.from_arrays([a.take(good), b.take(good)], ["a", "b"])
                lo = hi

    return both.mapInArrow(tidy(check), "a long, b long").distinct()


def shingles(texts: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(id, component, shingle)``: every distinct shingle of ``texts (id, text, component)``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in word_chunks(batch.column(1), SPACE_WORDS, LOWER_ASCII):
                row, value = shingle_hashes(chunk, shingle)
                at = pa.array(row + chunk.lo)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(2).take(at), pa.array(value.view(np.int64))], ["id", "component", "shingle"]
                )

    return texts.select("id", "text", "component").mapInArrow(tidy(rows), "id long, component long, shingle long")


def missing(n, percent: int):
    """The most shingles of a set of ``n`` that a partner can lack."""
    return n - (percent * n + 99) // 100


def _binaries(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The bytes of ``values``, so many values to a row."""
    ends = np.concatenate(([0], np.cumsum(counts) * values.itemsize)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))])


def _counted(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))], ["text_a", "shared"])


def _deal(value: np.ndarray, key: np.ndarray, ranges: int) -> Iterator[pa.RecordBatch]:
    """Shingles and the texts that hold them as one row per range of hashes. Of more than two
    holders here, two are sent on; the others are known to share the shingle, and are counted
    (in a row of a negative range), so a common shingle is never sent with all its holders."""
    spread = mix(value)
    low = np.uint64(32)
    place = ((spread >> low) * np.uint64(ranges) >> low) << low | spread & np.uint64(0xFFFFFFFF)
    order = np.lexsort((key, place))
    value, key, place = value[order], key[order], place[order]
    again = np.zeros(len(place), dtype=bool)
    again[1:] = (place[1:] == place[:-1]) & (key[1:] == key[:-1])
    clash = again.copy()  # two shingles of a text that the place does not tell apart count as shared
    clash[1:] &= value[1:] != value[:-1]
    known, key, place = [key[clash]], key[~again], place[~again]
    inner = np.zeros(len(place), dtype=bool)
    inner[1:-1] = place[2:] == place[:-2]
    known, times = np.unique(np.concatenate((*known, key[inner])), return_counts=True)
    key, place = key[~inner], place[~inner]
    at = (place >> low).astype(np.int64)
    starts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    counts = np.diff(np.append(starts, len(at)))
    names = ["range", "tags", "texts"]
    tags = place.astype(np.uint32)
    yield pa.RecordBatch.from_arrays([pa.array(at[starts]), _binaries(tags, counts), _binaries(key, counts)], names)
    if len(known):
        one = np.array([len(known)])
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1 - int(known[0] >> np.uint64(48))]), _binaries(times.astype(np.uint32), one), _binaries(known, one)], names
        )


def _shared(tag: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
    """How many shingles of a range each text shares with another text."""
    order = np.argsort(tag, kind="stable")
    tag, key = tag[order], key[order]
    starts = np.flatnonzero(np.concatenate(([True], tag[1:] != tag[:-1])))
    apart = np.minimum.reduceat(key, starts) < np.maximum.reduceat(key, starts)
    held = np.repeat(apart, np.diff(np.append(starts, len(tag))))
    tag, key = tag[held], key[held]
    order = np.lexsort((tag, key))
    tag, key = tag[order], key[order]
    new = np.ones(len(tag), dtype=bool)
    new[1:] = (tag[1:] != tag[:-1]) | (key[1:] != key[:-1])
    return _counted(*np.unique(key[new], return_counts=True))


def shared_counts(texts: DataFrame, total: int, shingle: int = SHINGLE, percent: int = 75) -> DataFrame:
    """``(text_a, shared)``: how many of a text's first ``2 m + 1`` shingles are among the first
    shingles of another text, too; ``m`` is ``missing``, first are those of the least hashes.
    ``total`` (all shingles) says into how many ranges of hashes they are dealt.

    Two sets of the similarity sought share all but ``m + 1`` of these, and at least one, so a
    text that shares fewer has no partner. The count may be too large, never too small. Whole copies
    of a text count as one.
    """
    ranges = total // RANGE + 1

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for chunk in word_chunks(batch.column(0), SPACE_WORDS, LOWER_ASCII):
                row, value = shingle_hashes(chunk, shingle)
                n = np.bincount(row, minlength=chunk.hi - chunk.lo)
                rank = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                first = rank < (2 * missing(n, percent) + 1)[row]
                text = window_hashes(chunk.hashes(), chunk.first[:-1], chunk.counts)
                held.append((value[first], text[row[first]]))
                size += int(first.sum())
                if size >= AT_ONCE:
                    yield from _deal(*(np.concatenate(x) for x in zip(*held)), ranges)
                    held, size = [], 0
        if size:
            yield from _deal(*(np.concatenate(x) for x in zip(*held)), ranges)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for i, at in enumerate(batch.column(0).to_pylist()):
                tags, keys = (np.frombuffer(batch.column(c)[i].as_buffer(), dtype=t) for c, t in ((1, np.uint32), (2, np.uint64)))
                if at < 0:
                    yield _counted(keys, tags)
                    continue
                if at != now and held:
                    yield _shared(*(np.concatenate(x) for x in zip(*held)))
                    held = []
                now = at
                held.append((tags, keys))
        if held:
            yield _shared(*(np.concatenate(x) for x in zip(*held)))

    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = texts.select("text").mapInArrow(tidy(deal), "range long, tags binary, texts binary")
    counts = dealt.repartition(parts, "range").sortWithinPartitions("range").mapInArrow(tidy(count), "text_a long, shared long")
    return counts.groupBy("text_a").agg(F.sum("shared").alias("shared"))


def _group_starts(rows: pa.RecordBatch) -> np.ndarray:
    """Where a new (shingle, i, j) begins."""
    keys = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in range(3)])
    return np.concatenate(([0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1))


def _alike(rows: pa.RecordBatch, starts: np.ndarray, ends: np.ndarray, percent: int) -> pa.RecordBatch:
    """Pairs of each group whose components differ and whose sizes and shingles left allow the
    similarity."""
    i, j, block, ids, component, n, left = (rows.column(c).to_numpy() for c in range(1, 8))
    found = [np.empty((0, 2), dtype=np.int64)]
    for lo, hi in zip(starts.tolist(), ends.tolist()):
        for at in range(lo, hi, 64):
            x, y = np.arange(at, min(hi, at + 64))[:, None], np.arange(lo, hi)[None, :]
            good = (ids[x] < ids[y]) & (component[x] != component[y]) & ((block[x] != block[y]) | (i[lo] == j[lo]))
            good &= 100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])
            good &= (100 + percent) * np.minimum(left[x], left[y]) >= percent * (n[x] + n[y])
            a, b = np.nonzero(good)
            found.append(np.stack([ids[a + at], ids[b + lo]], axis=1))
    pairs = np.unique(np.concatenate(found), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def join_crowded(crowded: DataFrame, texts: DataFrame, shingle: int = SHINGLE, percent: int = 75) -> DataFrame:
    """Every pair ``(a, b)``, ``a < b``, of ``crowded`` documents in different components that have
    a similarity of ``percent``: none is left out for the number of its rivals or its sketch.

    A shingle held by one component only cannot make such a pair. The others are ordered by
    their holders; a partner shares at least ``ceil(percent * n / 100)`` of a set of n, so one of
    the first n + 1 less that many, private shingles counted first. Holders of a common shingle
    are compared in blocks, so a shingle of any frequency is spread over many tasks. What two
    documents of different components share they share in these shingles, so these count the
    intersection.
    """
    parts = int(crowded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = texts.join(crowded.select(F.col("doc_id").alias("id"), "component"), "id")
    held = materialise(shingles(held, shingle), "crowded-shingles")
    apart = F.min("component") < F.max("component")
    common = held.groupBy("shingle").agg(F.count("*").alias("holders"), apart.alias("apart")).where("apart").drop("apart")
    own = held.join(common, "shingle").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("holders", "shingle"))).alias("own"))
    first = F.size("own") + 1 - F.expr(f"CAST(({percent} * n_shingles + 99) DIV 100 AS INT)")
    sets = crowded.join(own, crowded["doc_id"] == own["id"]).withColumn("first", first).where("first > 0")
    sets = materialise(
        sets.select("id", "component", F.col("n_shingles").alias("n"), "first", F.col("own.shingle").alias("own")), "crowded-sets"
    )
    prefix = sets.select("id", "component", "n", F.size("own").alias("n_own"), F.posexplode(F.slice("own", 1, F.col("first")))).select(
        "id", "component", "n", (F.col("n_own") - F.col("pos")).alias("left"), F.col("col").alias("shingle")
    )
    shared = prefix.groupBy("shingle").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), apart.alias("apart")).where("apart").drop("apart")
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = prefix.join(shared, "shingle").select(*prefix.columns, block.alias("block"), other)
    keys = ["shingle", "i", "j"]
    dealt = dealt.select("shingle", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", "component", "n", "left")
    # comparisons, not bytes, are the work: as many tasks as the session has partitions
    dealt = dealt.repartition(parts, *keys).sortWithinPartitions(*keys)

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if batch.num_rows:
                held = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
                starts = _group_starts(held)
                yield _alike(held, starts[:-1], starts[1:], percent)
                held = held.slice(starts[-1])
        if held is not None:
            yield _alike(held, np.array([0]), np.array([held.num_rows]), percent)

    pairs = materialise(dealt.mapInArrow(tidy(pair), "a long, b long").distinct(), "crowded-pairs")
    one, other = (sets.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("own").alias(f"own_{x}")) for x in ("a", "b"))
    both = pairs.repartition(parts, "a", "b").join(one, "a").join(other, "b").withColumn("shared", F.size(F.array_intersect("own_a", "own_b")))
    return both.where(f"100 * shared >= {percent} * (n_a + n_b - shared)").select("a", "b")


def near_duplicates(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    percent: int = 75,
    trees: int = TREES,
    agreeing: int = LEAST_AGREEING,
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``."""
    sizes = materialise(sign(documents, doc_id, text, shingle, 0).select("doc_id", "n_shingles", "text_a", "text_b"), "sizes")
    linkable = sizes.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = linkable.groupBy("text_a", "text_b").agg(F.min("doc_id").alias("class_id"), F.max("n_shingles").alias("n_shingles"))
    classes = materialise(classes, "classes")
    given = documents.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where("text IS NOT NULL")
    # the texts that share enough with others to have a partner; only these go on
    total = sizes.agg(F.sum("n_shingles")).first()[0] or 0
    counts = shared_counts(given, total, shingle, percent)
    lacking = classes.withColumn("m", F.expr(f"n_shingles - ({percent} * n_shingles + 99) DIV 100"))
    likely = lacking.join(counts, "text_a").where("shared >= greatest(1, least(n_shingles, 2 * m + 1) - m - 1)").drop("m")
    likely = materialise(likely, "likely")
    # their texts are shuffled once, for all rounds. The ids grow with the input: they are dealt
    # like the texts at every size, never broadcast
    wanted = likely.select(F.col("class_id").alias("id")).distinct()
    texts = materialise(given.join(wanted.hint("merge"), "id", "left_semi").dropDuplicates(["id", "text"]), "texts")
    signed = sign(texts, "id", "text", shingle, trees * STEP)
    own = likely.select(F.col("class_id").alias("doc_id"), "text_a", "text_b")
    first = signed.join(own, ["doc_id", "text_a", "text_b"], "left_semi").select("doc_id", "n_shingles", "signature", "sketch")
    first = materialise(first, "representatives")
    pairs, crowded = forest(first.withColumn("component", F.col("doc_id")), *FIRST_ROUND, trees, percent=percent, agreeing=agreeing)
    links = materialise(confirm(pairs, texts, shingle, percent), "confirmed")
    groups = connected_components(links)

    def place(rows: DataFrame) -> DataFrame:
        placed = rows.join(groups, rows["doc_id"] == groups["node"], "left")
        return placed.select("doc_id", "n_shingles", "signature", "sketch", F.coalesce("component", "doc_id").alias("component"))

    while not crowded.isEmpty():
        among = materialise(place(first.join(crowded, first["doc_id"] == crowded["a"], "left_semi")), "crowded")
        more, crowded = forest(among, *LATER_ROUNDS, trees, percent=percent, agreeing=agreeing)
        more = materialise(more.join(pairs, ["a", "b"], "left_anti"), "more-candidates")
        found = materialise(confirm(more, texts, shingle, percent), "confirmed")
        if found.isEmpty():
            break
        pairs, links = pairs.union(more), links.union(found)
        groups = connected_components(links)
    # whatever the orders, their limits and the rounds left out: all pairs, without a limit
    rest = materialise(join_crowded(materialise(place(first), "placed"), texts, shingle, percent), "last-candidates")
    found = materialise(confirm(rest, texts, shingle, percent), "confirmed")
    if not found.isEmpty():
        groups = connected_components(links.union(found))
    named = classes.join(groups, F.col("class_id") == F.col("node"), "left").select(
        "text_a", "text_b", F.coalesce("component", "class_id").alias("component")
    )
    sized = sizes.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("text_a")).alias("text_a"), "text_b")
    return sized.join(named, ["text_a", "text_b"], "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        (F.col("doc_id").isNull() | F.coalesce("component", "doc_id").eqNullSafe(F.col("doc_id"))).alias("kept"),
    )


def keep_one_of_each(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents less all but the smallest id of each near-duplicate group, columns as given."""
    dropped = near_duplicates(documents, doc_id, text).where(~F.col("kept")).select(F.col("doc_id").alias("_dropped")).distinct()
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row"))
    kept = rows.join(dropped, F.col(f"_row.`{doc_id}`") == F.col("_dropped"), "left_anti")
    return kept.select(*[F.col(f"_row.`{c}`").alias(c) for c in documents.columns])


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from qalens.sources.supplied import read_supplied

    return near_duplicates(read_supplied(spark, sf_dir, "documents"))
