"""Substring deduplication with prefix-partitioned suffix trees.

A window of ``length`` words is repeated if its word sequence also starts anywhere else.
Words covered by a repeated window are removed; windows are judged on the input.

1. *Seeds.* Each window names one of its ``seed``-word sequences, the one with the least
   hash. Equal windows name equal seeds at equal places, so only the suffixes that start at a
   seed (about one word in fourteen) need to enter a tree, and a seed that occurs once in the
   whole corpus has no repeated window. Seeds are counted with partial sums.
2. *Prefix groups.* Suffixes are grouped by their prefix, the seed. Seeds with more than
   ``group_suffixes`` occurrences would not fit a task's memory; their prefix is extended to
   the whole window, where a group is a single inner node and needs only to be counted, again
   with partial sums (``_long_prefixes``). Nothing is dropped either way.
3. *Subtrees.* A task holds a few prefix groups at a time: it sorts their suffixes and takes
   the longest common prefixes of neighbours. The intervals whose common prefix stays at a
   depth are the tree's nodes at that depth; a node with two suffixes that also agree on the
   words left of the seed is a repeat, extended left as far as it is maximal.

Defined results: null and blank texts have no words and lose none; texts shorter than a
window lose none, however often they occur; repeated rows repeat each other's windows (also
with equal ids); an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qalens.llm._shared import materialise
from qalens.llm._text import Words, mix, text_parts, tidy, window_hashes, word_chunks

LENGTH = 35
SEED = 8
GROUP_SUFFIXES = 20_000
#: Suffixes sorted at a time by a task: whole prefix groups, at least this many together.
BATCH_SUFFIXES = 8_000
#: Seeds in one broadcast set (8 bytes each).
BROADCAST_SEEDS = 4_000_000
#: Keys that a window's occurrences are spread over.
SALTS = 64

_ROOT = np.uint64(0x9FB21C651E98DF25)
_NODE = np.uint64(0x9E3779B97F4A7C15)


def _seeds(chunk: Words, word: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start of each window, place of its seed, and the hash of each place's seed."""
    values = np.full(len(word), np.iinfo(np.uint64).max, dtype=np.uint64)
    at = chunk.window_starts(seed)
    values[at] = window_hashes(word, at, seed)
    best, place, width, span = values, np.arange(len(word)), 1, length - seed + 1

    def wider(shift: int):
        """The least of two stretches; the left one where they tie."""
        right = best[shift:] < best[:-shift]
        return np.where(right, best[shift:], best[:-shift]), np.where(right, place[shift:], place[:-shift])

    windows = chunk.window_starts(length)
    if not len(windows):
        return windows, windows, values
    while 2 * width <= span:
        best, place = wider(width)
        width *= 2
    if width < span:
        best, place = wider(span - width)
    return windows, place[windows], values


def _keyed(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id``, ``text`` and two hashes of both: rows are dealt by ``key``; ``check`` goes
    with every result, so rows whose keys collide do not get each other's."""
    body = F.coalesce(F.col(text), F.lit(""))
    return documents.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(doc_id, body).alias("key"), F.xxhash64(F.lit(1), doc_id, body).alias("check"), body.alias("text")
    )


def seed_counts(keyed: DataFrame, length: int, seed: int) -> DataFrame:
    """``(key, seed, n)``: the seeds of each document and how often it has each."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in word_chunks(batch.column(1)):
                windows, place, values = _seeds(chunk, chunk.hashes(), length, seed)
                places = np.unique(place)
                row = np.searchsorted(chunk.first, places, side="right") - 1
                value = values[places]
                order = np.lexsort((value, row))
                row, value = row[order], value[order]
                new = np.ones(len(row), dtype=bool)
                new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
                at = np.flatnonzero(new)
                n = np.diff(np.append(at, len(row)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(chunk.lo + row[at])), pa.array(value[at].view(np.int64)), pa.array(n.astype(np.int32))], ["key", "seed", "n"]
                )

    return keyed.select("key", "text").mapInArrow(tidy(scan), "key long, seed long, n int")


def _runs(with_seeds: DataFrame, length: int, seed: int) -> DataFrame:
    """Maximal runs of windows that name the same occurrence of a listed seed, with their
    words. ``first``: the run's first word in the document; ``seed_at``: the seed's in the run."""
    names = ["seed", "key", "check", "first", "windows", "seed_at", "words"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in word_chunks(batch.column(2)):
                windows, place, values = _seeds(chunk, chunk.hashes(), length, seed)
                head = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(place) else np.empty(0, dtype=np.int64)
                size = np.diff(np.append(head, len(place)))
                row = np.searchsorted(chunk.first, windows[head], side="right") - 1
                listed = batch.column(3).slice(chunk.lo, chunk.hi - chunk.lo)
                known = listed.flatten().to_numpy(zero_copy_only=False)
                owner = np.repeat(np.arange(len(listed)), np.diff(listed.offsets.to_numpy()))
                # a pair (row, seed) is listed: compare through one sorted array of mixed keys
                pairs = np.unique(mix(known.view(np.uint64)) + mix(owner.astype(np.uint64)))
                asked = mix(values[place[head]]) + mix(row.astype(np.uint64))
                found = pairs[np.minimum(np.searchsorted(pairs, asked), max(len(pairs) - 1, 0))] == asked if len(pairs) else np.zeros(len(asked), dtype=bool)
                head, size, row = head[found], size[found], row[found]
                begin = windows[head]
                raw = chunk.data.tobytes()
                words = [raw[a:b] for a, b in zip(chunk.start[begin].tolist(), chunk.end[begin + size + length - 2].tolist())]
                take = pa.array(chunk.lo + row)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(values[place[head]].view(np.int64)),
                        batch.column(0).take(take),
                        batch.column(1).take(take),
                        pa.array((begin - chunk.first[row]).astype(np.int32)),
                        pa.array(size.astype(np.int32)),
                        pa.array((place[head] - begin).astype(np.int32)),
                        pa.array(words, pa.binary()),
                    ],
                    names,
                )

    return with_seeds.mapInArrow(tidy(scan), "seed long, key long, check long, first int, windows int, seed_at int, words binary")


def _repeated(chunk: Words, windows: np.ndarray, seed_at: np.ndarray, length: int, seed: int) -> np.ndarray:
    """For each run and each of its windows: whether another suffix has the same words.

    The suffixes that start at the seeds are sorted; neighbours' common prefixes give the
    nodes of the suffix tree at every depth that matters.
    """
    word, n = chunk.hashes(), len(windows)
    anchor = chunk.first[:-1] + seed_at
    right = chunk.first[1:] - anchor
    deep = int(right.max())
    reach = np.arange(deep)
    inside = reach < right[:, None]
    suffix = np.where(inside, word[np.minimum(anchor[:, None] + reach, len(word) - 1)], np.uint64(0))
    order = np.argsort(suffix.astype(">u8").view(f"S{8 * deep}").ravel(), kind="stable")
    suffix = suffix[order]
    differ = suffix[1:] != suffix[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), deep)
    anchor, seed_at, windows = anchor[order], seed_at[order], windows[order]
    left = np.zeros(n, dtype=np.uint64)
    out = np.zeros((n, length - seed + 1), dtype=bool)
    for before in range(length - seed + 1):
        if before:
            left = left * _ROOT + word[np.maximum(anchor - before, 0)]
        rows = np.flatnonzero((before <= seed_at) & (before > seed_at - windows))
        if not len(rows):
            continue
        node = np.concatenate(([0], np.cumsum(common < length - before))).astype(np.uint64)
        _, which, count = np.unique(mix(left[rows] + node[rows] * _NODE), return_inverse=True, return_counts=True)
        hit = rows[count[which] > 1]
        out[hit, seed_at[hit] - before] = True
    back = np.empty_like(out)
    back[order] = out
    return back


def _trees(runs: DataFrame, length: int, seed: int, batch_suffixes: int) -> DataFrame:
    """``(key, check, start, stop)``: word ranges inside repeated windows."""

    def build(table: pa.Table) -> Iterator[pa.RecordBatch]:
        columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in table.columns]
        first, windows, seed_at = (columns[i].to_numpy() for i in (3, 4, 5))
        (chunk,) = word_chunks(columns[6], chunk_bytes=1 << 62)
        flags = _repeated(chunk, windows.astype(np.int64), seed_at.astype(np.int64), length, seed)
        wide = np.zeros((len(flags), flags.shape[1] + 2), dtype=np.int8)
        wide[:, 1:-1] = flags
        step = np.diff(wide, axis=1)
        row, begin = np.nonzero(step == 1)
        _, end = np.nonzero(step == -1)
        take = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [columns[1].take(take), columns[2].take(take), pa.array((first[row] + begin).astype(np.int32)), pa.array((first[row] + end + length - 1).astype(np.int32))],
            ["key", "check", "start", "stop"],
        )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = cut = 0  # rows held, and where among them the last group begins: it may go on
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            seeds = batch.column(0).to_numpy()
            if seeds[-1] != last:
                last, cut = seeds[-1], rows + int(np.searchsorted(seeds, seeds[-1]))
            held.append(batch)
            rows += batch.num_rows
            if cut >= batch_suffixes:
                table = pa.Table.from_batches(held)
                yield from build(table.slice(0, cut))
                held, rows, cut = table.slice(cut).to_batches(), rows - cut, 0
        if held:
            yield from build(pa.Table.from_batches(held))

    sorted_runs = runs.repartition("seed").sortWithinPartitions("seed")
    return sorted_runs.mapInArrow(tidy(scan), "key long, check long, start int, stop int")


def _long_prefixes(keyed: DataFrame, common: DataFrame, length: int, seed: int) -> DataFrame:
    """The same ranges for the ``common`` seeds, those with too many suffixes for a task: the
    prefix is the whole window (128 hash bits), so its group is one node, counted with partial
    sums. Windows are counted and joined back by (window, salt), so the occurrences of a very
    common one are spread over ``SALTS`` keys. Texts are scanned once more but not shuffled.

    Common seeds are broadcast: there are at most (all suffixes / ``group_suffixes``) of them,
    dealt into sets of ``BROADCAST_SEEDS``."""
    spark, windows = keyed.sparkSession, None
    sets = -(-common.count() // BROADCAST_SEEDS)
    for k in range(sets):
        part = common.where(F.pmod("seed", F.lit(sets)) == k).collect()
        known = spark.sparkContext.broadcast(np.unique(np.array([r["seed"] for r in part], dtype=np.int64).view(np.uint64)))
        own = keyed.select("key", "check", "text").mapInArrow(tidy(_windows_of(known, length, seed)), "window_a long, window_b long, key long, check long, start int")
        windows = own if windows is None else windows.union(own)
    windows = materialise(windows.withColumn("salt", F.pmod("key", F.lit(SALTS)).cast("int")), "windows")
    # counted by window and salt, then by window: no task ever holds one window's occurrences
    parts = materialise(windows.groupBy("window_a", "window_b", "salt").agg(F.count("*").alias("n")), "window-parts")
    twice = parts.groupBy("window_a", "window_b").agg(F.sum("n").alias("n")).where("n > 1").select("window_a", "window_b")
    places = parts.join(twice, ["window_a", "window_b"]).select("window_a", "window_b", "salt")
    kept = windows.join(places, ["window_a", "window_b", "salt"])
    return kept.select("key", "check", "start", (F.col("start") + length).alias("stop"))


def _windows_of(known, length: int, seed: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = known.value
        for batch in batches:
            for chunk in word_chunks(batch.column(2)):
                word = chunk.hashes()
                at, place, values = _seeds(chunk, word, length, seed)
                if not len(common) or not len(at):
                    continue
                asked = values[place]
                at = at[common[np.minimum(np.searchsorted(common, asked), len(common) - 1)] == asked]
                row = np.searchsorted(chunk.first, at, side="right") - 1
                take = pa.array(chunk.lo + row)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(window_hashes(word, at, length).view(np.int64)),
                        pa.array(window_hashes(mix(word + np.uint64(5)), at, length).view(np.int64)),
                        batch.column(0).take(take),
                        batch.column(1).take(take),
                        pa.array((at - chunk.first[row]).astype(np.int32)),
                    ],
                    ["window_a", "window_b", "key", "check", "start"],
                )

    return scan


def repeated_ranges(
    keyed: DataFrame, length: int = LENGTH, seed: int = SEED, group_suffixes: int = GROUP_SUFFIXES, batch_suffixes: int = BATCH_SUFFIXES
) -> DataFrame:
    """``(key, ranges)``: for documents with any, the word ranges to remove, each with the
    document's ``check``."""
    if not 0 < seed <= length:
        raise ValueError("a seed has at least one word and at most a window's")
    found = materialise(seed_counts(keyed, length, seed), "seeds")
    counts = materialise(found.groupBy("seed").agg(F.sum("n").alias("suffixes")).where("suffixes > 1"), "repeated-seeds")

    # dealt by key before they are listed: lists are larger than their rows
    few = counts.where(F.col("suffixes") <= group_suffixes).select("seed")
    listed = found.join(few, "seed").select("key", "seed").repartition("key").groupBy("key").agg(F.collect_list("seed").alias("seeds"))
    # with the id, this shuffle of the texts is the one that the removal reads again
    with_seeds = keyed.join(listed, "key").select("key", "check", "text", "seeds", "doc_id")
    ranges = _trees(_runs(with_seeds, length, seed), length, seed, batch_suffixes)
    common = counts.where(F.col("suffixes") > group_suffixes)
    if not common.isEmpty():
        ranges = ranges.union(_long_prefixes(keyed, common, length, seed))
    return ranges.repartition("key").groupBy("key").agg(F.collect_list(F.struct("check", "start", "stop")).alias("ranges"))


def remove_repeats(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    seed: int = SEED,
    group_suffixes: int = GROUP_SUFFIXES,
    batch_suffixes: int = BATCH_SUFFIXES,
) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_text)``; kept words are joined by one space."""
    keyed = _keyed(documents, doc_id, text)
    both = keyed.join(repeated_ranges(keyed, length, seed, group_suffixes, batch_suffixes), "key", "left").select("doc_id", "check", "text", "ranges")
    kind = both.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in text_parts(batch, 2)):
            sizes, removed, kept = [], [], []
            for check, body, ranges in zip(part.column(1).to_pylist(), part.column(2).cast(pa.binary()).to_pylist(), part.column(3).to_pylist()):
                words = body.split()
                sizes.append(len(words))
                if ranges:
                    left, at = [], 0
                    for x in sorted((x for x in ranges if x["check"] == check), key=lambda x: x["start"]):
                        left += words[at : max(at, x["start"])]
                        at = max(at, x["stop"])
                    words = left + words[at:]
                removed.append(sizes[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_text"],
            )

    return both.mapInArrow(tidy(cut), f"doc_id {kind}, n_words long, n_removed long, kept_text string")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from qalens.sources.supplied import read_supplied

    kept = remove_repeats(read_supplied(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
