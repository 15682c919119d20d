"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

The n-grams of the benchmark are the only thing broadcast. They are counted first; more than
``max_windows`` of them are dealt into several sets by hash, and the documents are scanned
once per set, so an executor's memory is bounded whatever the benchmark's size.

A document's windows are hashed by array operations; windows whose hash is in the set are
compared word by word before they count. Defined results: null or empty texts have no words,
no hits and are not contaminated; an item with fewer words than ``n`` is one shorter window;
items without words match nothing; repeated items count once per id; a null item id marks
words but is not listed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qalens.llm._shared import materialise, pack, unpack
from qalens.llm._text import ALNUM_WORDS, LOWER_ASCII, cover, tidy, window_hashes, word_chunks

N = 10
#: Windows in one broadcast set; the driver gathers one set at a time.
MAX_WINDOWS = 400_000

_TO_WORDS = bytes(int(LOWER_ASCII[b]) if ALNUM_WORDS[LOWER_ASCII[b]] else 0x20 for b in range(256))


def _spelling(raw: bytes) -> bytes:
    return b" ".join(raw.translate(_TO_WORDS).split())


def benchmark_windows(benchmark: DataFrame, n: int = N, item: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct ``(size, hash, words, items)`` of the benchmark's windows."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in word_chunks(batch.column(1), ALNUM_WORDS, LOWER_ASCII):
                hashes, counts = chunk.hashes(), chunk.counts
                size = np.minimum(counts, n)
                full = chunk.window_starts(n)
                short = chunk.first[:-1][(counts > 0) & (counts < n)]
                starts = np.concatenate((full, short))
                row = np.searchsorted(chunk.first, starts, side="right") - 1
                sizes = size[row]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(sizes, pa.int32()),
                        pa.array(window_hashes(hashes, starts, sizes).view(np.int64), pa.int64()),
                        pa.array([_spelling(chunk.data[chunk.start[s] : chunk.end[s + k - 1]].tobytes()) for s, k in zip(starts, sizes)], pa.binary()),
                        batch.column(0).take(pa.array(chunk.lo + row)).cast(pa.string()),
                    ],
                    ["size", "hash", "words", "item"],
                )

    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text")).mapInArrow(
        tidy(scan), "size int, hash long, words binary, item string"
    )
    return rows.groupBy("size", "hash", "words").agg(F.sort_array(F.collect_set("item")).alias("items"))


class _Set:
    """One broadcast set: sorted hashes by window size, and the items of each spelling."""

    def __init__(self, rows):
        self.items = {(r["size"], bytes(r["words"])): tuple(r["items"]) for r in rows}
        by_size: dict[int, list[int]] = {}
        for r in rows:
            by_size.setdefault(r["size"], []).append(r["hash"])
        self.hashes = {k: np.unique(np.array(v, dtype=np.int64).view(np.uint64)) for k, v in by_size.items()}
        self.coarse = {}
        for k, v in self.hashes.items():
            seen = np.zeros(1 << 20, dtype=bool)
            seen[v >> np.uint64(44)] = True
            self.coarse[k] = seen


def _hits(chunk, index: _Set) -> tuple[np.ndarray, np.ndarray, list[tuple[str, ...]]]:
    """Verified occurrences: first word, size, items."""
    hashes = chunk.hashes()
    starts, sizes, items = [], [], []
    for k, known in index.hashes.items():
        at = chunk.window_starts(k)
        h = window_hashes(hashes, at, k)
        near = np.flatnonzero(index.coarse[k][h >> np.uint64(44)])
        place = np.minimum(np.searchsorted(known, h[near]), len(known) - 1)
        for s in at[near[known[place] == h[near]]]:
            found = index.items.get((k, _spelling(chunk.data[chunk.start[s] : chunk.end[s + k - 1]].tobytes())))
            if found is not None:
                starts.append(s)
                sizes.append(k)
                items.append(found)
    return np.array(starts, dtype=np.int64), np.array(sizes, dtype=np.int64), items


_SPAN = pa.struct([("start", pa.int32()), ("stop", pa.int32())])


def _runs(mark: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marked runs, cut at row edges: where each begins and stops."""
    edge = np.zeros(len(mark) + 1, dtype=bool)
    edge[first] = True
    before = np.concatenate(([False], mark[:-1]))
    after = np.concatenate((mark[1:], [False]))
    return np.flatnonzero(mark & (~before | edge[:-1])), np.flatnonzero(mark & (~after | edge[1:])) + 1


def _scan(documents: DataFrame, index, text: str) -> DataFrame:
    """Documents with ``n_words``, and with ``spans`` and ``items`` grown by one set's hits."""
    schema = T.StructType([f for f in documents.schema if f.name != "n_words"]).add("n_words", "long")
    names = [f.name for f in schema]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = dict(zip(batch.schema.names, batch.columns))
            spans, found = own["spans"].to_pylist(), own["items"].to_pylist()
            n_words = np.zeros(len(spans), dtype=np.int64)
            for chunk in word_chunks(own[text], ALNUM_WORDS, LOWER_ASCII):
                n_words[chunk.lo : chunk.hi] = chunk.counts
                starts, sizes, items = _hits(chunk, index.value)
                if not len(starts):
                    continue
                row = np.searchsorted(chunk.first, starts, side="right") - 1
                gathered: dict[int, set[str]] = {}
                for r, x in zip(row.tolist(), items):
                    gathered.setdefault(r, set()).update(x)
                earlier = [(chunk.first[r] + x["start"], x["stop"] - x["start"]) for r in gathered for x in spans[chunk.lo + r]]
                starts = np.concatenate((starts, np.array([x[0] for x in earlier], dtype=np.int64)))
                sizes = np.concatenate((sizes, np.array([x[1] for x in earlier], dtype=np.int64)))
                begin, stop = _runs(cover(starts, sizes, len(chunk.start)), chunk.first)
                at = np.searchsorted(chunk.first, begin, side="right") - 1
                for r, x in gathered.items():
                    found[chunk.lo + r] = sorted({*found[chunk.lo + r], *x})
                    spans[chunk.lo + r] = []
                for r, b, e in zip(at.tolist(), (begin - chunk.first[at]).tolist(), (stop - chunk.first[at]).tolist()):
                    spans[chunk.lo + r].append({"start": b, "stop": e})
            own |= {"spans": pa.array(spans, pa.list_(_SPAN)), "items": pa.array(found, pa.list_(pa.string())), "n_words": pa.array(n_words)}
            yield pa.RecordBatch.from_arrays([own[c] for c in names], names)

    return documents.mapInArrow(tidy(scan), schema)


def find_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    keep_columns: Sequence[str] = ("doc_id",),
    n: int = N,
    max_windows: int = MAX_WINDOWS,
) -> DataFrame:
    """``keep_columns`` with ``n_words``, ``n_hit``, ``spans`` (word ranges inside benchmark
    windows, disjoint, ascending), ``items`` (ids, sorted as strings) and ``contaminated``."""
    spark = documents.sparkSession
    windows = materialise(benchmark_windows(benchmark, n), "benchmark-windows")
    sets = max(1, -(-windows.count() // max_windows))
    read = list(dict.fromkeys([*keep_columns, text]))
    empty = [F.array().cast("array<struct<start:int,stop:int>>").alias("spans"), F.array().cast("array<string>").alias("items")]
    out = documents.select(*read, *empty)
    for k in range(sets):
        rows = windows.where(F.pmod("hash", F.lit(sets)) == k).collect()  # at most about max_windows
        out = _scan(out, spark.sparkContext.broadcast(_Set(rows)), text)
        if k + 1 < sets:
            out = materialise(out, "decontaminate")
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, x: total + (x["stop"] - x["start"]))
    return out.select(*keep_columns, "n_words", hit.alias("n_hit"), "spans", "items", (F.size("spans") > 0).alias("contaminated"))


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, text: str = "text", n: int = N) -> DataFrame:
    """Documents without any benchmark window, columns as given."""
    flagged = find_contamination(pack(documents, text), benchmark, "_text", ("_row", "_text"), n)
    return unpack(flagged.where(~F.col("contaminated")), documents.columns, text)


def remove_spans(documents: DataFrame, benchmark: DataFrame, text: str = "text", n: int = N) -> DataFrame:
    """Every document with the words inside benchmark windows cut out of ``text`` (the bytes
    from a span's first word to its last one become one space), columns as given."""
    found = find_contamination(pack(documents, text), benchmark, "_text", ("_row", "_text"), n).select("_row", "_text", "spans")
    schema = T.StructType([found.schema["_row"], found.schema["_text"]])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, texts = batch.column(2).to_pylist(), batch.column(1).to_pylist()
            for chunk in word_chunks(batch.column(1), ALNUM_WORDS, LOWER_ASCII):
                for r in range(chunk.lo, chunk.hi):
                    if spans[r]:
                        raw, f, base = texts[r].encode(), chunk.first[r - chunk.lo], chunk.offsets[r - chunk.lo]
                        kept, at = [], 0
                        for x in spans[r]:
                            kept.append(raw[at : chunk.start[f + x["start"]] - base])
                            at = int(chunk.end[f + x["stop"] - 1] - base)
                        texts[r] = b" ".join([*kept, raw[at:]]).decode()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["_row", "_text"])

    return unpack(found.mapInArrow(tidy(cut), schema), documents.columns, text)


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from qalens.sources.supplied import read_supplied

    found = find_contamination(read_supplied(spark, sf_dir, "documents"), read_supplied(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP9_SQL = f"""
WITH item AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
item_at AS (SELECT item_id, w, least(len(w), {N}) AS n, unnest(range(1, greatest(len(w) - {N} + 1, 1) + 1)) AS i FROM item WHERE len(w) > 0),
win AS (SELECT DISTINCT n, list_slice(w, i, i + n - 1) AS words, item_id FROM item_at),
doc AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
doc_at AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM doc),
hit AS (
  SELECT d.doc_id, d.i, s.n, win.item_id
  FROM doc_at d CROSS JOIN (SELECT DISTINCT n FROM win) s
  JOIN win ON win.n = s.n AND win.words = list_slice(d.w, d.i, d.i + s.n - 1)
  WHERE d.i + s.n - 1 <= len(d.w)),
word_hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(doc.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word_hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
