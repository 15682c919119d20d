"""Fill-in-the-middle transformation with a compressed set of token boundaries.

A text's tokens are ``[A-Za-z]+`` or any other single code point. The code points at which
tokens start form a :class:`BoundarySet`: 65,536 positions to a container, each kept as a
sorted array, a bitmap or a list of runs, whichever is smallest, with cumulative
cardinalities over the containers. The number of tokens is the set's cardinality, and the
place of the k-th token is one search over the containers and one select inside one of
them, so both cuts of a text come from the set and not from a list of its tokens.

The cuts depend on the seed and the row's id only through SHA-256, so a rerun, a lost
executor or another partitioning gives the same training example. Only the text and two
integers enter Python (Arrow batches, cut into parts of bounded size); the output is put
together by Spark from the two offsets.

Defined results: a null or empty text has no tokens and stays plain (empty); a text that
holds one of the marks stays plain whatever the id says, so every output can be taken apart
again; a null id is hashed as the empty string; repeated rows give repeated rows; extra
columns are kept whatever they are called.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qalens.llm._shared import pack, unpack
from qalens.llm._text import string_buffers
from qalens.sources.supplied import read_supplied

#: The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SPM_BELOW = 90, 20
#: Positions of a container, and of a text handled at a time.
SPAN = 1 << 16
PART_BYTES = 1 << 20

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True


class _Array:
    """Sorted positions."""

    def __init__(self, mask: np.ndarray):
        self.places = np.flatnonzero(mask).astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.places[k])


class _Bitmap:
    """One bit a position, with the number of set bits before each 64-bit word."""

    def __init__(self, mask: np.ndarray):
        bits = np.packbits(mask, bitorder="little")
        self.words = np.pad(bits, (0, -len(bits) % 8)).view(np.uint64)
        self.before = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, side="right"))
        word, left = int(self.words[at]), k - (int(self.before[at - 1]) if at else 0)
        for _ in range(left):
            word &= word - 1
        return at * 64 + (word & -word).bit_length() - 1


class _Runs:
    """First positions of runs, with the number of positions before each run."""

    def __init__(self, mask: np.ndarray):
        step = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
        self.first = np.flatnonzero(step == 1)
        lengths = np.flatnonzero(step == -1) - self.first
        self.before = np.cumsum(lengths) - lengths

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.first[at]) + k - int(self.before[at])


def _container(mask: np.ndarray, size: int) -> _Array | _Bitmap | _Runs:
    runs = int(np.count_nonzero(mask[1:] & ~mask[:-1])) + int(mask[0])
    cost = {_Runs: 4 * runs, _Array: 2 * size, _Bitmap: SPAN // 8}
    return min(cost, key=cost.get)(mask)


class BoundarySet:
    """A set of positions below ``length`` that answers ``select``: the k-th smallest, from 0.

    Empty stretches of ``SPAN`` positions have no container. ``cumulative[i]`` positions lie
    before container ``i``.
    """

    def __init__(self, mask: np.ndarray):
        self.length = len(mask)
        self.keys, self.containers, sizes = [], [], []
        for lo in range(0, len(mask), SPAN):
            part = mask[lo : lo + SPAN]
            size = int(np.count_nonzero(part))
            if size:
                self.keys.append(lo)
                self.containers.append(_container(part, size))
                sizes.append(size)
        self.cumulative = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))).astype(np.int64)

    def __len__(self) -> int:
        return int(self.cumulative[-1])

    def select(self, k: int) -> int:
        """Position of member ``k``; ``length`` for one past the last."""
        if k == len(self):
            return self.length
        at = int(np.searchsorted(self.cumulative, k, side="right")) - 1
        return self.keys[at] + self.containers[at].select(k - int(self.cumulative[at]))


def _boundaries(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the texts' code points, which ones start a token; and the texts' first code points."""
    off = offsets - offsets[0]
    chunk = data[offsets[0] : offsets[-1]]
    lead = (chunk & 0xC0) != 0x80
    letter = _LETTER[chunk]
    inside = np.zeros(len(chunk), dtype=bool)
    inside[1:] = letter[1:] & letter[:-1]
    inside[off[:-1][off[:-1] < len(chunk)]] = False
    points = np.concatenate(([0], np.cumsum(lead, dtype=np.int64)))
    return ~inside[lead], points[off]


def cuts(text: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
    """``(n, prefix_chars, middle_chars)`` of each text, cut after ``one % (n + 1)`` and
    ``two % (n + 1)`` tokens."""
    data, offsets = string_buffers(text)
    a, b = one.to_numpy(zero_copy_only=False), two.to_numpy(zero_copy_only=False)
    rows = len(offsets) - 1
    out = np.zeros((3, rows), dtype=np.int64)
    lo = 0
    while lo < rows:
        hi = int(np.searchsorted(offsets, offsets[lo] + PART_BYTES, side="right")) - 1
        hi = min(max(hi, lo + 1), rows)
        starts, first = _boundaries(data, offsets[lo : hi + 1])
        for r in range(lo, hi):
            tokens = BoundarySet(starts[first[r - lo] : first[r - lo + 1]])
            n = len(tokens)
            x, y = int(a[r]) % (n + 1), int(b[r]) % (n + 1)
            head, tail = tokens.select(min(x, y)), tokens.select(max(x, y))
            out[:, r] = n, head, tail - head
        lo = hi
    return pa.StructArray.from_arrays([pa.array(c) for c in out], ["n", "prefix_chars", "middle_chars"])


def draws(id: str, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers of a row: the first groups of SHA-256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def fill_in_middle(documents: DataFrame, *, id: str = "doc_id", text: str = "text", seed: int = 1) -> DataFrame:
    """The documents' columns and ``n`` (tokens), ``form`` (``plain``, ``psm`` or ``spm``),
    ``prefix_chars``, ``middle_chars`` (code points, null if plain) and ``output``, the
    training text. A column of the documents with one of these names is replaced.

    No shuffle: one pass over the texts.
    """

    @F.arrow_udf("n long, prefix_chars long, middle_chars long")
    def cut(words: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
        return cuts(words, one, two)

    names = ("n", "form", "prefix_chars", "middle_chars", "output")
    if {id, text} & set(names):
        raise ValueError(f"the id and text columns may not be called {names}")
    kept = [c for c in documents.columns if c not in names]
    packed = pack(documents.select(*[F.col(f"`{c}`") for c in kept]), text)
    packed = packed.withColumn("_h", F.array(*draws("_text" if id == text else f"_row.`{id}`", seed)))
    body = F.coalesce(F.col("_text"), F.lit(""))
    packed = packed.withColumn("_cut", cut(F.col("_text"), F.col("_h")[0], F.col("_h")[1]))
    marked = F.contains(body, F.lit(PREFIX)) | F.contains(body, F.lit(SUFFIX)) | F.contains(body, F.lit(MIDDLE))
    plain = (body == "") | marked | (F.col("_h")[2] % 100 >= PLAIN_FROM)
    form = F.when(plain, "plain").when(F.col("_h")[3] % 100 < SPM_BELOW, "spm").otherwise("psm")
    packed = packed.withColumn("_form", form)
    head, mid = F.col("_cut.prefix_chars"), F.col("_cut.middle_chars")
    prefix = F.substring(body, F.lit(1), head)
    middle = F.substring(body, head + 1, mid)
    suffix = F.substring(body, head + mid + 1, F.lit(2**31 - 1))
    p, s, m = F.lit(PREFIX), F.lit(SUFFIX), F.lit(MIDDLE)
    output = (
        F.when(F.col("_form") == "plain", body)
        .when(F.col("_form") == "psm", F.concat(p, prefix, s, suffix, m, middle))
        .otherwise(F.concat(s, suffix, p, prefix, m, middle))
    )
    cut_only = F.col("_form") != "plain"
    return unpack(
        packed, kept, text,
        F.col("_cut.n").alias("n"), F.col("_form").alias("form"),
        F.when(cut_only, head).alias("prefix_chars"), F.when(cut_only, mid).alias("middle_chars"),
        output.alias("output"),
    )


def restored(output: str = "output", form: str = "form") -> Column:
    """The text before the transformation, from its output and form alone.

    A transformed text holds each mark once (texts with a mark stay plain, and no mark can
    arise across a cut, because a mark starts with its only ``<``), so splitting at the marks
    gives the three parts."""
    parts = F.split(F.col(output), f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (
        F.when(F.col(form) == "plain", F.col(output))
        .when(F.col(form) == "psm", F.concat(parts[1], parts[3], parts[2]))
        .otherwise(F.concat(parts[2], parts[3], parts[1]))
    )


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut and put together again: digests of the output and of the text
    restored from it."""
    out = fill_in_middle(read_supplied(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"),
    )


OP11_SQL = f"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), drawn AS (
  SELECT *, len(w) AS n, ('0x' || h[1:8])::BIGINT % (len(w) + 1) AS x, ('0x' || h[9:16])::BIGINT % (len(w) + 1) AS y,
         CASE WHEN t = '' OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}')
                   OR ('0x' || h[17:24])::BIGINT % 100 >= {PLAIN_FROM} THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < {SPM_BELOW} THEN 'spm' ELSE 'psm' END AS form
  FROM cut
), parts AS (
  SELECT *, array_to_string(w[1:least(x, y)], '') AS p, array_to_string(w[least(x, y) + 1:greatest(x, y)], '') AS m,
         array_to_string(w[greatest(x, y) + 1:], '') AS s
  FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
                        ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""
