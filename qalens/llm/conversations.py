"""Conversation structure repair by Four-Russians block tables.

A conversation's rows, in order, become symbols: the role's initial (``s``, ``u``, ``a``,
other) and the row's first fault. The cheapest edits (keep, rerole, delete, insert) that make
the roles read ``(s?(ua)+)?`` are a shortest path over four states of that pattern. The costs
of the four states after a row, less their minimum, can only take a few dozen values (a state
so dear that no cheapest path passes it counts as unreachable), so every such vector has a
number, and a table holds, for every vector and every block of ``BLOCK`` symbols, the vector
after the block and the cost it adds. A conversation is priced block by block, by lookup.
Then the blocks are expanded again from the last to the first, and every move that lies on
any cheapest path is noted; the walk forward takes the move whose initial is least, which
gives the least of all cheapest edit strings.

Rows are dealt by ranges of (conversation, turn) and sorted, so a conversation with a third
of all rows is cut over as many tasks as its rows ask for. A conversation that lies within
one task (all but the outermost of each task, up to ``CHUNK_ROWS`` rows) is repaired there.
Of the others the tasks keep chunks; repeated rows are found between chunks by their digests,
the symbols (a byte a row, no more than the edit string that is asked for) are solved in
order, and the chunks are then repaired in parallel.

Order and ties: rows go by turn, nulls first, then role, then the MD5 of role and text; equal
rows are interchangeable. Rows count as equal if their 128-bit digests are.

Defined results: null roles and texts count as one space, a null conversation id is a
conversation, null turns are left out of ``gaps``; a conversation without rows (marked by
``present`` = false) has zeros and no edits; an empty table gives no rows; extra columns are
not read.
"""

from __future__ import annotations

import functools
import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from qalens.llm._shared import materialise
from qalens.llm._text import tidy
from qalens.sources.supplied import read_supplied

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLOCK = 4
#: Rows and bytes of text of a conversation that a task holds before it writes a chunk.
CHUNK_ROWS = 4096
CHUNK_BYTES = 1 << 20
#: Rows and bytes of an output batch.
BATCH_ROWS, BATCH_BYTES = 512, 4 << 20

# States: 0 nothing yet, 1 after s, 2 after u, 3 after a (0 and 3 may end).
_KEPT = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}  # (state, initial s u a) -> state
_NEXT = (2, 2, 3, 2)  # the state after the role that is asked for next
_ASKED = ("user", "user", "assistant", "user")
_NEVER = 99
_D, _I, _K, _R = 1, 2, 4, 8
_LETTER = {_D: ord("D"), _I: ord("I"), _K: ord("K"), _R: ord("R")}
# A symbol is 4 * fault + initial; faults: 0 none, 1 truncated, 2 blank, 3 duplicate. Blank and
# duplicate rows all have class 8: they must go, whatever their role.
_CLASSES, _MUST_GO = 9, 8
_CLASS = bytes([min(s, _MUST_GO) for s in range(16)]) + bytes(240)
_OK_PAIRS = ((0, 1), (1, 2), (2, 1))


def _moves(state: int, kind: int) -> list[tuple[int, int, int]]:
    """(letter, cost, next state) of a row of the class in the state."""
    out = [(_D, DELETE, state)]
    if kind != _MUST_GO:
        extra = TRUNCATED * (kind // 4)
        if (state, kind % 4) in _KEPT:
            out.append((_K, KEEP + extra, _KEPT[state, kind % 4]))
        out.append((_R, REROLE + extra, _NEXT[state]))
    return out


def _settled(costs: list[int]) -> tuple[tuple[int, ...], int]:
    """The costs after any insertions, less their minimum, and that minimum."""
    costs = list(costs)
    for _ in range(2):
        for s in range(4):
            costs[_NEXT[s]] = min(costs[_NEXT[s]], costs[s] + INSERT)
    # what state 0 can still do, state 3 can do too, for a deletion (of an s) more at most;
    # what state 1 can do, state 3 can do: dearer than that, no cheapest path passes them
    if costs[0] > costs[3] + DELETE:
        costs[0] = _NEVER
    if costs[1] > costs[3]:
        costs[1] = _NEVER
    least = min(costs)
    return tuple(c if c >= _NEVER else c - least for c in costs), least


class _Tables:
    """Vectors by number; what each row, each block and each backward step does to them."""

    def __init__(self, block: int = BLOCK):
        start, _ = _settled([0, _NEVER, _NEVER, _NEVER])
        self.block, self.vectors, number = block, [start], {start: 0}
        self.step: list[list[tuple[int, int]]] = []
        for v in self.vectors:  # grows while it is read
            row = []
            for kind in range(_CLASSES):
                costs = [_NEVER] * 4
                for s in range(4):
                    if v[s] < _NEVER:
                        for _, cost, t in _moves(s, kind):
                            costs[t] = min(costs[t], v[s] + cost)
                after, added = _settled(costs)
                if after not in number:
                    number[after] = len(self.vectors)
                    self.vectors.append(after)
                row.append((number[after], added))
            self.step.append(row)
        to = np.array([[t for t, _ in row] for row in self.step])
        add = np.array([[a for _, a in row] for row in self.step])
        blocks, added = np.arange(len(to))[:, None], np.zeros((len(to), 1), dtype=np.int64)
        for _ in range(block):  # one more symbol at the end of every block
            added = (added[:, :, None] + add[blocks]).reshape(len(to), -1)
            blocks = to[blocks].reshape(len(to), -1)
        self.blocks, self.added = [r.tolist() for r in blocks], [r.tolist() for r in added]
        self.back = [[[self._back(v, k, n) for n in range(16)] for k in range(_CLASSES)] for v in range(len(to))]
        self.end = [self._end(v) for v in range(len(to))]

    def _with_inserts(self, v: tuple[int, ...], letters: list[int], open_: int) -> tuple[int, int]:
        for _ in range(2):
            for s in range(4):
                t = _NEXT[s]
                if v[s] < _NEVER and v[s] + INSERT == v[t] and open_ >> t & 1:
                    letters[s] |= _I
                    open_ |= 1 << s
        return open_, sum(x << 4 * s for s, x in enumerate(letters))

    def _back(self, number: int, kind: int, after: int) -> tuple[int, int]:
        """Which states before the row lie on a cheapest path, given those after it, and the
        letters of their moves (four bits a state)."""
        v, (to, added) = self.vectors[number], self.step[number][kind]
        letters = [0] * 4
        for s in range(4):
            if v[s] < _NEVER:
                for letter, cost, t in _moves(s, kind):
                    if after >> t & 1 and v[s] + cost == self.vectors[to][t] + added:
                        letters[s] |= letter
        return self._with_inserts(v, letters, sum(1 << s for s in range(4) if letters[s]))

    def _end(self, number: int) -> tuple[int, int, int]:
        v = self.vectors[number]
        least = min(v[0], v[3])
        return (*self._with_inserts(v, [0] * 4, sum(1 << s for s in (0, 3) if v[s] == least)), least)


@functools.cache
def tables(block: int = BLOCK) -> _Tables:
    return _Tables(block)


def solve(symbols: bytes, block: int = BLOCK) -> tuple[int, str]:
    """The cost and the ASCII-least string of the cheapest edits of a symbol string."""
    t = tables(block)
    kinds = symbols.translate(_CLASS)
    whole = len(kinds) // block * block
    places = _CLASSES ** np.arange(block - 1, -1, -1)
    codes = np.frombuffer(kinds[:whole], dtype=np.uint8).reshape(-1, block) @ places
    vector, cost, starts = 0, 0, array("i")
    for code in codes.tolist():
        starts.append(vector)
        cost += t.added[vector][code]
        vector = t.blocks[vector][code]
    starts.append(vector)
    for kind in kinds[whole:]:
        vector, added = t.step[vector][kind]
        cost += added
    open_, last, least = t.end[vector]
    letters = array("H", [last])
    for at in range(len(starts) - 1, -1, -1):  # the blocks, expanded from the last to the first
        vector, inside = starts[at], []
        part = kinds[at * block : (at + 1) * block]
        for kind in part:
            inside.append(vector)
            vector = t.step[vector][kind][0]
        for kind, vector in zip(reversed(part), reversed(inside)):
            open_, moves = t.back[vector][kind][open_]
            letters.append(moves)
    letters.reverse()
    audit, state, row = bytearray(), 0, 0
    while moves := letters[row] >> 4 * state & 15:
        letter = moves & -moves
        audit.append(_LETTER[letter])
        if letter == _K:
            state = _KEPT[state, kinds[row] % 4]
        elif letter != _D:
            state = _NEXT[state]
        row += letter != _I
    return cost + least, audit.decode()


_solve_short = functools.lru_cache(maxsize=1 << 16)(solve)


def _apply(audit: str, symbols: bytes, roles: list[str], texts: list[str], state: int) -> tuple[list[str], list[str], int]:
    """The repaired roles and texts, and the state after them."""
    new_roles, new_texts, row = [], [], 0
    for letter in audit:
        if letter == "I":
            new_roles.append(_ASKED[state])
            new_texts.append("")
            state = _NEXT[state]
            continue
        if letter == "K":
            new_roles.append(roles[row])
            new_texts.append(texts[row])
            state = _KEPT[state, symbols[row] % 4]
        elif letter == "R":
            new_roles.append(_ASKED[state])
            new_texts.append(texts[row])
            state = _NEXT[state]
        row += 1
    return new_roles, new_texts, state


def _counts(symbols: bytes) -> tuple[int, int, int, int]:
    """Blank, duplicate and truncated rows; neighbours whose roles may not follow each other."""
    s = np.frombuffer(symbols, dtype=np.uint8)
    faults, roles = np.bincount(s >> 2, minlength=4), s & 3
    fine = sum(int(np.count_nonzero((roles[:-1] == a) & (roles[1:] == b))) for a, b in _OK_PAIRS)
    return int(faults[2]), int(faults[3]), int(faults[1]), max(len(s) - 1, 0) - fine


class _Rows:
    """Rows of one conversation, in order."""

    def __init__(self, conversation):
        self.conversation, self.is_chunk = conversation, False
        self.clear()

    def clear(self) -> None:
        self.symbols, self.roles, self.texts, self.bytes = bytearray(), [], [], 0
        self.seen: dict[bytes, int] = {}
        self.low = self.high = None
        self.turns = 0

    def add(self, turn, role: str, text: str, digest: bytes, symbol: int) -> None:
        if turn is not None:
            if self.low is None:
                self.low = turn
            self.turns += turn != self.high
            self.high = turn
        if symbol < 8 and self.seen.setdefault(digest, len(self.symbols)) != len(self.symbols):
            symbol = 12 + symbol % 4
        self.symbols.append(symbol)
        self.roles.append(role)
        self.texts.append(text)
        self.bytes += len(text)

    def chunk(self, place: int) -> dict:
        return {
            "conversation": self.conversation, "chunk": place, "symbols": bytes(self.symbols), "roles": self.roles,
            "texts": self.texts, "low": self.low, "high": self.high, "turns": self.turns,
            "firsts": [{"digest": d, "row": i} for d, i in self.seen.items()],
        }

    def repaired(self) -> dict:
        symbols = bytes(self.symbols)
        cost, audit = (_solve_short if len(symbols) <= 32 else solve)(symbols)
        roles, texts, _ = _apply(audit, symbols, self.roles, self.texts, 0)
        blank, duplicate, truncated, illegal = _counts(symbols)
        return {
            "conversation": self.conversation, "gaps": self.high - self.low + 1 - self.turns if self.turns else 0, "blank": blank,
            "duplicate": duplicate, "truncated": truncated, "illegal": illegal, "cost": cost, "audit": audit,
            "roles": roles, "texts": texts,
        }


def _in_batches(rows: Iterator[tuple[dict, int]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row, n in rows:
        held.append(row)
        size += n
        if len(held) >= BATCH_ROWS or size >= BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _records(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def _scan(chunk_rows: int, chunk_bytes: int, schema: pa.Schema):
    """Sorted rows of a task: whole conversations are repaired, the rest is kept as chunks."""

    def rows(batches) -> Iterator[tuple[dict, int]]:
        place = TaskContext.get().partitionId() << 32
        run, first = None, True
        for conversation, turn, present, role, text, digest, symbol in _records(batches):
            if run is None or conversation != run.conversation:
                if run is not None:
                    if first or run.is_chunk:  # may go on in, or come from, another task
                        yield run.chunk(place), run.bytes
                        place += 1
                    else:
                        yield run.repaired(), run.bytes
                    first = False
                run = _Rows(conversation)
            if present:
                run.add(turn, role, text, digest, symbol)
                if len(run.symbols) >= chunk_rows or run.bytes >= chunk_bytes:
                    yield run.chunk(place), run.bytes
                    place += 1
                    run.clear()
                    run.is_chunk = True
        if run is not None:
            yield run.chunk(place), run.bytes

    return tidy(lambda batches: _in_batches(rows(batches), schema))


def _solve_chunks(schema: pa.Schema):
    """Chunks in order, without texts: each gets its part of the edits and the state it starts in;
    the first one of a conversation also the results."""

    def finish(held: list[tuple]) -> Iterator[tuple[dict, int]]:
        symbols = b"".join(h[2] for h in held)
        cost, audit = solve(symbols)
        blank, duplicate, truncated, illegal = _counts(symbols)
        turns = gaps = 0
        low = high = None
        for _, _, _, lo, hi, n in held:
            if n:
                low = lo if low is None else low
                turns += n - (lo == high)
                high = hi
        if turns:
            gaps = high - low + 1 - turns
        results = {"gaps": gaps, "blank": blank, "duplicate": duplicate, "truncated": truncated, "illegal": illegal}
        at, state = 0, 0
        for i, (conversation, chunk, part, *_) in enumerate(held):
            stop, left, after = at, len(part), state
            while stop < len(audit) and (left or i == len(held) - 1):
                left -= audit[stop] != "I"
                stop += 1
            row = 0
            for letter in audit[at:stop]:
                if letter == "K":
                    after = _KEPT[after, part[row] % 4]
                elif letter != "D":
                    after = _NEXT[after]
                row += letter != "I"
            whole = {**results, "cost": cost, "audit": audit} if i == 0 else {}
            yield {"conversation": conversation, "chunk": chunk, "edits": audit[at:stop], "state": state, **whole}, stop - at
            at, state = stop, after

    def rows(batches) -> Iterator[tuple[dict, int]]:
        held: list[tuple] = []
        for conversation, chunk, symbols, again, low, high, turns in _records(batches):
            if held and held[0][0] != conversation:
                yield from finish(held)
                held = []
            if again:
                symbols = bytearray(symbols)
                for i in again:
                    symbols[i] = 12 + symbols[i] % 4
            held.append((conversation, chunk, bytes(symbols), low, high, turns))
        if held:
            yield from finish(held)

    return tidy(lambda batches: _in_batches(rows(batches), schema))


def _repair_chunks(schema: pa.Schema):
    def rows(batches) -> Iterator[tuple[dict, int]]:
        for chunk, symbols, roles, texts, edits, state in _records(batches):
            new_roles, new_texts, _ = _apply(edits, symbols, roles, texts, state)
            yield {"chunk": chunk, "roles": new_roles, "texts": new_texts}, sum(map(len, texts))

    return tidy(lambda batches: _in_batches(rows(batches), schema))


_RESULTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_RESULT_TYPES = ", ".join(f"{c} long" for c in _RESULTS) + ", audit string"


def _schemas(df: DataFrame, rest: str) -> tuple[StructType, pa.Schema]:
    """The Spark and the Arrow schema of the conversation id and ``rest``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = StructType([df.schema["conversation"], *StructType.fromDDL(rest).fields])
    return schema, to_arrow_schema(schema)


def _first_fault(text: str, role: str) -> Column:
    """4 * fault + initial, but for duplicates."""
    trimmed = F.rtrim(F.col(text), F.lit(" \t\n\x0b\x0c\r"))
    fault = F.when(trimmed == "", 2).when(F.right(trimmed, F.lit(1)).isin(".", "!", "?"), 0).otherwise(1)
    initial = F.substring(role, 1, 1)
    return (fault * 4 + F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)).cast("int")


def repair_conversations(
    rows: DataFrame,
    *,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    present: str | None = None,
    chunk_rows: int = CHUNK_ROWS,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Repaired conversations: ``conversation``, ``part`` (null for the only part of one; else
    its parts in order of this number), ``gaps``, ``blank``, ``duplicate``, ``truncated``,
    ``illegal``, ``cost``, ``audit`` (on the first part, null on the others), ``roles`` and
    ``texts`` (the repaired rows of the part).

    ``present`` names a column that is false for rows that are not there: they only keep their
    conversation in the result.
    """
    named = rows.select(
        F.col(conversation).alias("conversation"), F.col(turn).cast("bigint").alias("turn"),
        (F.col(present) if present else F.lit(True)).alias("present"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )
    named = named.withColumn("digest", F.unhex(F.md5(F.concat("role", F.lit("\0"), "text"))))
    named = named.withColumn("symbol", _first_fault("text", "role"))
    order = ["conversation", "turn", "role", "digest"]
    ordered = named.repartitionByRange(*order).sortWithinPartitions(*order)
    schema, arrow = _schemas(
        ordered,
        f"{_RESULT_TYPES}, roles array<string>, texts array<string>, chunk long, symbols binary, "
        "firsts array<struct<digest: binary, row: int>>, low long, high long, turns long",
    )
    scanned = materialise(ordered.mapInArrow(_scan(chunk_rows, chunk_bytes, arrow), schema), "conversations")
    whole = scanned.where("chunk IS NULL").select("conversation", F.col("chunk").alias("part"), *_RESULTS, "audit", "roles", "texts")

    chunks = scanned.where("chunk IS NOT NULL")
    # a row that is the first of its kind in its chunk is a duplicate if an earlier chunk has one
    digests = chunks.select("conversation", "chunk", F.explode("firsts").alias("f")).select("conversation", "chunk", "f.digest", "f.row")
    earliest = digests.groupBy("conversation", "digest").agg(F.min("chunk").alias("first"), F.count("*").alias("n")).where("n > 1")
    earliest = earliest.select(F.col("conversation").alias("c"), F.col("digest").alias("d"), "first")
    again = digests.join(earliest, F.col("conversation").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")))
    again = again.where("chunk > first").groupBy(F.col("chunk").alias("at")).agg(F.collect_list("row").alias("again"))
    light = chunks.select("conversation", "chunk", "symbols", "low", "high", "turns").join(again, F.col("chunk") == F.col("at"), "left")
    light = light.select("conversation", "chunk", "symbols", "again", "low", "high", "turns")
    schema, arrow = _schemas(light, f"chunk long, edits string, state int, {_RESULT_TYPES}")
    solved = light.repartition("conversation").sortWithinPartitions("conversation", "chunk").mapInArrow(_solve_chunks(arrow), schema)
    solved = materialise(solved, "conversation-edits")
    edits = solved.select(F.col("chunk").alias("at"), "edits", "state")
    work = chunks.select("chunk", "symbols", "roles", "texts").join(edits, F.col("chunk") == F.col("at")).drop("at")
    fixed = StructType.fromDDL("chunk long, roles array<string>, texts array<string>")
    from pyspark.sql.pandas.types import to_arrow_schema

    fixed_rows = work.mapInArrow(_repair_chunks(to_arrow_schema(fixed)), fixed).withColumnRenamed("chunk", "at")
    parts = solved.join(fixed_rows, F.col("chunk") == F.col("at"))
    return whole.union(parts.select("conversation", F.col("chunk").alias("part"), *_RESULTS, "audit", "roles", "texts"))


def _hash_parts(schema: pa.Schema):
    """SHA-256 of the parts of each conversation, joined by line breaks, in one streaming pass."""

    def rows(batches) -> Iterator[tuple[dict, int]]:
        first = digest = whose = None
        empty = True
        for conversation, part, size, text in _records(batches):
            if first is None or conversation != whose:
                if first is not None:
                    yield {"first": first, "sha": digest.hexdigest()}, 0
                first, whose, digest, empty = part, conversation, hashlib.sha256(), True
            if size:
                digest.update(("" if empty else "\n").encode() + text.encode())
                empty = False
        if first is not None:
            yield {"first": first, "sha": digest.hexdigest()}, 0

    return tidy(lambda batches: _in_batches(rows(batches), schema))


def repair_digests(repaired: DataFrame) -> DataFrame:
    """One row a conversation: the results and ``repaired_sha256``, the SHA-256 of the repaired
    ``role:text`` joined by line breaks. The parts of a long conversation are hashed one after
    the other, as SHA-256 must be; every other step on them is parallel."""
    line = F.concat_ws("\n", F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t)))
    rows = repaired.withColumn("_joined", line)
    results = ["conversation", *_RESULTS, "audit"]
    whole = rows.where("part IS NULL").select(*results, F.sha2("_joined", 256).alias("repaired_sha256"))
    parts = rows.where("part IS NOT NULL")
    schema = StructType.fromDDL("first long, sha string")
    from pyspark.sql.pandas.types import to_arrow_schema

    joined = parts.select("conversation", "part", F.size("roles").alias("size"), "_joined")
    joined = joined.repartition("conversation").sortWithinPartitions("conversation", "part")
    hashed = joined.mapInArrow(_hash_parts(to_arrow_schema(schema)), schema)
    long = parts.where("audit IS NOT NULL").join(hashed, F.col("part") == F.col("first"))
    return whole.union(long.select(*results, F.col("sha").alias("repaired_sha256")))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` with faults that CRC-32 of ``conv_id:turn`` decides;
    dropped rows stay, with ``present`` = false."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    named = conversations.select(
        "conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("_fault"),
    )
    fault = F.col("_fault")
    return named.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (fault != 0).alias("present"),
        F.explode(F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1))).alias("_copy"),
    ).drop("_copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    rows = damaged(read_supplied(spark, sf_dir, "conversations"))
    return repair_digests(repair_conversations(rows, present="present")).withColumnRenamed("conversation", "conv_id")


def _oracle() -> str:
    """DuckDB SQL of :func:`op12_conversation_repair`: a recursive walk over each conversation's
    rows that keeps the least (cost, edits, repaired rows) of every state."""

    def insert(s: str, role: str) -> str:
        return f"CASE WHEN {s} IS NOT NULL THEN {{'c': {s}.c + {INSERT}, 'a': {s}.a || 'I', 'r': list_append({s}.r, '{role}:')}} END"

    def delete(s: str) -> str:
        return f"CASE WHEN {s} IS NOT NULL THEN {{'c': {s}.c + {DELETE}, 'a': {s}.a || 'D', 'r': {s}.r}} END"

    def keep(s: str, initial: str) -> str:
        kept = f"{{'c': {s}.c + {KEEP} + n.extra, 'a': {s}.a || 'K', 'r': list_append({s}.r, n.role || ':' || n.text)}}"
        return f"CASE WHEN {s} IS NOT NULL AND NOT n.must_go AND n.initial = '{initial}' THEN {kept} END"

    def rerole(s: str, role: str) -> str:
        new = f"{{'c': {s}.c + {REROLE} + n.extra, 'a': {s}.a || 'R', 'r': list_append({s}.r, '{role}:' || n.text)}}"
        return f"CASE WHEN {s} IS NOT NULL AND NOT n.must_go THEN {new} END"

    settled = (
        f"x0, x1, least(x2, {insert('x0', 'user')}, {insert('x1', 'user')}, {insert('x3', 'user')}) AS x2, "
        f"least(x3, {insert('least(x2, ' + insert('x0', 'user') + ', ' + insert('x1', 'user') + ')', 'assistant')}) AS x3"
    )
    step = (
        f"{delete('x0')}, least({delete('x1')}, {keep('x0', 's')}), "
        f"least({delete('x2')}, {keep('x0', 'u')}, {keep('x1', 'u')}, {keep('x3', 'u')}, {rerole('x0', 'user')}, {rerole('x1', 'user')}, {rerole('x3', 'user')}), "
        f"least({delete('x3')}, {keep('x2', 'a')}, {rerole('x2', 'assistant')})"
    )
    state = "STRUCT(c BIGINT, a VARCHAR, r VARCHAR[])"
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH RECURSIVE poly(b, k, c) AS (
  SELECT b::BIGINT, 0, b::BIGINT FROM range(256) r(b)
  UNION ALL
  SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM poly WHERE k < 8
), crc AS (SELECT list(c ORDER BY b) AS steps FROM poly WHERE k = 8),
given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))), '..'), lambda x: ('0x' || x)::BIGINT)),
           lambda c, b: xor(c >> 8, crc.steps[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS fault
  FROM conversations, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM given
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(role || chr(0) || text)) AS i,
         rtrim(text, {white}) AS core
  FROM damaged
), judged AS (
  SELECT *, substr(role, 1, 1) AS initial, core = '' AS blank,
         core <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS duplicate FROM placed
), n AS (
  SELECT *, blank OR duplicate AS must_go, NOT blank AND NOT duplicate AND right(core, 1) NOT IN ('.', '!', '?') AS truncated,
         CASE WHEN NOT blank AND NOT duplicate AND right(core, 1) NOT IN ('.', '!', '?') THEN {TRUNCATED} ELSE 0 END AS extra,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM judged
), walk(conv_id, i, x0, x1, x2, x3) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, {{'c': 0, 'a': '', 'r': []}}::{state}, NULL::{state}, NULL::{state}, NULL::{state} FROM conversations
  UNION ALL
  SELECT n.conv_id, n.i, {step}
  FROM (SELECT conv_id, i, {settled} FROM walk) w JOIN n ON n.conv_id IS NOT DISTINCT FROM w.conv_id AND n.i = w.i + 1
), ended AS (
  SELECT conv_id, least(x0, x3) AS x FROM (SELECT conv_id, i, {settled} FROM walk)
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1
), stats AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
         count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM n GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, x.c AS cost, x.a AS audit,
       sha256(array_to_string(x.r, chr(10))) AS repaired_sha256
FROM ended e LEFT JOIN stats s ON s.conv_id IS NOT DISTINCT FROM e.conv_id
"""


OP12_SQL = _oracle()
