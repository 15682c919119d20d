"""Fill-in-middle, conversation repair and sharding: edge cases and plain versions."""

import hashlib
import os
import random
import re
import sys
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
from conftest import SF_MID  # noqa: E402
from qalens.llm import conversations as C  # noqa: E402
from qalens.llm import fill_middle as M  # noqa: E402
from qalens.llm import sharding as S  # noqa: E402
from qalens.llm.queries import QUERIES  # noqa: E402
from qalens.session import shared_dir  # noqa: E402

SPACE = " \t\n\x0b\x0c\r"


# -- fill in the middle ---------------------------------------------------------------------

@pytest.mark.parametrize("kind, density", [(M._Array, 0.01), (M._Bitmap, 0.4), (M._Runs, None)])
def test_boundary_set_selects_like_a_list(kind, density):
    rng = np.random.default_rng(3)
    for length in (1, 63, 64, 65, M.SPAN - 1, M.SPAN, M.SPAN + 1, 3 * M.SPAN + 17):
        mask = rng.random(length) < density if density else np.arange(length) // 5000 % 2 == 0
        places = np.flatnonzero(mask)
        tokens = M.BoundarySet(mask)
        assert len(tokens) == len(places) and tokens.select(len(places)) == length
        ks = {0, len(places) - 1, *rng.integers(0, max(len(places), 1), 200).tolist()} if len(places) else ()
        assert all(tokens.select(k) == places[k] for k in ks)
        if length > M.SPAN:
            assert all(type(c) is kind for c in tokens.containers[:1])


def test_boundary_set_with_an_empty_stretch():
    mask = np.zeros(3 * M.SPAN, dtype=bool)
    mask[[5, 2 * M.SPAN + 7]] = True
    tokens = M.BoundarySet(mask)
    assert [tokens.select(k) for k in range(3)] == [5, 2 * M.SPAN + 7, 3 * M.SPAN] and len(tokens.containers) == 2


def _filled(i, text):
    text = text or ""
    words = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    x, y = sorted((h[0] % (len(words) + 1), h[1] % (len(words) + 1)))
    p, m, s = ("".join(w) for w in (words[:x], words[x:y], words[y:]))
    if not text or any(k in text for k in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(words), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(words), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(words), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_edges(spark):
    texts = [None, "", " ", "a", "ab cd", "été 漢字 😀x", "<P>a", "a<S", "<M>", "<", "<S<P", "\n\t", "x" * 300_000,
             "a b" * 100_000, "é" * 200_000, "ab, " * 60_000 + "é" * 70_000]
    rows = [(None if i == 3 else i % 40, t, i) for i, t in enumerate(texts * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _text long").withColumn("_h", F.lit("x")).repartition(5)
    got = M.fill_in_middle(docs).withColumn("back", M.restored()).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == _filled(r.doc_id, texts[r._text % len(texts)])
        assert r.back == (texts[r._text % len(texts)] or "") and r._h == "x"
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert M.fill_in_middle(docs.limit(0)).count() == 0
    keyed = M.fill_in_middle(docs.select(F.lit("k").alias("id"), F.col("text").alias("t")), id="id", text="t", seed=7)
    assert keyed.columns == ["id", "t", "n", "form", "prefix_chars", "middle_chars", "output"] and keyed.count() == len(rows)


# -- conversation repair --------------------------------------------------------------------

def test_block_tables_give_the_least_cheapest_edits():
    rng = random.Random(5)
    alphabets = [range(16), (0, 1, 2), (1, 2), (0, 1, 2, 3), (1, 2, 5, 6, 9, 14), (0, 0, 0, 4, 1)]
    for _ in range(3000):
        s = bytes(rng.choice(rng.choice(alphabets)) for _ in range(rng.randrange(0, 15)))
        want = brute.cheapest_edits([("sua-"[x % 4], x >= 8, 4 <= x < 8) for x in s])
        assert C.solve(s) == C.solve(s, 1) == C.solve(s, 3) == want, s


def _random_rows(rng, conversations, longest):
    rows = []
    for c in range(conversations):
        for t in range(rng.randrange(0, longest)):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None])
            text = rng.choice(["yes.", "no", "why?", "", " \n", "so!", f"t{t}.", f"u{t}", None])
            turn = None if rng.random() < 0.1 else rng.randrange(-2, longest)
            rows.append((None if c == 0 else c, turn, role, text, c))
    rng.shuffle(rows)
    return rows


def _by_hand(rows):
    """{conversation: results} in the module's order."""
    out = {}
    for conversation, turn, role, text, *_ in rows:
        out.setdefault(conversation, []).append((turn, " " if role is None else role, " " if text is None else text))
    for c, held in out.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(f"{r[1]}\0{r[2]}".encode()).digest()))
        out[c] = brute.repaired_conversation(held)
    return out


@pytest.mark.parametrize("chunk_rows, chunk_bytes", [(4096, 1 << 20), (3, 1 << 20), (1, 1 << 20), (50, 7)])
def test_repair_equals_brute_force(spark, chunk_rows, chunk_bytes):
    rows = _random_rows(random.Random(chunk_rows), 60, 14) + _random_rows(random.Random(9), 1, 400)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part long").repartition(7)
    out = C.repair_digests(C.repair_conversations(df, chunk_rows=chunk_rows, chunk_bytes=chunk_bytes))
    got = {r.conversation: r.asDict() for r in out.collect()}
    want = _by_hand(rows)
    assert set(got) == set(want) and out.count() == len(want)
    for c, result in want.items():
        assert {k: got[c][k] for k in result} == result, c


def test_a_long_conversation_is_cut_over_the_tasks(spark):
    rows = [(1, t, "user" if t % 3 else "assistant", "same." if t % 4 else f"{t}.", t) for t in range(6000)]
    rows += [(1, 77, "user", "again and again.", 0)] * 3000 + [(2, 0, "user", "a.", 0), (0, 0, "user", "a.", 0)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, x long").repartition(5)
    repaired = C.repair_conversations(df, chunk_rows=500)
    assert repaired.where("conversation = 1 AND part IS NOT NULL").count() > 10
    got = {r.conversation: r.asDict() for r in C.repair_digests(repaired).collect()}
    want = _by_hand(rows)
    assert {c: {k: got[c][k] for k in w} for c, w in want.items()} == want and set(got) == set(want)


def test_repair_edges(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.repair_digests(C.repair_conversations(empty)).count() == 0
    rows = [("a", 1, "user", "x.", False), ("b", 5, "system", "x.", True), ("c", None, "user", None, True), ("d", 3, "user", "é" * 2_000_000, True)]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string, here boolean")
    got = {r.conversation: r for r in C.repair_digests(C.repair_conversations(df, present="here")).collect()}
    nothing = brute.sha(b"")
    assert (got["a"].cost, got["a"].audit, got["a"].gaps, got["a"].repaired_sha256) == (0, "", 0, nothing)
    assert (got["b"].audit, got["b"].cost) == ("D", 4)
    assert (got["c"].audit, got["c"].blank, got["c"].gaps) == ("D", 1, 0)
    assert got["d"].audit == "D" and got["d"].truncated == 1  # 4, not 3 + 3


def test_op12_equals_brute_force(spark):
    rows = []
    for r in pq.read_table(f"{SF_MID}/conversations.parquet").to_pylist():
        fault = zlib.crc32(f"{r['conv_id']}:{r['turn']}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", r["text"]) if fault == 2 else r["text"]
        new = (r["conv_id"], r["turn"], "user" if fault == 4 else r["role"], text)
        rows += [new] * (0 if fault == 0 else 2 if fault == 3 else 1)
    want = _by_hand(rows)
    got = {r.conv_id: r.asDict() for r in QUERIES["op12_conversation_repair"](spark, SF_MID).collect()}
    gone = {r["conv_id"] for r in pq.read_table(f"{SF_MID}/conversations.parquet").to_pylist()} - set(want)
    assert set(got) == set(want) | gone
    assert {c: {k: got[c][k] for k in w} for c, w in want.items()} == want
    assert all(got[c]["audit"] == "" and got[c]["cost"] == 0 and got[c]["repaired_sha256"] == brute.sha(b"") for c in gone)


# -- sharding -------------------------------------------------------------------------------

def _shards(spark, df, shards, **more):
    path = shared_dir(spark, "test-shards")
    pieces = S.write_shards(df, path, shards, **more)
    return S.read_shards(df, path, shards, pieces, text=more.get("text", "text")), pieces


def _check_slots(got):
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_shards_of_a_hot_text_are_equal(spark):
    rng = random.Random(4)
    rows = [(i, "hot text " * 8 if i % 3 == 0 else f"{i} " + "w" * rng.randrange(1, 120), "s") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _key string").repartition(6)
    got = _shards(spark, df, 12)[0].collect()
    assert sorted((r.doc_id, r.text, r._key) for r in got) == sorted(rows)
    _check_slots(got)
    size = [0] * 12
    for r in got:
        size[r.shard] += len(r.text.encode()) + S.OVERHEAD
    assert max(size) - min(size) <= 2 * S.TOLERANCE * sum(size) / 12 + 200
    where = {}
    for r in got:
        where.setdefault(r.text, set()).add(r.shard)
    assert len(where["hot text " * 8]) >= 4


def test_copies_stay_together_where_balance_allows(spark):
    rows = [(i, f"text number {i // 4} " + "x" * (i // 4 % 50)) for i in range(8000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = _shards(spark, df, 6, tolerance=0.01)[0].collect()
    where = {}
    for r in got:
        where.setdefault(r.text, set()).add(r.shard)
    assert all(len(w) == 1 for w in where.values())


def test_equal_rows_are_spread_too(spark):
    df = spark.createDataFrame([(1, "same", 5)] * 3000 + [(2, None, 6), (None, "", 7)], "doc_id long, text string, shard long").repartition(4)
    out, _ = _shards(spark, df.drop("shard"), 8)
    got = out.collect()
    counts = [sum(r.shard == s for r in got) for s in range(8)]
    assert sum(counts) == 3002 and max(counts) - min(counts) <= 20
    _check_slots(got)


def test_shard_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, size long")
    out, _ = _shards(spark, empty, 5)
    assert out.count() == 0 and out.columns == ["doc_id", "text", "size", "shard", "slot"]
    few = spark.createDataFrame([("a", "x" * 2_000_000, 1), ("b", None, 2)], "name string, body string, piece int")
    out, _ = _shards(spark, few, 5, id="name", text="body")
    got = out.collect()
    assert len(got) == 2 and {r.piece for r in got} == {1, 2}
    _check_slots(got)
    one, _ = _shards(spark, few, 1, id="name", text="body")
    assert {(r.shard, r.slot) for r in one.collect()} == {(0, 0), (0, 1)}


def test_pieces_and_partitions_do_not_change_the_shards(spark):
    rows = [(i, f"{i % 700} " + "y" * (i % 97)) for i in range(5000)]
    a, _ = _shards(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 7)
    b, pieces = _shards(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(8, "text"), 7, piece_bytes=5000)
    assert pieces > 5
    got = b.collect()
    _check_slots(got)
    assert {(r.doc_id, r.shard) for r in a.collect()} == {(r.doc_id, r.shard) for r in got}


def test_sharding_has_no_python_on_the_main_path(spark):
    from qalens.plans.inspect import plan_text

    plan = plan_text(QUERIES["op13_histogram_shards"](spark, SF_MID))
    assert "Python" not in plan and "InArrow" not in plan and "ArrowEval" not in plan
