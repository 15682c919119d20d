"""Header census and split reading of CSV with quoted line breaks."""

import random

import pytest
from pyspark.sql import functions as F

from qalens.session import shared_dir
from qalens.sources import csv as C
from qalens.sources.csv import header_census, read_csv
from qalens.sources.csv_split import INSIDE, OUTSIDE, _Quotes, compose, split_records
from qalens.sources.tables import load_table


@pytest.mark.parametrize(
    "line, outside, inside",
    [
        (b"", OUTSIDE, INSIDE), (b"a,b", OUTSIDE, INSIDE), (b'"a', INSIDE, OUTSIDE), (b'a"', OUTSIDE, OUTSIDE),
        (b'"a""', INSIDE, OUTSIDE), (b'""', OUTSIDE, INSIDE), (b'x,"', INSIDE, OUTSIDE), (b'",x', INSIDE, OUTSIDE),
        (b'","', OUTSIDE, INSIDE), (b'5" pipe,"b', INSIDE, INSIDE), (b'5" pipe, b', OUTSIDE, OUTSIDE), (b'a,"b"",c",d', OUTSIDE, OUTSIDE),
        (b'"",""', OUTSIDE, INSIDE), (b'"a","b', INSIDE, INSIDE), (b'"""', INSIDE, OUTSIDE), (b'""""', OUTSIDE, INSIDE),
    ],
)
def test_quote_states(line, outside, inside):
    quotes = _Quotes(",", '"')
    assert quotes.after(line, OUTSIDE) == outside
    assert quotes.after(line, INSIDE) == inside


def test_maps_compose_in_file_order():
    maps = [("b", 0, INSIDE, OUTSIDE, True), ("a", 20, OUTSIDE, INSIDE, False), ("a", 10, INSIDE, INSIDE, False),
            ("a", 0, INSIDE, OUTSIDE, True), ("a", 30, OUTSIDE, INSIDE, True), ("a", 40, OUTSIDE, OUTSIDE, True)]
    got = compose(maps)
    assert {f: {s: o for s, (o, _) in r.items()} for f, r in got.items()} == {"a": {10: 0, 20: 0, 30: 0, 40: 30}}


def _write(tmp_path, name, header, rows, line_end, rng):
    def field(v):
        if v is None:
            return ""
        quoted = any(c in v for c in ',"\r\n') or rng.random() < 0.2
        return '"' + v.replace('"', '""') + '"' if quoted else v

    lines = [",".join(header)] + [",".join(field(v) for v in r) for r in rows]
    (tmp_path / name).write_bytes((line_end.join(lines) + (line_end if rng.random() < 0.5 else "")).encode())


PIECES = ["a", "b c", ",", '"', '""', "\n", "\r\n", "\n\n", "é漢", '",', ',"', "x" * 30, "\r\n\r\n"]


@pytest.mark.parametrize("seed, split, kept, line_end", [(1, 60, 1 << 16, "\n"), (2, 31, 1 << 16, "\r\n"), (3, 40, 10, "\n"), (4, 90, 50, "\r\n"), (5, 7, 5, "\n")])
def test_every_cut_gives_the_rows(spark, tmp_path, seed, split, kept, line_end):
    rng = random.Random(seed)
    want = []
    for name in ("one.csv", "two.csv", "three.csv"):
        rows = []
        for i in range(6 if split < 10 else 20):
            text = "".join(rng.choice(PIECES) for _ in range(rng.randrange(0, 7))) or None
            note = "".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 30))) if rng.random() < 0.2 else "n"
            rows.append((f"{name}-{i}", text, note))
        _write(tmp_path, name, ["Id", "Text", "Note"], rows, line_end, rng)
        want += rows
    (tmp_path / "empty.csv").write_bytes(b"")
    records = split_records(spark, str(tmp_path), split_bytes=split, kept_bytes=kept)
    parsed = records.select(F.from_csv("record", "Id string, Text string, Note string", {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}).alias("r")).select("r.*")
    assert sorted(map(tuple, parsed.collect()), key=repr) == sorted(want, key=repr)


def test_split_reading_equals_whole_reading(spark, tmp_path):
    rng = random.Random(8)
    rows = [(str(i), f"line {i}\nand \"more\", {i}" if i % 3 else "plain", "2019-01-02") for i in range(200)]
    _write(tmp_path, "a.csv", ["Id", "Text", "Date"], rows[:100], "\n", rng)
    _write(tmp_path, "b.csv", ["Date", "Id", "Text"], [(r[2], r[0], r[1]) for r in rows[100:]], "\n", rng)
    schema = "Id long, Text string, Date string"
    whole = read_csv(spark, str(tmp_path), schema, by_header=True)
    split = read_csv(spark, str(tmp_path), schema, by_header=True, split=700)
    assert sorted(whole.collect()) == sorted(split.collect()) and split.count() == 200
    assert split.rdd.getNumPartitions() > 10
    bad = read_csv(spark, str(tmp_path), schema + ", torn string", by_header=False, split=700, options={"columnNameOfCorruptRecord": "torn"})
    assert bad.columns == ["Id", "Text", "Date", "torn"]


def test_a_header_over_several_ranges(spark, tmp_path):
    (tmp_path / "h.csv").write_bytes(b'"I\nd","Te\nxt\n\n\n\n"\n1,a\n2,"b\n"\n')
    got = split_records(spark, str(tmp_path / "h.csv"), split_bytes=4)
    assert sorted(r.record for r in got.collect()) == ["1,a", '2,"b\n"']


def test_split_needs_the_standard_dialect(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Id\n1\n")
    with pytest.raises(ValueError):
        read_csv(spark, str(tmp_path), "Id long", split=True, options={"escape": "\\"})


def _jobs(spark, work):
    tracker, group = spark.sparkContext.statusTracker(), f"count-{random.random()}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        out = work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(tracker.getJobIdsForGroup(group))


def test_header_census_takes_the_same_jobs_for_many_files(spark, tmp_path):
    counts = []
    for n in (6, 200):
        root = tmp_path / str(n)
        root.mkdir()
        for i in range(n):
            names = ["Id", "Name"] if i % 2 else ["Name", "Id", "Extra"]
            values = {"Id": str(i), "Name": f"n\n{i}", "Extra": "x"}
            (root / f"part {i:03d}.csv").write_text("\n" * (i % 5 == 0) + ",".join(names) + "\n" + ",".join(f'"{values[c]}"' for c in names) + "\n")
        (root / "empty.csv").write_text("")
        df, jobs = _jobs(spark, lambda: read_csv(spark, str(root), "Id long, Name string", by_header=True))
        assert sorted((r.Id, r.Name) for r in df.collect()) == [(i, f"n\n{i}") for i in range(n)]
        counts.append(jobs)
        census = header_census(spark, str(root), dict(C.CSV_OPTIONS))
        assert {h: len(f) for h, f in census.items()} == {("Id", "Name"): n // 2, ("Name", "Id", "Extra"): n // 2}
    assert counts[1] <= counts[0] + 2 and counts[1] <= 10, counts


def test_census_of_quoted_headers_and_gzip(spark, tmp_path, monkeypatch):
    import gzip

    (tmp_path / "a.csv.gz").write_bytes(gzip.compress(b'"Id","a ""b"", c\nd"\r\n1,x\r\n' * 1))
    (tmp_path / "b.csv.gz").write_bytes(gzip.compress(b"Id,z\n" + b"2,y\n" * 5000))
    monkeypatch.setattr(C, "LEAVE_BYTES", 1)
    census = header_census(spark, str(tmp_path), dict(C.CSV_OPTIONS))
    assert sorted(len(f) for f in census.values()) == [1, 1] and all(h[0] == "Id" for h in census)
    assert header_census(spark, str(tmp_path / "a.csv.gz"), dict(C.CSV_OPTIONS)).keys() <= census.keys()


def test_uncompressed_exports_are_split_by_default(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(C, "SPLIT_BYTES", 300)
    rows = [(str(i), "7", "x\n" * (i % 9)) for i in range(200)]
    _write(tmp_path, "Comments.csv", ["PostId", "Score", "Text"], rows, "\n", random.Random(1))
    df = load_table(spark, str(tmp_path), "Comments", "csv")
    assert sorted(map(tuple, df.collect())) == sorted((i, 7) for i in range(200)) and df.rdd.getNumPartitions() > 5


def test_shared_folder_only(spark):
    assert "csv-ranges" in shared_dir(spark, "csv-ranges")
