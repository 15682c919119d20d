"""Texts that once ended a query, or were judged by their length."""

import os
import random
import re
import sys
import time
import zlib

import pyarrow.parquet as pq
import pytest
import regex
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest import SF_SMALL  # noqa: E402
from qalens.llm import near_dedup, quality, surrogates, token_counts, toxicity  # noqa: E402
from qalens.sources.supplied import read_supplied  # noqa: E402

N = 20_000  # a tenth of this ended the executor
LONG = {
    "email": "x@" + "a." * N + "com", "local": "ab." * N + "@firma.de", "email hyphens": "x@" + "a-" * N + "b.de",
    "half addresses": "a@" * N, "secret": "token=" + "x9" * N, "mask": "password: " + "*" * N, "ip": "1.2.3." * N,
    "ip6": "1:a:" * N, "colons": "::" * N, "ssn": "123-45-" * N, "phone": "+49 30 " * N, "trunk": "030 1234 " * N,
    "card": "1234 " * N, "digits": "7" * N, "account": "DE12 " + "ABCD " * N, "hex": "0a" * N,
    "name": "Dr " + "Anna " * N, "initials": "Dr " + "A. " * N, "titles": "Dr " * N, "spaces": "Mr" + " " * N,
}


def test_patterns_run_in_linear_time_on_a_megabyte(spark):
    matcher = spark._jvm.java.util.regex.Pattern.compile(surrogates.ANY)
    for name, text in LONG.items():
        long = text * (1_000_000 // len(text) + 1)
        started = time.time()
        assert matcher.matcher(long).results().count() >= 0, name
        assert time.time() - started < 20, name


@pytest.mark.parametrize("part", [list(LONG)[i::4] for i in range(4)], ids=lambda p: p[0])
def test_long_entities_do_not_end_the_query(spark, part):
    docs = spark.createDataFrame([(k, LONG[k]) for k in part], "doc_id string, text string")
    got = {r.doc_id: r for r in surrogates.replace_pii(docs, count="n").collect()}
    assert set(got) == set(part)
    for k in {"email", "local", "email hyphens", "secret", "hex", "name"} & set(part):
        assert got[k].n == 1 and got[k].text != LONG[k]
    for k in {"mask", "colons", "half addresses"} & set(part):
        assert got[k].text == LONG[k]


def _replaced(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return [r.text for r in surrogates.replace_pii(docs).orderBy("doc_id").collect()]


def test_entities_are_replaced_whole(spark):
    texts = [
        "to müller@firma.de.", "josé.garcía@correo.es!", "(иван@пример.рф)", "a@b.co-", "v@1.2.3", "x@y", "me@host.example.com.1",
        "at 2001:db8::ff00:42:8329 and fe80::1", "std::vector x :: Int a::b", "1:2:3:4:5:6:7:8", "call 030 12345678 or 020 7946 0958", "at 10:30:00",
    ]
    got = _replaced(spark, texts)
    for gone in ("müller", "garcía", "иван", "пример", "firma", "a@b.co", "me@host", "ff00", "fe80::1", "12345678", "7946"):
        assert not any(gone in t for t in got), gone
    assert [got[i] for i in (4, 5, 8, 11)] == [texts[i] for i in (4, 5, 8, 11)]
    assert got[0].startswith("to ") and got[0].endswith(".example.org.") and got[9].startswith("2001:db8:")
    assert re.fullmatch(r"call 0\d\d \d{8} or 0\d\d \d{4} \d{4}", got[10])


def _entities(text):
    """The entities of a text and what lies between them, by another engine."""
    pattern = surrogates.ANY.replace(r"\k<mask>", r"(?P=mask)").replace("(?<mask>", "(?P<mask>")
    found = list(regex.finditer(pattern, text, flags=regex.V0))
    edges = [0, *[e for m in found for e in m.span()], len(text)]
    return [m[0] for m in found], [text[a:b] for a, b in zip(edges[::2], edges[1::2])]


def test_documents_equal_their_brute_force_replacement(spark):
    """Every entity, and nothing else, changes: the same everywhere, no two alike, none an entity."""
    docs = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()}
    own = "Mail a.b@firma.de or a.b@firma.de, fe80::1, Dr. Anna Maria Schmidt, token=abcDEF123456, 10.1.2.3 and 030 12345678. "
    docs |= {10_000 + i: own * i for i in range(4)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r.doc_id: r.text for r in surrogates.replace_pii(df).collect()}
    mapping, count = {}, 0
    for i, text in docs.items():
        entities, between = _entities(text)
        at, count = 0, count + len(entities)
        # the pieces between entities stand in the result, in order, and surrogates fill the gaps
        places = regex.fullmatch("(.+?)".join(regex.escape(b) for b in between), got[i], flags=regex.S)
        assert places, i
        for e, new in zip(entities, places.groups()):
            assert mapping.setdefault(e, new) == new and new != e
            at += 1
    assert count > 50 and len(set(mapping.values())) == len(mapping)
    assert not set(mapping) & set(mapping.values())


def test_a_clean_book_is_kept(spark):
    """200,000 words whose frequencies fall with their rank, as a natural text's do."""
    rng = random.Random(1)
    words = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(1, 5))) for _ in range(30000)]
    picked = [words[min(int(1.00032 ** rng.randrange(32000)) - 1, 29999)] for _ in range(200_000)]
    text = ". ".join(" ".join(picked[i : i + 12]).capitalize() for i in range(0, len(picked), 12))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    ledger = quality.measure(docs).first()
    assert ledger.n_words == 200_000 and 4 * ledger.n_distinct_words < ledger.n_words  # the old rule's bit is set
    assert quality.keep_good(docs).count() == 1
    assert quality.keep_good(docs, policy="v2").count() == 0


def test_near_dedup_keeps_columns_of_any_name(spark):
    rows = [(i, "one two three four five six seven" if i < 3 else f"other text number {i} of its own kind", i, i) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _dropped long, _row long")
    got = near_dedup.keep_one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect())) == [rows[0], *rows[3:]]
    assert got.where(F.col("_dropped").isNull()).count() == 0


def _encoding():
    import public_tokenizers

    from qalens.llm.token_counts import _encoding as make

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return make(f.read(), public_tokenizers.PATTERN)


def test_cut_runs_count_like_the_encoder():
    rng, encoding = random.Random(3), _encoding()
    parts = [" ", "\n", "\t", " ", "　", "\r\n", "a", "Bc", "7", "!", "é", "\x1c", "'s"]
    for _ in range(2000):
        text = "".join(rng.choice(parts[:6] if rng.random() < 0.7 else parts) * rng.randrange(1, 9) for _ in range(rng.randrange(0, 12)))
        want = len(encoding.encode_ordinary(text))
        assert all(token_counts.text_length(encoding, text, n) == want for n in (1, 2, 3, 7)), repr(text)


def test_megabytes_of_one_character_are_counted(spark):
    import public_tokenizers

    runs = {c: c * 5_000_000 for c in (" ", "\n", "\t", "a", "!", "7")} | {"mixed": "x" + " \n" * 2_500_000 + "y" + " " * 100_000}
    docs = spark.createDataFrame(list(runs.items()), "doc_id string, text string").repartition(4)
    counted = token_counts.token_lengths(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    got = {r.doc_id: r.n_tokens for r in counted.collect()}
    encoding = _encoding()
    for c in (" ", "\n", "\t"):
        assert got[c] == len(encoding._encode_single_piece(c * 5_000_000))
    for c in ("a", "!", "7"):
        assert got[c] == len(encoding.encode_ordinary(c * 5_000_000))
    assert got["mixed"] > 100


def test_a_text_like_an_example_of_rare_words_is_found_over_all_terms(spark):
    """No term tells the classes apart: half of an example's rare words must find it."""
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5][:240]
    docs = [(i, f"awful{i} nasty{i} vile{i} mean{i}" if n % 2 else f"fine{i} nice{i} good{i} kind{i}") for n, i in enumerate(ids)]
    labels = spark.createDataFrame([(i, n % 2) for n, i in enumerate(ids)], "doc_id long, toxic int")
    like = [(5000 + i, " ".join(t.split()[:2]) + f" other{i}") for i, t in docs]
    frame = spark.createDataFrame(docs + like, "doc_id long, text string")
    model = toxicity.fit(frame, labels)
    assert len(model.vocabulary) == 4 * len(ids) and not model.vocabulary.n_telling
    got = {r.doc_id: r for r in toxicity.score(frame, model).collect()}
    for n, i in enumerate(ids):
        assert got[5000 + i].nearest == [i] and got[5000 + i].predicted == n % 2


@pytest.mark.parametrize("common", [1, 16, 10**6])
def test_search_over_all_terms_equals_brute_force(monkeypatch, common):
    """Whatever counts as common, in blocks and parts of any size, ties included."""
    import numpy as np

    monkeypatch.setattr(toxicity, "COMMON", common)
    monkeypatch.setattr(toxicity, "WIDE_BLOCK", 8)
    monkeypatch.setattr(toxicity, "QUERIES", 7)
    monkeypatch.setattr(toxicity, "POSTINGS", 500)
    rng = np.random.default_rng(3)
    dense = np.zeros((150, 300))
    for i in range(140):  # the last ten have no term
        terms = np.minimum(rng.zipf(1.3, rng.integers(1, 30)), 300) - 1
        dense[i, terms] = rng.integers(1, 4, len(terms))
        dense[i] /= np.sqrt(dense[i] @ dense[i])
    dense[100:105] = dense[:5]
    row, term = np.nonzero(dense)
    index = toxicity.WideIndex(300, np.searchsorted(row, np.arange(151)), term, dense[row, term])
    for without in (None, np.arange(150)):
        similar = np.round(dense @ dense.T, 12)
        if without is not None:
            np.fill_diagonal(similar, 0)
        got = index.nearest(row, term, dense[row, term], 150, 15, without)
        for s, near in zip(similar, got):
            want = sorted(((x, j) for j, x in enumerate(s) if x > 0), key=lambda x: (-x[0], x[1]))[:15]
            assert [j for _, j in near] == [j for _, j in want] and np.allclose([x for x, _ in near], [x for x, _ in want])


def test_toxicity_neighbours_equal_brute_force(spark):
    """``nearest`` of the query itself: TF-IDF over all terms of the examples, every document."""
    from collections import Counter
    from math import log, sqrt

    documents, labels = read_supplied(spark, SF_SMALL, "documents"), read_supplied(spark, SF_SMALL, "labels")
    words = {r.doc_id: Counter(re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r.text or "").encode().lower())) for r in documents.collect()}
    known = {r.doc_id for r in labels.where("toxic IS NOT NULL").collect()}
    examples = sorted(i for i in known & set(words) if zlib.crc32(str(i).encode()) % 5)
    df = Counter(w for c in words.values() for w in c)
    terms = {w for i in examples for w in words[i]}

    def vector(counts):
        own = {w: (1 + log(n)) * (log((1 + len(words)) / (1 + df[w])) + 1) for w, n in counts.items() if w in terms}
        length = sqrt(sum(x * x for x in own.values()))
        return {w: x / length for w, x in own.items()}

    vectors = {i: vector(words[i]) for i in examples}
    got = {r.doc_id: r for r in toxicity.score(documents, toxicity.fit(documents, labels)).collect()}
    for i, counts in words.items():
        own = vector(counts)
        similar = sorted(((-round(sum(x * v.get(w, 0) for w, x in own.items()), 9), j) for j, v in vectors.items()))[:5]
        assert got[i].nearest == [j for s, j in similar if s < 0]


def test_a_copy_of_any_example_finds_it(spark):
    """Toxic rows of words that stand nowhere else: no term tells the classes apart, copies do."""
    def ids(n, start):
        return [i for i in range(start, start + 3 * n) if zlib.crc32(str(i).encode()) % 5][:n]

    toxic, clean = ids(60, 0), ids(60, 1000)
    rows = [(i, f"awful{i} nasty{i} vile{i}", 1) for i in toxic] + [(i, f"fine{i} nice{i} good{i}", 0) for i in clean]
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    copies = [(5000 + i, t.upper()) for i, t, _ in rows] + [(9999, None), (9998, "words of its own"), (9997, "Awful1, " * 100_000)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + copies, "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    for i, _, y in rows:
        assert got[5000 + i].predicted == y and got[5000 + i].evidence[0] == i
    assert got[9999].evidence == got[9998].evidence == got[9997].evidence == []
