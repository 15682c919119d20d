"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

1. *Examples.* At most ``MAX_EXAMPLES`` labelled rows of each class (a documented bound on the
   fitted sample: those with the least hash of their id; their votes are weighted back to the
   classes' true sizes). Held-out rows are never among them.
2. *Vectors.* TF-IDF over all terms of the examples: none is dropped. Inverse document
   frequencies count every document of the corpus; a query's words that stand in no example
   have no weight.
3. *Index.* Terms in few examples keep plain posting lists, which are summed exactly. Terms in
   many keep their weights in blocks of examples with the block's largest weight. A block is
   skipped when its exact sum and its bound cannot reach the k-th best similarity: the nearest
   examples are exact. A text equal to an example has cosine 1 with it.
4. *Votes.* Neighbours vote with weights that fall with distance, beside a prior vote. In a long
   text a few telling words hardly move a cosine over all terms, so a second vote is taken
   beside it, by cosine over the telling terms: chi-square of at least ``LEAST_CHI2``, in
   ``MIN_EXAMPLES`` examples or more, and ``LIFT`` times as frequent in one class. A logistic
   curve fitted to both leave-one-out votes of the examples makes the score a probability; both
   votes have a part in every score. ``nearest`` are the ids of the nearest examples over all
   terms, ``evidence`` those of equal texts and of the nearest by telling terms.

Only the index is broadcast: at most ``2 * MAX_EXAMPLES`` vectors. Every text is read whole.

Defined results: null or empty texts, and texts that share no term with an example, get the
score of examples without a telling term; conflicting labels of an id count as toxic; null
labels are no examples; without labels of both classes every score is the rate of the labels
(0.5 without any); equal similarities go to the smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qalens.llm._shared import materialise
from qalens.llm._text import ALNUM_WORDS, LOWER_ASCII, Words, mix, tidy, window_hashes, word_chunks

MAX_EXAMPLES = 4_000
MAX_TERMS = 20_000
LEAST_CHI2 = 20.0
MIN_EXAMPLES = 5
LIFT = 4.0
NEIGHBOURS = 15
BLOCK = 64
#: A term in more than one of so many examples is common: its weights are kept in blocks.
COMMON = 16
#: Examples in a block of the index over all terms; queries and summed postings at a time.
WIDE_BLOCK, QUERIES, POSTINGS = 128, 256, 2_000_000
#: Over all terms most texts are far from each other: these votes fall as a power of the odds.
WIDE_FALL = 2
#: The least part of a vote in the score.
LEAST_SLOPE = 0.05
PRIOR_VOTE = 0.5
FOLDS = 5


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Rows whose labels are never learned from: crc32 of the id's text mod 5 is 0."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.pmod(F.crc32(col.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


def choose_examples(labels: DataFrame, doc_id: str = "doc_id", label: str = "toxic", most: int = MAX_EXAMPLES) -> tuple[list, list]:
    """``[(id, label, weight)]`` of the examples and ``[negatives, positives]``, the classes'
    sizes. A class is ordered by a hash of the id, and its first ``most`` ids are taken."""
    known = (
        labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & ~held_out(doc_id))
        .groupBy(F.col(doc_id).alias("id")).agg(F.max(F.when(F.col(label) > 0, 1).otherwise(0)).alias("y"))
    )
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    chosen = []
    for y in (0, 1):
        first = known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(most).collect()
        chosen += [(r["id"], y, sizes[y] / len(first)) for r in first]
    return chosen, [sizes.get(0, 0), sizes.get(1, 0)]


def _sequences(chunk: Words) -> list[tuple[int, int] | None]:
    """128 bits of each row's whole word sequence, None for rows without a word."""
    word, first, counts = chunk.hashes(), chunk.first[:-1], chunk.counts
    a = window_hashes(word, first, counts).view(np.int64).tolist()
    b = window_hashes(mix(word + np.uint64(9)), first, counts).view(np.int64).tolist()
    return [(x, y) if n else None for x, y, n in zip(a, b, counts.tolist())]


def _term_counts(chunk: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term hash and occurrences, sorted by row and term."""
    row, term = chunk.rows(), chunk.hashes()
    order = np.lexsort((term, row))
    row, term = row[order], term[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (term[1:] != term[:-1])
    at = np.flatnonzero(new)
    return row[at], term[at], np.diff(np.append(at, len(row)))


def all_terms(examples: DataFrame) -> np.ndarray:
    """Hashes of every term of the examples ``(id, y, text)``."""

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in word_chunks(batch.column(0), ALNUM_WORDS, LOWER_ASCII):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(chunk.hashes()).view(np.int64))], ["term"])

    return examples.select("text").mapInArrow(tidy(terms), "term long").distinct().toArrow().column(0).to_numpy()


def choose_vocabulary(examples: DataFrame, positives: int, negatives: int) -> list[int]:
    """Hashes of the terms that tell the classes apart, for the second vote. ``examples``:
    ``(id, y, text)``."""
    if not positives or not negatives:
        return []

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column(1).to_numpy()
            for chunk in word_chunks(batch.column(2), ALNUM_WORDS, LOWER_ASCII):
                row, term, _ = _term_counts(chunk)
                yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(y[chunk.lo + row])], ["term", "y"])

    counted = (
        examples.select("id", "y", "text").mapInArrow(tidy(terms), "term long, y int")
        .groupBy("term").agg(F.sum("y").cast("double").alias("a"), F.sum(1 - F.col("y")).cast("double").alias("b"))
    )
    a, b, p, n = F.col("a"), F.col("b"), F.lit(float(positives)), F.lit(float(negatives))
    total, df = p + n, F.col("a") + F.col("b")
    chi2 = total * (a * (n - b) - b * (p - a)) ** 2 / (df * (total - df) * p * n)
    rate_a, rate_b = (a + 0.5) / (p + 1), (b + 0.5) / (n + 1)
    kept = counted.where((df >= MIN_EXAMPLES) & (df < total)).withColumn("chi2", chi2).where(
        (F.col("chi2") >= LEAST_CHI2) & ((rate_a >= LIFT * rate_b) | (rate_b >= LIFT * rate_a))
    )
    return sorted(r["term"] for r in kept.orderBy(F.desc("chi2"), "term").limit(MAX_TERMS).collect())


class Vocabulary:
    """All terms of the examples, with TF-IDF weights; some of them are telling."""

    def __init__(self, terms: np.ndarray, telling: list[int] = ()):
        self.hashes = np.sort(np.array(terms, dtype=np.int64).view(np.uint64))
        self.idf = np.ones(len(self.hashes))
        #: Per term its number among the telling terms, or -1.
        self.telling = np.full(len(self.hashes), -1, dtype=np.int32)
        self.n_telling = len(telling)
        self.telling[np.isin(self.hashes, np.array(telling, dtype=np.int64).view(np.uint64))] = np.arange(self.n_telling)

    def __len__(self) -> int:
        return len(self.hashes)

    def find(self, chunk: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, term number and occurrences of the vocabulary's terms, by row and term."""
        word, size = chunk.hashes(), max(len(self), 1)
        if not len(self):
            return (np.zeros(0, dtype=np.int64),) * 3
        place = np.minimum(np.searchsorted(self.hashes, word), len(self) - 1)
        hit = np.flatnonzero(self.hashes[place] == word)
        row = np.searchsorted(chunk.first, hit, side="right") - 1
        pair, n = np.unique(row * size + place[hit], return_counts=True)
        return pair // size, pair % size, n

    def vectors(self, chunk: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, term number and weight; the weights of a row have length 1."""
        row, term, n = self.find(chunk)
        return row, term, _unit(row, (1 + np.log(n)) * self.idf[term])

    def telling_vectors(self, row: np.ndarray, term: np.ndarray, weight: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Per row with any telling term: their numbers and weights, of length 1 again."""
        some = self.telling[term] >= 0
        row, term, weight = row[some], self.telling[term[some]], _unit(row[some], weight[some])
        rows, at = np.unique(row, return_index=True)
        return {r: (term[lo:hi], weight[lo:hi]) for r, lo, hi in zip(rows.tolist(), at, np.append(at[1:], len(row)))}


def _unit(row: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The weights divided by the length of their row's vector."""
    return weight / np.sqrt(np.bincount(row, weight * weight))[row]


def document_frequencies(documents: DataFrame, vocabulary: Vocabulary, text: str = "text") -> tuple[np.ndarray, int]:
    """Documents of the corpus that hold each term, and their number."""
    spark, shared = documents.sparkSession, documents.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rows = shared.value, 0
        total = np.zeros(len(known), dtype=np.int64)
        for batch in batches:
            rows += batch.num_rows
            for chunk in word_chunks(batch.column(0), ALNUM_WORDS, LOWER_ASCII):
                _, term, _ = known.find(chunk)
                total += np.bincount(term, minlength=len(total))
        have = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(have, -1).astype(np.int32)), pa.array(np.append(total[have], rows))], ["term", "n"])

    # a task gives a row for each term it met: few tasks, whatever the number of files
    few = documents.select(text).coalesce(4 * spark.sparkContext.defaultParallelism)
    counted = few.mapInArrow(tidy(count), "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    shared.unpersist()
    by_term = np.zeros(len(vocabulary) + 1, dtype=np.int64)  # the last is the number of rows
    by_term[counted.column("term").to_numpy()] = counted.column("n").to_numpy()
    return by_term[:-1], int(by_term[-1])


class BlockMaxIndex:
    """Postings of example vectors: per term and block of examples, the largest weight and the
    weights themselves."""

    def __init__(self, n_terms: int, vectors: list[tuple[np.ndarray, np.ndarray]]):
        blocks = -(-len(vectors) // BLOCK)
        self.n, self.most = len(vectors), np.zeros((n_terms, max(blocks, 1)))
        self.postings: dict[tuple[int, int], tuple[list, list]] = {}
        for i, (terms, weights) in enumerate(vectors):
            for t, w in zip(terms.tolist(), weights.tolist()):
                own = self.postings.setdefault((t, i // BLOCK), ([], []))
                own[0].append(i % BLOCK)
                own[1].append(w)
                self.most[t, i // BLOCK] = max(self.most[t, i // BLOCK], w)
        self.postings = {k: (np.array(a), np.array(b)) for k, (a, b) in self.postings.items()}

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> list[tuple[float, int]]:
        """The k examples of largest similarity above 0, exactly; ties by example order."""
        bounds = weights @ self.most[terms]
        best: list[tuple[float, int]] = []
        for block in np.argsort(-bounds, kind="stable").tolist():
            bound = bounds[block]
            if bound <= 0 or (len(best) == k and bound < best[-1][0] - 1e-12):
                break
            scores = np.zeros(BLOCK)
            for t, w in zip(terms.tolist(), weights.tolist()):
                own = self.postings.get((t, block))
                if own is not None:
                    scores[own[0]] += w * own[1]
            if without // BLOCK == block and without >= 0:
                scores[without % BLOCK] = 0
            at = np.flatnonzero(scores > (best[-1][0] - 1e-12 if len(best) == k else 0))
            best = sorted(best + [(round(float(scores[i]), 12), block * BLOCK + int(i)) for i in at], key=lambda x: (-x[0], x[1]))[:k]
        return best


class WideIndex:
    """Exact search over all terms of the examples, for many queries at a time.

    Lists of rare terms are summed as they are. Common terms have their weights in blocks of
    examples, with the largest of a block; examples led by the same common term stand together,
    so that block maxima are close. Only the vectors are broadcast: a task builds the lists.
    """

    def __init__(self, n_terms: int, first: np.ndarray, terms: np.ndarray, weights: np.ndarray):
        self.n_terms, self.n = n_terms, len(first) - 1
        self.first, self.terms, self.weights = first, terms, weights

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "lists"}

    @cached_property
    def lists(self) -> tuple:
        owner = np.repeat(np.arange(self.n), np.diff(self.first))
        common = np.flatnonzero(np.bincount(self.terms, minlength=self.n_terms) * COMMON > self.n)
        number = np.full(self.n_terms, -1, dtype=np.int32)
        number[common] = np.arange(len(common))
        own = number[self.terms]
        dense, rare = np.flatnonzero(own >= 0), np.flatnonzero(own < 0)
        lead = np.full(self.n, -1)
        by_weight = dense[np.lexsort((self.weights[dense], owner[dense]))]
        lead[owner[by_weight]] = own[by_weight]  # the last, heaviest one stays
        examples = np.argsort(lead, kind="stable")
        place = np.empty(self.n, dtype=np.int64)
        place[examples] = np.arange(self.n)
        n_blocks = max(-(-self.n // WIDE_BLOCK), 1)
        blocks = np.zeros((n_blocks, len(common), WIDE_BLOCK))
        at = place[owner[dense]]
        blocks[at // WIDE_BLOCK, own[dense], at % WIDE_BLOCK] = self.weights[dense]
        rare = rare[np.argsort(self.terms[rare], kind="stable")]
        starts = np.concatenate(([0], np.cumsum(np.bincount(self.terms[rare], minlength=self.n_terms))))
        return number, blocks, blocks.max(axis=2).T, starts, place[owner[rare]], self.weights[rare], examples, place

    def nearest(
        self, row: np.ndarray, term: np.ndarray, weight: np.ndarray, rows: int, k: int, without: np.ndarray | None = None
    ) -> list[list[tuple[float, int]]]:
        """For each of ``rows`` queries (sorted ``row``, its terms and weights), the k examples of
        largest similarity above 0, exactly; ties by example order."""
        starts, found = self.lists[3], []
        ends = np.searchsorted(row, np.arange(rows + 1))
        work = np.concatenate(([0], np.cumsum(starts[term + 1] - starts[term])))[ends]
        lo = 0
        while lo < rows:
            hi = int(np.searchsorted(work, work[lo] + POSTINGS, side="right")) - 1
            hi = min(max(hi, lo + 1), lo + QUERIES, rows)
            part = slice(ends[lo], ends[hi])
            found += self._nearest(row[part] - lo, term[part], weight[part], hi - lo, k, None if without is None else without[lo:hi])
            lo = hi
        return found

    def _nearest(self, row, term, weight, rows: int, k: int, without) -> list[list[tuple[float, int]]]:
        number, blocks, most, starts, postings, listed, examples, place = self.lists
        own = number[term]
        query = np.zeros((rows, most.shape[0]))
        query[row[own >= 0], own[own >= 0]] = weight[own >= 0]
        size = starts[term + 1] - starts[term]
        at = np.repeat(starts[term] - np.cumsum(size) + size, size) + np.arange(size.sum())
        shape = (rows, len(blocks), WIDE_BLOCK)
        scores = np.bincount(
            np.repeat(row * (shape[1] * shape[2]), size) + postings[at], np.repeat(weight, size) * listed[at], minlength=math.prod(shape)
        ).astype(float).reshape(shape)  # of no postings it gives integers
        bounds = scores.max(axis=2) + query @ most
        best = np.zeros((rows, k))  # so far; the k-th best is the first
        for block in np.argsort(-bounds.sum(axis=0), kind="stable").tolist():
            hopeful = (bounds[:, block] > 0) & (bounds[:, block] >= best[:, 0] - 1e-9)
            scores[~hopeful, block] = 0  # none of these is among the k best
            asks = np.flatnonzero(hopeful)
            if not len(asks):
                continue
            sums = scores[asks, block] + query[asks] @ blocks[block]
            if without is not None:
                own = place[without[asks]] - block * WIDE_BLOCK
                here = np.flatnonzero((own >= 0) & (own < WIDE_BLOCK))
                sums[here, own[here]] = 0
            scores[asks, block] = sums
            best[asks] = np.partition(np.concatenate((best[asks], sums), axis=1), WIDE_BLOCK, axis=1)[:, WIDE_BLOCK:]
        scores = scores.reshape(rows, -1)
        of, at = np.nonzero((scores > 0) & (scores >= best[:, :1] - 1e-12))
        similar, number = np.round(scores[of, at], 12), examples[at]
        order = np.lexsort((number, -similar, of))
        of, similar, number = of[order], similar[order].tolist(), number[order].tolist()
        ends = np.searchsorted(of, np.arange(rows + 1)).tolist()
        return [list(zip(similar[a : min(a + k, b)], number[a : min(a + k, b)])) for a, b in zip(ends, ends[1:])]


@dataclass
class Model:
    vocabulary: Vocabulary
    wide: WideIndex
    #: Over the telling terms, of the examples ``told`` that have one.
    index: BlockMaxIndex
    told: np.ndarray
    ids: list
    labels: np.ndarray
    weights: np.ndarray
    prior: float
    nothing: float
    #: Offset, and the slopes of the votes by telling and by all terms.
    curve: tuple[float, float, float] = (0.0, 1.0, 1.0)
    #: Examples by their word sequence: equal texts are evidence whatever terms tell.
    copies: dict = field(default_factory=dict)

    def by_telling_terms(self, vector: tuple | None, sequence: tuple[int, int] | None, without: int = -1) -> list[tuple[float, int]]:
        """Copies of the text first, then the nearest examples by cosine over telling terms."""
        same = [i for i in self.copies.get(sequence, []) if i != without]
        own = int(np.searchsorted(self.told, without)) if without >= 0 else -1
        near = [(x, int(self.told[i])) for x, i in self.index.nearest(*vector, NEIGHBOURS, own)] if vector is not None else []
        return ([(1.0, i) for i in same] + [x for x in near if x[1] not in same])[:NEIGHBOURS]

    def vote(self, found: list[tuple[float, int]], fall: int = 1) -> float:
        """Distance-weighted share of toxic neighbours, beside a prior vote."""
        toxic, total = PRIOR_VOTE * self.prior, PRIOR_VOTE
        for similarity, i in found:
            w = self.weights[i] * (similarity / (1.05 - min(similarity, 1.0))) ** fall
            total += w
            toxic += w * self.labels[i]
        return toxic / total

    def votes(self, told: list[tuple[float, int]], near: list[tuple[float, int]]) -> tuple[float, float]:
        """What the votes by telling and by all terms add to the prior's log-odds."""
        prior = _logit(self.prior)
        return _logit(self.vote(told) if told else self.nothing) - prior, _logit(self.vote(near, WIDE_FALL)) - prior

    def score(self, told: list[tuple[float, int]], near: list[tuple[float, int]]) -> float:
        if not told and not near:
            return self.nothing
        offset, *slopes = self.curve
        return float(_logistic(_logit(self.prior) + offset + np.dot(slopes, self.votes(told, near))))


def _logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return math.log(p / (1 - p))


def _logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _calibrate(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray, prior: float) -> tuple[float, float, float]:
    """Offset and slopes of a logistic curve from votes to labels (Newton steps, a weak prior at
    slopes of 1 and offset 0)."""
    x = np.concatenate((np.ones((len(votes), 1)), votes), axis=1)
    weights = weights / weights.mean()
    expected = np.array([0.0, *[1.0] * votes.shape[1]])
    beta, least = expected, np.array([-np.inf, *[LEAST_SLOPE] * votes.shape[1]])
    for _ in range(50):
        p = _logistic(_logit(prior) + x @ beta)
        grad = x.T @ (weights * (p - labels)) + (beta - expected)
        hess = (x * (weights * p * (1 - p))[:, None]).T @ x + np.eye(len(beta))
        beta = np.maximum(beta - np.clip(np.linalg.solve(hess, grad), -2, 2), least)
    return tuple(beta.tolist())


def fit(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", most: int = MAX_EXAMPLES) -> Model:
    """The model from labelled rows that are not held out. What reaches the driver is bounded:
    the examples' ids, the vocabulary, one count per term, and the examples' vectors."""
    spark = documents.sparkSession
    chosen, (negatives, positives) = choose_examples(labels, doc_id, label, most)
    rate = positives / (negatives + positives) if chosen else 0.5
    none, real = np.zeros(0, dtype=np.int64), np.zeros(0)
    if not positives or not negatives:
        return Model(Vocabulary(none), WideIndex(0, np.zeros(1, dtype=np.int64), none, real), BlockMaxIndex(0, []), none, [], real, real, rate, rate)
    kind = documents.schema[doc_id].dataType.simpleString()
    ids = spark.createDataFrame([(i, y) for i, y, _ in chosen], f"id {labels.schema[doc_id].dataType.simpleString()}, y int").select(F.col("id").cast(kind), "y")
    # at most 2 * most rows: small enough for every executor
    examples = documents.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(ids), "id")
    examples = materialise(examples.select("id", "y", "text"), "examples")
    counts = {r["y"]: r["n"] for r in examples.groupBy("y").agg(F.count("*").alias("n")).collect()}
    vocabulary = Vocabulary(all_terms(examples), choose_vocabulary(examples, counts.get(1, 0), counts.get(0, 0)))
    if len(vocabulary):
        frequency, n = document_frequencies(documents, vocabulary, text)
        vocabulary.idf = np.log((1 + n) / (1 + frequency)) + 1
    shared = spark.sparkContext.broadcast(vocabulary)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in word_chunks(batch.column(2), ALNUM_WORDS, LOWER_ASCII):
                row, term, weight = shared.value.vectors(chunk)
                size = chunk.hi - chunk.lo
                ends = pa.array(np.searchsorted(row, np.arange(size + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.lo, size),
                        batch.column(1).slice(chunk.lo, size),
                        pa.ListArray.from_arrays(ends, pa.array(term, pa.int32())),
                        pa.ListArray.from_arrays(ends, pa.array(weight)),
                        pa.array(_sequences(chunk), pa.list_(pa.int64())),
                    ],
                    ["id", "y", "terms", "weights", "code"],
                )

    columns = f"id {kind}, y int, terms array<int>, weights array<double>, code array<long>"
    rows = examples.mapInArrow(tidy(vectors), columns).toArrow()
    shared.unpersist()
    ids, codes = rows.column("id").to_pylist(), rows.column("code").to_pylist()
    order = sorted(range(len(ids)), key=lambda i: (ids[i], codes[i] or []))
    rows = rows.take(pa.array(order, pa.int64())).combine_chunks()
    ids, codes = [ids[i] for i in order], [tuple(codes[i] or ()) for i in order]
    labels_of = rows.column("y").to_numpy().astype(float)
    times = {y: w for _, y, w in chosen}
    weights_of = np.array([times[y] for y in labels_of.tolist()])
    sizes = pc.list_value_length(rows.column("terms")).to_numpy().astype(np.int64)
    first = np.concatenate(([0], np.cumsum(sizes)))
    terms, weights = (pc.list_flatten(rows.column(c)).to_numpy() for c in ("terms", "weights"))
    told = vocabulary.telling_vectors(np.repeat(np.arange(len(ids)), sizes), terms, weights)
    idle = np.ones(len(ids), dtype=bool)
    idle[list(told)] = False
    nothing = float((weights_of[idle] @ labels_of[idle] + PRIOR_VOTE * rate) / (weights_of[idle].sum() + PRIOR_VOTE))
    copies: dict = {}
    for i, code in enumerate(codes):
        if code:
            copies.setdefault(code, []).append(i)
    model = Model(
        vocabulary, WideIndex(len(vocabulary), first, terms, weights), BlockMaxIndex(vocabulary.n_telling, list(told.values())),
        np.array(list(told), dtype=np.int64), ids, labels_of, weights_of, rate, nothing,
        copies={code: own[:NEIGHBOURS] for code, own in copies.items()},
    )
    calibrate(spark, model)
    return model


def calibrate(spark: SparkSession, model: Model) -> None:
    """The curve, from the votes on each example when it is left out."""
    shared = spark.sparkContext.broadcast(model)

    def left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        wide = own.wide
        for batch in batches:
            examples = batch.column(0).to_numpy()
            size = np.diff(wide.first)[examples]
            row = np.repeat(np.arange(len(examples)), size)
            at = np.repeat(wide.first[examples] - np.cumsum(size) + size, size) + np.arange(size.sum())
            term, weight = wide.terms[at], wide.weights[at]
            telling = own.vocabulary.telling_vectors(row, term, weight)
            votes = []
            for r, (i, near) in enumerate(zip(examples.tolist(), wide.nearest(row, term, weight, len(examples), NEIGHBOURS, examples))):
                told = own.by_telling_terms(telling.get(r), None, i) if r in telling else []
                votes.append(own.votes(told, near))
            by_telling, by_all = zip(*votes) if votes else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(by_telling, pa.float64()), pa.array(by_all, pa.float64())], ["example", "by_telling", "by_all"]
            )

    examples = spark.range(len(model.ids)).mapInArrow(tidy(left_out), "example long, by_telling double, by_all double").toArrow()
    shared.unpersist()
    at = examples.column("example").to_numpy()
    if len(at):
        votes = np.stack([examples.column(c).to_numpy() for c in ("by_telling", "by_all")], axis=1)
        order = np.argsort(at)  # sums do not depend on the tasks
        model.curve = _calibrate(votes[order], model.labels, model.weights, model.prior)


def score(documents: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``, ``evidence`` (ids of equal examples and
    of the nearest by telling terms) and ``nearest`` (ids of the nearest examples over all
    terms) of every document."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    kind = documents.schema[doc_id].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            scores = np.full(batch.num_rows, own.nothing)
            evidence, nearest = ([[] for _ in range(batch.num_rows)] for _ in range(2))
            for chunk in word_chunks(batch.column(1), ALNUM_WORDS, LOWER_ASCII) if own.ids else ():
                row, term, weight = own.vocabulary.vectors(chunk)
                telling = own.vocabulary.telling_vectors(row, term, weight)
                found = own.wide.nearest(row, term, weight, chunk.hi - chunk.lo, NEIGHBOURS)
                for r, (sequence, near) in enumerate(zip(_sequences(chunk), found)):
                    if near:
                        told = own.by_telling_terms(telling.get(r), sequence)
                        scores[chunk.lo + r] = own.score(told, near)
                        evidence[chunk.lo + r] = [own.ids[i] for _, i in told[:5]]
                        nearest[chunk.lo + r] = [own.ids[i] for _, i in near[:5]]
            ids = pa.list_(batch.column(0).type)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), pa.array(evidence, ids), pa.array(nearest, ids)], ["doc_id", "score", "evidence", "nearest"]
            )

    scored = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        tidy(rows), f"doc_id {kind}, score double, evidence array<{kind}>, nearest array<{kind}>"
    )
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", predicted, "evidence", "nearest")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from qalens.sources.supplied import read_supplied

    documents = read_supplied(spark, sf_dir, "documents")
    return score(documents, fit(documents, read_supplied(spark, sf_dir, "labels")))
