"""BPE encoding by prefix-sharing trie traversal, and decoding.

The distinct words of a batch of texts form a trie. It is walked depth first (the words in
sorted order, a stack of states along the current path); each node's state is the last token
of its prefix's encoding, found from the states above it: the one token that ends here and
may follow the state where it begins. So a prefix shared by many words is encoded once, and a
word's tokens are read off by following last tokens back to the root. No merge is ever
replayed per word, and no text is encoded twice within a task's words.

Vocabulary, normalisation, word pattern and special strings come from a ``tokenizers`` JSON
file (a path parameter). Texts are never shuffled; a task's memory is bounded by
a part of a batch and ``REMEMBER`` words.

Defined results: a null or empty text has no tokens and decodes to the empty string; other
columns pass through only if asked for; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator, Sequence
from functools import cached_property, lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qalens.llm._text import text_parts, tidy

#: Words, and pairs of tokens, that a worker keeps between batches (words: in two generations).
REMEMBER = 150_000
END = "</w>"
_RARE = re.compile("[^\x00-\u02ff\u2010-\u2027\u20ac]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = {b: chr(b) for b in plain}, 0x100
    for b in range(256):
        if b not in out:
            out[b] = chr(extra)
            extra += 1
    return [out[b] for b in range(256)]


class Vocabulary:
    """Tokens and merges, with the test whether one token may follow another."""

    def __init__(self, spec: dict):
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {pair: r for r, pair in enumerate(merges)}
        self.made_by = {}
        for left, right in merges:
            self.made_by.setdefault(left + right, (left, right))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._follows: dict[str, dict[str, bool]] = {}
        self._n_follows = 0
        self._whole: dict[str, bool] = {}
        self._edges: dict[tuple[str, int], list[tuple[str, int]]] = {}

    def _edge(self, token: str, side: int) -> list[tuple[str, int]]:
        """The pieces that form a token's left (0) or right (1) edge in turn, each with the
        rank of the merge that made it (-1: a single symbol)."""
        known = self._edges.get((token, side))
        if known is None:
            known, piece = [], token
            while piece in self.made_by:
                parts = self.made_by[piece]
                known.append((piece, self.rank[parts]))
                piece = parts[side]
            known.append((piece, -1))
            known.reverse()
            self._edges[token, side] = known
        return known

    def follows(self, left: str, right: str) -> bool:
        """Whether merging ``left + right`` leaves the boundary between them.

        The pieces at the boundary grow on both sides; it is lost if, while two of them are
        there together, their own merge comes first. Of equal merges the leftmost comes first.
        """
        known = self._follows.setdefault(left, {})
        if right in known:
            return known[right]
        a, b = self._edge(left, 1), self._edge(right, 0)
        i = j = 0
        kept = True
        while True:
            ends_a = a[i + 1][1] if i + 1 < len(a) else len(self.rank)
            ends_b = b[j + 1][1] if j + 1 < len(b) else len(self.rank)
            r = self.rank.get((a[i][0], b[j][0]))
            if r is not None and r < ends_a and r <= ends_b:
                kept = False
                break
            if i + 1 == len(a) and j + 1 == len(b):
                break
            if ends_a <= ends_b:
                i += 1
            else:
                j += 1
        if self._n_follows > REMEMBER:
            for own in self._follows.values():  # the walks hold on to these dicts
                own.clear()
            self._n_follows = 0
        known[right] = kept
        self._n_follows += 1
        return kept

    def whole(self, token: str) -> bool:
        """Whether a token's own characters encode to the token."""
        known = self._whole.get(token)
        if known is None:
            parts = self.made_by.get(token)
            known = parts is None or (self.whole(parts[0]) and self.whole(parts[1]) and self._joins(*parts))
            self._whole[token] = known
        return known

    def _joins(self, left: str, right: str) -> bool:
        """Whether no other merge across the boundary comes before that of the two parts."""
        a, b = self._edge(left, 1), self._edge(right, 0)
        i = j = 0
        while i + 1 < len(a) or j + 1 < len(b):
            ends_a = a[i + 1][1] if i + 1 < len(a) else len(self.rank)
            ends_b = b[j + 1][1] if j + 1 < len(b) else len(self.rank)
            r = self.rank.get((a[i][0], b[j][0]))
            if r is not None and r < ends_a and r <= ends_b:
                return False
            if ends_a <= ends_b:
                i += 1
            else:
                j += 1
        return True

    @cached_property
    def endings(self) -> dict[str, str]:
        """Ids of the tokens that stand for their own encoding, as decimals."""
        return {t: str(i) for t, i in self.ids.items() if self.whole(t)}

    @cached_property
    def reach(self) -> dict[str, int]:
        """Symbols of the longest token that ends in these two symbols."""
        out: dict[str, int] = {}
        for t in self.endings:
            body = t.removesuffix(END)
            key = body[-2:] + t[len(body) :]
            out[key] = max(out.get(key, 1), len(body))
        return out

    def encode_words(self, words: Iterable[str]) -> Iterator[tuple[str, str]]:
        """Ids of distinct words, given in sorted order: a depth-first walk of their trie.

        ``states[n]`` is the last token of the encoding of the path's first ``n`` symbols. Of
        the tokens that end there, exactly one stands for the whole prefix or may follow the
        state where it begins.
        """
        endings, reach, known = self.endings, self.reach, self._follows
        path, states, after = "", [""], [{}]

        def last(word: str, n: int, end: str = "") -> str:
            for size in range(min(n, reach.get(word[max(0, n - 2) : n] + end, 1)), 0, -1):
                token = word[n - size : n] + end
                if token in endings:
                    if size == n:
                        return token
                    fits = after[n - size].get(token)
                    if fits is None:
                        fits = self.follows(states[n - size], token)
                    if fits:
                        return token
            raise ValueError(f"no encoding ends {word[:n] + end!r}: the vocabulary lacks one of its symbols")

        for word in words:
            # back up to the branch, then down along the new part
            same, most = 0, min(len(states) - 1, len(word))
            if word[:most] == path[:most]:
                same = most
            else:
                while path[same] == word[same]:
                    same += 1
            del states[same + 1 :], after[same + 1 :]
            for n in range(same + 1, len(word)):
                token = last(word, n)
                states.append(token)
                after.append(known.setdefault(token, {}))
            path = word
            token = last(word, len(word), END)
            out, n = [endings[token]], len(word) - (len(token) - len(END))
            while n:
                token = states[n]
                out.append(endings[token])
                n -= len(token)
            yield word, " ".join(out[::-1])


class Encoder:
    """Text to words to ids for one tokenizer file."""

    def __init__(self, spec: dict):
        from tokenizers import Regex, pre_tokenizers

        self.vocabulary = Vocabulary(spec)
        self._normalise = _normaliser(spec)
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # white space by its Unicode property, as the pattern's own engine has it
        self._pattern = regex.compile(pattern.replace("[^\\s", "[^\\p{White_Space}"))
        # engines differ in the letters of recent Unicode versions: texts beyond the long
        # settled blocks are split by the file's own engine
        self._exact = pre_tokenizers.Split(Regex(pattern), "removed", invert=True).pre_tokenize_str
        # the same on ASCII alone, for the faster engine
        self._ascii = re.compile(re.sub(r"\\p\{L\}", "a-zA-Z", re.sub(r"\\p\{N\}", "0-9", pattern)).replace("\\s", "\\t-\\r "))
        self._special = re.compile("|".join(map(re.escape, sorted(self.vocabulary.special, key=len, reverse=True))) or r"(?!)")
        self._symbols = byte_symbols()
        self.forget()

    def forget(self) -> None:
        """Drop the words that were not met since the last time."""
        self.older: dict[str, str] = getattr(self, "known", {})
        self.known: dict[str, str] = {t: str(i) for t, i in self.vocabulary.special.items()}

    def _words(self, text: str) -> list[str]:
        if text.isascii():
            return self._ascii.findall(text.lower())
        text = self._normalise(text)
        if _RARE.search(text):
            return [w for w, _ in self._exact(text)]
        return self._pattern.findall(text)

    def split(self, text: str) -> list[str]:
        """Words in order; special strings stand for themselves."""
        if "<|" not in text or not self._special.search(text):
            return self._words(text)
        out, at = [], 0
        for m in self._special.finditer(text):
            out += self._words(text[at : m.start()])
            out.append(m.group())
            at = m.end()
        return out + self._words(text[at:])

    def learn(self, words: Iterable[str]) -> None:
        """Encode the words not yet known, all in one walk."""
        new, known, older = {}, self.known, self.older
        for w in words:
            if w in known:
                continue
            if w in older:
                known[w] = older[w]
            else:
                # printable ASCII stands for itself
                new[w if w.isascii() and w.isprintable() else "".join([self._symbols[b] for b in w.encode()])] = w
        for symbols, ids in self.vocabulary.encode_words(sorted(new)):
            self.known[new[symbols]] = ids

    def encode(self, texts: list[str]) -> list[str]:
        """Ids of each text, as decimals joined by one space."""
        if len(self.known) > REMEMBER:
            self.forget()
        split = [self.split(t) for t in texts]
        self.learn({w for words in split for w in words})
        known = self.known
        return [" ".join([known[w] for w in words]) for words in split]


def _normaliser(spec: dict):
    from tokenizers import normalizers

    own = spec["normalizer"]["normalizers"]
    made = {"NFC": normalizers.NFC, "Lowercase": normalizers.Lowercase}
    kinds = [made[x["type"]]() for x in own if x["type"] in made]  # white space is dropped anyway
    return normalizers.Sequence(kinds).normalize_str


@lru_cache(maxsize=2)
def _encoder(text: str) -> Encoder:
    return Encoder(json.loads(text))


@lru_cache(maxsize=2)
def _tokens(text: str) -> dict[str, str]:
    spec = json.loads(text)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    return {str(i): t for t, i in {**spec["model"]["vocab"], **special}.items()}


def _tokenizer_json(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return json.dumps(json.load(f))


def _decoded(tokens: dict[str, str], ids: list[str]) -> pa.Array:
    return pa.array([" ".join([tokens[x] for x in own.split()]) if own else "" for own in ids], pa.string())


def encode(
    documents: DataFrame, tokenizer: str, text: str = "text", keep_columns: Sequence[str] = ("doc_id",), decode_to: str | None = None
) -> DataFrame:
    """``keep_columns`` with ``ids`` (decimals joined by one space) and ``n_tokens``;
    ``decode_to`` adds what :func:`decode` makes of the ids, in the same pass."""
    source = documents.sparkSession.sparkContext.broadcast(_tokenizer_json(tokenizer))
    schema = T.StructType([documents.schema[c] for c in keep_columns]).add("ids", "string").add("n_tokens", "long")
    if decode_to:
        schema = schema.add(decode_to, "string")
    at = len(keep_columns)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(source.value)
        for batch in batches:
            for part in text_parts(batch, at):
                ids = encoder.encode([t or "" for t in part.column(at).to_pylist()])
                sizes = [x.count(" ") + 1 if x else 0 for x in ids]
                more = [_decoded(_tokens(source.value), ids)] if decode_to else []
                yield pa.RecordBatch.from_arrays([*part.columns[:at], pa.array(ids, pa.string()), pa.array(sizes, pa.int64()), *more], schema.names)

    return documents.select(*keep_columns, F.col(text).alias("_text")).mapInArrow(tidy(rows), schema)


def decode(encoded: DataFrame, tokenizer: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """The frame with ``to``: the tokens of ``ids``, special ones included, joined by one
    space (the file names no decoder)."""
    source = encoded.sparkSession.sparkContext.broadcast(_tokenizer_json(tokenizer))
    schema = T.StructType(list(encoded.schema)).add(to, "string")
    at = encoded.columns.index(ids)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(source.value)
        for batch in batches:
            for part in text_parts(batch, at):
                yield pa.RecordBatch.from_arrays([*part.columns, _decoded(tokens, part.column(at).to_pylist())], schema.names)

    return encoded.mapInArrow(tidy(rows), schema)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from qalens.sources.supplied import read_supplied

    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    both = encode(read_supplied(spark, sf_dir, "documents"), tokenizer, decode_to="decoded")
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
