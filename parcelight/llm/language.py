"""Language identification with segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary. A word
is the sum over all its segmentations of the product of their pieces'
probabilities, which a forward pass over the word's letters computes; a text is the
product over its words (runs of letters, lower case, with the vocabulary's word start mark).
Learning is expectation maximisation: a forward and a backward pass give the expected
uses of each piece in each word, under the probabilities so far (uniform at first).
Tasks sum them over their part of all learning documents and Spark adds them up, so
what reaches the driver is one number per piece and language.

Words are computed side by side and remembered up to a bound; very long words go
letter by letter in logarithms. A letter that no piece starts with is stepped over at
a fixed price, the same in each language.

Defined cases: a null text or one without letters is ``und`` with score 0, and so is
any text when nothing was learnt; null languages teach nothing; equal scores go to
the first language in alphabetical order; repeated rows count as rows; texts may be
of any length; input columns named like the result's are replaced; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelight.llm.common import slices, without

UNDETERMINED = "und"
MARK = "▁"
LONGEST_PIECE = 16
LONG_WORD = 40  # letters from which a word goes letter by letter
UNKNOWN = 1e-7  # price of a letter outside the vocabulary
ROUNDS = 1
SMOOTHING = 50.0
WORDS_AT_ONCE = 5_000
REMEMBERED = 400_000
_letters = re.compile(r"[^\W\d_]+")


def words_in(text: str | None) -> list[str]:
    # Numerals that are no letters match too; a word has a letter.
    found = _letters.findall(text.lower()) if text else []
    return [w for w in found if w.isalpha() or any(map(str.isalpha, w))]


class Pieces:
    """The vocabulary: pieces of lower-case letters, with or without the mark."""

    def __init__(self, pieces: list[str]):
        kept = sorted({
            p for p in pieces
            if p == p.lower() and len(p) <= LONGEST_PIECE
            and (p == MARK or p.removeprefix(MARK).isalpha())
        })
        self.number = {p: i for i, p in enumerate(kept)}
        self.count = len(kept)
        self.starts = {p[:k] for p in kept for k in range(1, len(p) + 1)}
        self.table: PrefixTable | None = None

    @classmethod
    def read(cls, path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return cls([model.id_to_piece(i) for i in range(model.vocab_size())])

    def edges(self, word: str) -> list[tuple[int, int, int]]:
        """(start, end, piece) of every piece in the marked word; piece -1 steps
        over a letter that has none of its own."""
        found = []
        for start in range(len(word)):
            alone = False
            for end in range(start + 1, min(len(word), start + LONGEST_PIECE) + 1):
                part = word[start:end]
                if part not in self.starts:
                    break
                piece = self.number.get(part)
                if piece is not None:
                    found.append((start, end, piece))
                    alone |= end == start + 1
            if not alone:
                found.append((start, start + 1, -1))
        return found


class PrefixTable:
    """Piece number of a string by its rolling hash; -1 for a string that only
    starts pieces. Open addressing, an eighth full at most."""

    BASE = np.uint64(0x100000001B3)

    def __init__(self, pieces: Pieces):
        texts = sorted(pieces.starts)
        keys = np.array([self._hash(t) for t in texts], dtype=np.uint64)
        values = np.array([pieces.number.get(t, -1) for t in texts], dtype=np.int64)
        self.bits = max(4, int(len(keys) * 8).bit_length())
        self.keys = np.zeros(1 << self.bits, dtype=np.uint64)
        self.used = np.zeros(1 << self.bits, dtype=bool)
        self.values = np.zeros(1 << self.bits, dtype=np.int64)
        slots, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = ~self.used[slots]
            self.keys[slots[free]] = keys[left[free]]
            self.used[slots[free]] = True
            placed = self.keys[slots] == keys[left]
            self.values[slots[placed]] = values[left[placed]]
            slots, left = (slots[~placed] + 1) % len(self.keys), left[~placed]

    def _hash(self, text: str) -> int:
        h = 0
        for c in text:
            h = (h * int(self.BASE) + ord(c)) & 0xFFFFFFFFFFFFFFFF
        return h

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(known, value) of each key."""
        slots = self._slot(keys)
        known = self.used[slots] & (self.keys[slots] == keys)
        going = np.flatnonzero(self.used[slots] & ~known)
        while len(going):
            slots[going] = (slots[going] + 1) % len(self.keys)
            used = self.used[slots[going]]
            hit = used & (self.keys[slots[going]] == keys[going])
            known[going[hit]] = True
            going = going[used & ~hit]
        return known, self.values[slots]


class Lattice:
    """Segmentations of many short words side by side. Edges are kept by length:
    among those of one length, a word has at most one that ends at a place."""

    def __init__(self, pieces: Pieces, words: list[str]):
        if pieces.table is None:
            pieces.table = PrefixTable(pieces)
        text = "".join([MARK + w for w in words])
        codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
        self.sizes = np.array([len(w) + 1 for w in words])
        word = np.repeat(np.arange(len(words)), self.sizes)
        start = np.arange(len(codes)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        room = self.sizes[word] - start
        at, key = np.arange(len(codes)), codes
        # (words, starts, pieces) by length
        self.edges: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for length in range(1, LONGEST_PIECE + 1):
            known, piece = pieces.table.find(key)
            is_piece = known & (piece >= 0)
            if length == 1:  # a letter without a piece of its own is stepped over
                self.edges.append((word, start, np.where(is_piece, piece, -1)))
            else:
                hit = at[is_piece]
                self.edges.append((word[hit], start[hit], piece[is_piece]))
            going = known & (room[at] > length)
            at = at[going]
            if not len(at):
                break
            key = key[going] * PrefixTable.BASE + codes[at + length]
        self.places = int(self.sizes.max()) + 1

    def _by_place(self, place: np.ndarray) -> list[np.ndarray]:
        order = np.argsort(place.astype(np.uint8), kind="stable")
        ends = np.cumsum(np.bincount(place, minlength=self.places))
        return [order[e - n : e] for e, n in zip(ends, np.diff(np.r_[0, ends]))]

    def forward(self, shares: np.ndarray) -> np.ndarray:
        """(places, words, languages): sums over the segmentations up to there."""
        alpha = np.zeros((self.places, len(self.sizes), shares.shape[1]))
        alpha[0] = 1
        steps = [self._by_place(e[1] + k) for k, e in enumerate(self.edges, 1)]
        for end in range(1, self.places):
            for length, (word, _, piece) in enumerate(self.edges, 1):
                chosen = steps[length - 1][end]
                if len(chosen):
                    w = word[chosen]
                    alpha[end, w] += alpha[end - length, w] * shares[piece[chosen]]
        return alpha

    def backward(self, shares: np.ndarray) -> np.ndarray:
        """As :meth:`forward`, for the segmentations from there to the end."""
        beta = np.zeros((self.places, len(self.sizes), shares.shape[1]))
        beta[self.sizes, np.arange(len(self.sizes))] = 1
        steps = [self._by_place(e[1]) for e in self.edges]
        for start in reversed(range(self.places)):
            for length, (word, _, piece) in enumerate(self.edges, 1):
                chosen = steps[length - 1][start]
                if len(chosen):
                    w = word[chosen]
                    beta[start, w] += beta[start + length, w] * shares[piece[chosen]]
        return beta

    def whole(self, alpha: np.ndarray) -> np.ndarray:
        return alpha[self.sizes, np.arange(len(self.sizes))]


def _log_lattice(
    pieces: Pieces, word: str, log_shares: np.ndarray
) -> tuple[list[tuple[int, int, int]], np.ndarray, np.ndarray]:
    """Edges and forward and backward logarithms of one word of any length."""
    edges = pieces.edges(MARK + word)
    n = len(word) + 2
    alpha = np.full((n, log_shares.shape[1]), -np.inf)
    beta = alpha.copy()
    alpha[0] = beta[-1] = 0
    for a, b, p in sorted(edges, key=lambda e: e[1]):
        alpha[b] = np.logaddexp(alpha[b], alpha[a] + log_shares[p])
    for a, b, p in sorted(edges, key=lambda e: -e[0]):
        beta[a] = np.logaddexp(beta[a], beta[b] + log_shares[p])
    return edges, alpha, beta


def _with_unknown(shares: np.ndarray) -> np.ndarray:
    return np.vstack([shares, np.full((1, shares.shape[1]), UNKNOWN)])


def log_likelihoods(pieces: Pieces, words: list[str], shares: np.ndarray) -> np.ndarray:
    """(words, languages): log of the sum over all segmentations."""
    known = _with_unknown(shares)
    out = np.zeros((len(words), shares.shape[1]))
    short = [i for i, w in enumerate(words) if len(w) < LONG_WORD]
    if short:
        lattice = Lattice(pieces, [words[i] for i in short])
        out[short] = np.log(lattice.whole(lattice.forward(known)))
    logs = np.log(known)
    for i, word in enumerate(words):
        if len(word) >= LONG_WORD:
            out[i] = _log_lattice(pieces, word, logs)[1][-1]
    return out


def expected_uses(
    pieces: Pieces, words: list[str], counts: np.ndarray, shares: np.ndarray
) -> np.ndarray:
    """(pieces, languages): expected uses of each piece, words weighted by
    ``counts`` (words, languages)."""
    known = _with_unknown(shares)
    uses = np.zeros((pieces.count + 1, shares.shape[1]))
    short = [i for i, w in enumerate(words) if len(w) < LONG_WORD]
    if short:
        lattice = Lattice(pieces, [words[i] for i in short])
        alpha, beta = lattice.forward(known), lattice.backward(known)
        scale = counts[short] / lattice.whole(alpha)
        for length, (word, start, piece) in enumerate(lattice.edges, 1):
            share = alpha[start, word] * known[piece] * beta[start + length, word]
            share *= scale[word]
            for k in range(shares.shape[1]):
                uses[:, k] += np.bincount(
                    piece % len(uses), weights=share[:, k], minlength=len(uses)
                )
    logs = np.log(known)
    for i, word in enumerate(words):
        if len(word) >= LONG_WORD:
            edges, alpha, beta = _log_lattice(pieces, word, logs)
            for a, b, p in edges:
                uses[p] += counts[i] * np.exp(alpha[a] + logs[p] + beta[b] - alpha[-1])
    return uses[:-1]


@dataclass
class Model:
    pieces: Pieces
    languages: list[str]
    shares: np.ndarray  # (pieces, languages)


class Scorer:
    """Word scores of a worker, remembered up to a bound."""

    def __init__(self, model: Model):
        self.model = model
        self.place: dict[str, int] = {}
        self.table = np.zeros((0, len(model.languages)))

    def scores(self, texts: list[str | None]) -> list[tuple[str, float]]:
        found = [words_in(t) for t in texts]
        if not self.model.languages:
            return [(UNDETERMINED, 0.0)] * len(texts)
        new = list({w for words in found for w in words}.difference(self.place))
        if len(self.place) + len(new) > REMEMBERED:
            self.place, self.table = {}, self.table[:0]
            new = list({w for words in found for w in words})
        parts = [self.table]
        for at in range(0, len(new), WORDS_AT_ONCE):
            part = new[at : at + WORDS_AT_ONCE]
            parts.append(log_likelihoods(self.model.pieces, part, self.model.shares))
        begin = len(self.table)
        self.place.update(zip(new, range(begin, begin + len(new))))
        self.table = np.vstack(parts)
        out = []
        for words in found:
            if not words:
                out.append((UNDETERMINED, 0.0))
                continue
            places = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
            total = self.table[places].sum(axis=0)
            best = int(np.argmax(total))
            odds = np.exp(total - total[best])
            out.append((self.model.languages[best], float(1 / odds.sum())))
        return out


def _summed_uses(
    docs: DataFrame, pieces, languages: list[str], shares, text: str, lang: str
) -> np.ndarray:
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((pieces, shares))
    number = {name: i for i, name in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, probabilities = sent.value
        uses = np.zeros_like(probabilities)
        seen: list[Counter[str]] = [Counter() for _ in languages]

        def settle() -> None:
            words = list(set().union(*seen))
            for at in range(0, len(words), WORDS_AT_ONCE):
                part = words[at : at + WORDS_AT_ONCE]
                counts = np.array([[c[w] for c in seen] for w in part], dtype=float)
                uses[:] += expected_uses(own, part, counts, probabilities)
            for c in seen:
                c.clear()

        for batch in slices(batches, text):
            for t, name in zip(batch.column(text).to_pylist(), batch.column(lang).to_pylist()):
                seen[number[name]].update(words_in(t))
            if sum(map(len, seen)) > REMEMBERED:
                settle()
        settle()
        piece, language = np.nonzero(uses)
        yield pa.RecordBatch.from_arrays(
            [pa.array(piece.astype(np.int32)), pa.array(language.astype(np.int32)),
             pa.array(uses[piece, language])],
            ["piece", "language", "uses"],
        )

    rows = (
        docs.select(text, lang).mapInArrow(run, "piece int, language int, uses double")
        .groupBy("piece", "language").agg(F.sum("uses").alias("uses")).toArrow()
    )
    total = np.zeros_like(shares)
    total[rows["piece"].to_numpy(), rows["language"].to_numpy()] = rows["uses"].to_numpy()
    return total


def fit(
    docs: DataFrame, path: str, text: str = "text", lang: str = "lang", rounds: int = ROUNDS
) -> Model:
    """Learns from all rows of ``docs`` with a text and a language. ``path``
    names the vocabulary on the driver."""
    given = docs.select(F.col(text).alias("_text"), F.col(lang).alias("_lang")).where(
        F.col("_text").isNotNull() & F.col("_lang").isNotNull()
    )
    # One row per language: a code list, not data.
    languages = sorted(r._lang for r in given.select("_lang").distinct().collect())
    pieces = Pieces.read(path)
    shares = np.full((pieces.count, len(languages)), 1 / pieces.count)
    if languages:
        for _ in range(rounds):
            uses = _summed_uses(given, pieces, languages, shares, "_text", "_lang")
            pooled = uses.sum(axis=1, keepdims=True) + 0.5
            pooled /= pooled.sum()
            shares = (uses + SMOOTHING * pooled) / (uses.sum(axis=0) + SMOOTHING)
    return Model(pieces, languages, shares)


def with_language(
    docs: DataFrame, model: Model, text: str = "text",
    names: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """All columns but those of the same names, the predicted language and its
    probability."""
    docs = without(docs, *names)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select(
        "*", F.lit("").alias(names[0]), F.lit(0.0).alias(names[1])
    ).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in slices(batches, text):
            found = scorer.scores(batch.column(text).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())],
                names=[*batch.schema.names, *names],
            )

    return docs.mapInArrow(run, schema)
