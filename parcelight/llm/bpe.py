"""Byte-pair encoding as a bounded-lookahead streaming transducer, and decoding.

A text is fed in chunks. What leaves the transducer are *spans* that no later
character can change:

* white space followed by a run of other characters is a span once the next
  white space is seen, as pieces never cross that border;
* of a run that goes on for longer than a buffer, a piece is a span once it ends
  three characters before what has been read (the longest contraction);
* inside one endless piece, a token is a span once it ends ``lookahead`` bytes
  before what has been read.

``lookahead`` follows from the merge list. A character to the right can only
change a token through a chain of merges: the merge (u', v') happens or not, so
u' is or is not there for the merge (u, v) of its left neighbour u, where v is u'
or starts with it. The neighbour's merge comes later in the list, so the chain's
ranks rise from right to left, and one pass over the list finds the longest.

Spans are turned into ids by merging all new pieces of a slice side by side
(numpy), and remembered in tables of bounded size. Chunk, buffer, window and
tables bound the memory, however long the text.

Decoding looks ids up and feeds their bytes to a state machine that holds back at
most three bytes of an unfinished character.

Defined cases: a null text is an empty one: no tokens, the digests of nothing.
Repeated rows stay, an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelight.llm.common import SLICE_BYTES, fresh_name, slices, without

CHUNK = 1 << 16  # characters fed at once
LONGEST_SPAN = 1 << 14  # characters of a run before its pieces are streamed
WINDOW = 1 << 12  # bytes merged at once inside an endless piece, plus lookahead
REMEMBERED = 400_000  # spans and pieces kept by a worker
SHORT_PIECE = 48  # bytes up to which pieces are merged side by side

# White space and the piece pattern of byte-level BPE.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PIECE = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
_span = regex.compile(rf"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
_piece = regex.compile(PIECE)
_runs = [
    regex.compile(p)
    for p in (r"\p{L}+", r"\p{N}+", rf"[^{SPACE}\p{{L}}\p{{N}}]+", rf"[{SPACE}]+")
]
_CONTRACTION = 3


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a vocabulary file:
    printable Latin-1 stands for itself, other bytes follow from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


@dataclass
class Vocabulary:
    """Tokens and merges of a byte-level BPE file."""

    tokens: list[bytes]  # by id
    rules: np.ndarray  # (n, 3) ids: left, right, merged; in order of rank
    specials: dict[str, int]
    digest: str
    lookahead: int = field(init=False)

    def __post_init__(self) -> None:
        self.lookahead = sufficient_lookahead(self)

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, "rb") as file:
            raw = file.read()
        spec = json.loads(raw)
        alphabet = byte_alphabet()
        ids: dict[str, int] = spec["model"]["vocab"]
        specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = [b""] * (max([*ids.values(), *specials.values()]) + 1)
        for text, number in ids.items():
            tokens[number] = (
                text.encode() if text in specials else bytes(alphabet[c] for c in text)
            )
        for text, number in specials.items():
            tokens[number] = text.encode()
        merges = [
            m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]
        ]
        rules = np.array(
            [(ids[a], ids[b], ids[a + b]) for a, b in merges], dtype=np.int64
        ).reshape(-1, 3)
        return cls(tokens, rules, specials, hashlib.sha256(raw).hexdigest())


def sufficient_lookahead(vocabulary: Vocabulary) -> int:
    """Bytes after the end of a token that decide it (see the module text)."""
    size = [len(t) for t in vocabulary.tokens]
    first: dict[int, int] = {}  # left part of a merged token
    reach: dict[int, int] = {}  # by left part: longest chain that starts there
    most = 1
    for left, right, merged in vocabulary.rules.tolist():
        longest, part = size[right], right
        while part is not None:
            longest = max(longest, reach.get(part, 0))
            part = first.get(part)
        chain = size[left] + longest
        reach[left] = max(reach.get(left, 0), chain)
        first.setdefault(merged, left)
        most = max(most, chain)
    return most


# -- merging -------------------------------------------------------------------
class Merger:
    """Turns pieces (bytes) into token ids by the merge list."""

    def __init__(self, vocabulary: Vocabulary):
        self.lookahead = vocabulary.lookahead
        self.size = np.array([len(t) for t in vocabulary.tokens])
        single = {t: i for i, t in enumerate(vocabulary.tokens) if len(t) == 1}
        self.of_byte = np.array(
            [single.get(bytes([b]), -1) for b in range(256)], dtype=np.int64
        )
        rules = vocabulary.rules
        keys = (rules[:, 0] << 32) | rules[:, 1]
        self.merged = rules[:, 2]
        self.none = len(rules)
        self._fill(keys)
        self.rank_of = dict(zip(keys.tolist(), range(len(rules))))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.slot_bits)).astype(np.int64)

    def _fill(self, keys: np.ndarray) -> None:
        """Hash table of pairs with linear probing, an eighth full at most."""
        self.slot_bits = max(4, int(len(keys) * 8).bit_length())
        size = 1 << self.slot_bits
        self.keys = np.full(size, -1, dtype=np.int64)
        self.ranks = np.full(size, self.none, dtype=np.int64)
        slots = self._slot(keys)
        rank = np.arange(len(keys))
        while len(rank):
            free = self.keys[slots] == -1
            self.keys[slots[free]] = keys[rank[free]]
            placed = self.keys[slots] == keys[rank]
            self.ranks[slots[placed]] = rank[placed]
            slots, rank = (slots[~placed] + 1) % size, rank[~placed]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = (left << 32) | right
        slots = self._slot(wanted)
        found = self.keys[slots]
        rank = np.where(found == wanted, self.ranks[slots], self.none)
        open_ = np.flatnonzero((found != wanted) & (found != -1))
        while len(open_):
            slots[open_] = (slots[open_] + 1) % len(self.keys)
            found = self.keys[slots[open_]]
            hit = found == wanted[open_]
            rank[open_[hit]] = self.ranks[slots[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return rank

    def side_by_side(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of short pieces. In each round every piece applies its first
        merge at all places at once; merges that this makes possible come later
        in the list, so the order of the list is kept."""
        sizes = np.array([len(p) for p in pieces])
        symbols = self.of_byte[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        piece = np.repeat(np.arange(len(pieces)), sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            rank = np.full(len(symbols), self.none, dtype=np.int64)
            inner = np.flatnonzero(piece[1:] == piece[:-1])
            rank[inner] = self._rank(symbols[inner], symbols[inner + 1])
            starts = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
            lengths = np.diff(np.r_[starts, len(piece)])
            first = np.repeat(np.minimum.reduceat(rank, starts), lengths)
            ended = first == self.none
            if ended.any():
                done.append((piece[ended], symbols[ended]))
                going = ~ended
                piece, symbols = piece[going], symbols[going]
                rank, first = rank[going], first[going]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == first)
            # x x x: the leftmost pair first, so every other place of a run.
            run = np.r_[True, at[1:] != at[:-1] + 1]
            begin = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - begin) % 2 == 0]
            symbols[at] = self.merged[rank[at]]
            kept = np.ones(len(symbols), dtype=bool)
            kept[at + 1] = False
            piece, symbols = piece[kept], symbols[kept]
        if not done:
            return [[] for _ in pieces]
        pieces_done = np.concatenate([d[0] for d in done])
        ids = np.concatenate([d[1] for d in done])
        order = np.argsort(pieces_done, kind="stable")
        counts = np.bincount(pieces_done, minlength=len(pieces))
        flat = ids[order].tolist()
        ends = np.cumsum(counts).tolist()
        return [flat[e - c : e] for e, c in zip(ends, counts.tolist())]

    def window(self, text: bytes) -> list[int]:
        """Ids of one long stretch: a queue of merges by rank and place."""
        symbols = self.of_byte[np.frombuffer(text, dtype=np.uint8)].tolist()
        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        queue: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(symbols):
                rank = self.rank_of.get((symbols[i] << 32) | symbols[j])
                if rank is not None:
                    heapq.heappush(queue, (rank, i, symbols[i], symbols[j]))

        for i in range(len(symbols) - 1):
            offer(i)
        while queue:
            rank, i, left, right = heapq.heappop(queue)
            j = after[i]
            if symbols[i] != left or j >= len(symbols) or symbols[j] != right:
                continue
            symbols[i], symbols[j] = int(self.merged[rank]), -1
            after[i] = after[j]
            if after[i] < len(symbols):
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [s for s in symbols if s >= 0]


class LongPiece:
    """One piece of any length, merged in windows."""

    def __init__(self, merger: Merger):
        self.merger = merger
        self.held = b""

    def feed(self, text: bytes, last: bool = False) -> list[int]:
        """Ids that later bytes cannot change."""
        self.held += text
        ids: list[int] = []
        block = WINDOW + self.merger.lookahead
        while len(self.held) > block or (last and self.held):
            window = self.held[:block]
            found = self.merger.window(window)
            if last and len(self.held) <= block:
                stable = len(found)
            else:
                ends = np.cumsum(self.merger.size[found])
                limit = len(window) - self.merger.lookahead
                stable = int(np.searchsorted(ends, limit, side="right"))
            ids += found[:stable]
            self.held = self.held[int(self.merger.size[found[:stable]].sum()) :]
        return ids


# -- spans ---------------------------------------------------------------------
class SpanStream:
    """Cuts a fed text into spans (str) and, inside endless pieces and for
    special tokens, into ids (int)."""

    def __init__(self, merger: Merger, specials: dict[str, int]):
        self.merger = merger
        self.specials = specials
        self.special = (
            regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True))))
            if specials else None
        )
        self.held = ""
        self.long: LongPiece | None = None
        self.run = None

    def feed(self, text: str, last: bool = False) -> list[str | int]:
        text, self.held = self.held + text, ""
        if not self.special or not any(s[0] in text for s in self.specials):
            return self._plain(text, last)
        out: list[str | int] = []
        at = 0
        for found in self.special.finditer(text):
            out += self._plain(text[at : found.start()], True)
            out.append(self.specials[found[0]])
            at = found.end()
        rest = text[at:]
        # The start of a special token may stand at the end.
        cut = 0 if last else max(
            (k for s in self.specials for k in range(1, len(s)) if rest.endswith(s[:k])),
            default=0,
        )
        out += self._plain(rest[: len(rest) - cut], last)
        self.held += rest[len(rest) - cut :]
        return out

    def _plain(self, text: str, last: bool) -> list[str | int]:
        if self.long is not None:
            return self._go_on(text, last)
        spans: list[str | int] = _span.findall(text)
        if last or not spans:
            if spans and len(spans[-1]) > LONGEST_SPAN:
                return spans[:-1] + self._open(spans[-1], last)
            return spans
        end = spans.pop()
        if len(end) > LONGEST_SPAN:
            return spans + self._open(end, last)
        self.held = end
        return spans

    def _open(self, text: str, last: bool) -> list[str | int]:
        """Pieces of a long run; its last piece may still grow."""
        out: list[str | int] = []
        limit = len(text) if last else len(text) - _CONTRACTION
        at = 0
        for found in _piece.finditer(text):
            if found.end() <= limit and found.end() - found.start() <= LONGEST_SPAN:
                out.append(found[0])
                at = found.end()
                continue
            if found.end() - found.start() <= LONGEST_SPAN:
                break
            # A piece longer than the buffer: its head decides its kind.
            piece = found[0]
            head = 1 if piece[0] == " " and not piece.isspace() else 0
            self.run = next(r for r in _runs if r.match(piece, head))
            self.long = LongPiece(self.merger)
            if found.end() <= limit:
                out += self.long.feed(piece.encode(), True)
                self.long, at = None, found.end()
                continue
            keep = max(found.start() + 2, limit)
            out += self.long.feed(text[found.start() : keep].encode())
            return out + self._go_on(text[keep:], last)
        self.held = text[at:] if not last else ""
        return out

    def _go_on(self, text: str, last: bool) -> list[str | int]:
        """More of an endless piece."""
        found = self.run.match(text)
        end = found.end() if found else 0
        if end == len(text) and not last:
            keep = max(0, end - _CONTRACTION)
            ids = self.long.feed(text[:keep].encode())
            self.held = text[keep:]
            return ids
        if self.run is _runs[-1] and end < len(text) and end:
            end -= 1  # the last white space belongs to what follows
        ids = self.long.feed(text[:end].encode(), True)
        self.long = None
        return ids + self._plain(text[end:], last)


def _pieces_of(span: str) -> list[str]:
    """Pieces of a span; the two commonest shapes without the pattern."""
    if span[0] == " ":
        if span[1:].isalpha():
            return [span]
        if span[-1] in ",." and span[1:-1].isalpha():
            return [span[:-1], span[-1]]
    return _piece.findall(span)


class Codebook:
    """Ids of spans as text '1,2,3', remembered up to a bound."""

    def __init__(self, vocabulary: Vocabulary, remembered: int = REMEMBERED):
        self.vocabulary = vocabulary
        self.merger = Merger(vocabulary)
        self.remembered = remembered
        self.spans: dict[str | int, str] = {}
        self.pieces: dict[str, str] = {}
        self.texts = [str(i) for i in range(len(vocabulary.tokens))]

    def learn(self, spans: Iterable[str | int]) -> None:
        """Makes sure that each span is in the table."""
        new = set(spans).difference(self.spans)
        if not new:
            return
        if len(self.spans) + len(new) > self.remembered:
            self.spans.clear()
            new = set(spans)
        if len(self.pieces) > self.remembered:
            self.pieces.clear()
        cut: dict[str, list[str]] = {}
        for span in new:
            if isinstance(span, int):
                self.spans[span] = str(span)
            else:
                cut[span] = _pieces_of(span)
        wanted = {p for pieces in cut.values() for p in pieces}
        wanted.difference_update(self.pieces)
        short = [p for p in wanted if len(p) * 4 <= SHORT_PIECE]
        rest = [p for p in wanted if len(p) * 4 > SHORT_PIECE]
        short += [p for p in rest if len(p.encode()) <= SHORT_PIECE]
        for at in range(0, len(short), 20_000):
            part = short[at : at + 20_000]
            found = self.merger.side_by_side([p.encode() for p in part])
            for p, ids in zip(part, found):
                self.pieces[p] = ",".join([self.texts[i] for i in ids])
        for p in rest:
            if p not in self.pieces:
                ids = LongPiece(self.merger).feed(p.encode(), True)
                self.pieces[p] = ",".join([self.texts[i] for i in ids])
        get = self.pieces.__getitem__
        for span, pieces in cut.items():
            self.spans[span] = (
                get(span) if len(pieces) == 1 else ",".join(map(get, pieces))
            )

    def ids(self, spans: list[str | int]) -> str:
        return ",".join(map(self.spans.__getitem__, spans))

    def encode_stream(self, chunks: Iterable[str]) -> Iterator[list[int]]:
        """Ids of a text that arrives in chunks, as soon as they are stable."""
        stream = SpanStream(self.merger, self.vocabulary.specials)
        for chunk in (*chunks, None):
            spans = stream.feed(chunk or "", chunk is None)
            if spans:
                self.learn(spans)
                yield list(map(int, self.ids(spans).split(",")))


# -- decoding ------------------------------------------------------------------
class ByteToText:
    """Bytes in, text out; an unfinished character waits for its rest."""

    def __init__(self):
        self.held = b""

    def feed(self, data: bytes, last: bool = False) -> str:
        data = self.held + data
        cut = len(data) if last else len(data) - self._unfinished(data)
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    @staticmethod
    def _unfinished(data: bytes) -> int:
        """Trailing bytes that may be the start of a longer character."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte >> 6 == 0b10:
                continue
            wanted = 2 if byte >> 5 == 0b110 else 3 if byte >> 4 == 0b1110 else (
                4 if byte >> 3 == 0b11110 else 1
            )
            return back if wanted > back else 0
        return 0


def decode_stream(
    ids: Iterable[str], table: dict[str, bytes], at_once: int = 8192
) -> Iterator[str]:
    """Text of ids given as decimal text; ids outside the table are skipped."""
    machine = ByteToText()
    ids = list(ids)
    for at in range(0, len(ids), at_once):
        part = ids[at : at + at_once]
        yield machine.feed(b"".join([table.get(i, b"") for i in part]))
    yield machine.feed(b"", True)


# -- Spark ---------------------------------------------------------------------
_books: dict[str, tuple[Codebook, dict[str, bytes]]] = {}


def _book(vocabulary: Vocabulary) -> tuple[Codebook, dict[str, bytes]]:
    """Tables of this worker, kept between tasks."""
    if vocabulary.digest not in _books:
        table = {str(i): t for i, t in enumerate(vocabulary.tokens)}
        _books[vocabulary.digest] = Codebook(vocabulary), table
    return _books[vocabulary.digest]


def _encode_slice(book: Codebook, texts: list[str | None]) -> list[str]:
    """Ids of each text as '1,2,3'. Spans of all texts are learnt together."""
    streams = []
    for text in texts:
        stream = SpanStream(book.merger, book.vocabulary.specials)
        spans: list[str | int] = []
        text = text or ""
        for at in range(0, len(text), CHUNK):
            spans += stream.feed(text[at : at + CHUNK], at + CHUNK >= len(text))
        streams.append(spans)
    try:
        book.learn([s for spans in streams for s in spans])
        return [book.ids(spans) for spans in streams]
    except KeyError:  # more new spans than are remembered: one text at a time
        found = []
        for spans in streams:
            book.spans.clear()
            book.learn(spans)
            found.append(book.ids(spans))
        return found


def encode(
    docs: DataFrame,
    path: str,
    text: str = "text",
    with_ids: bool = False,
    kept: list[str] | None = None,
    remembered: int = REMEMBERED,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """``kept`` columns (default: all but the text, and but those named like the
    result's), n_tokens, ids_sha256, decoded_sha256 and, if asked for, the ids themselves.
    ``remembered`` spans and the texts of ``slice_bytes`` are what a worker holds.

    ``path`` names a byte-level BPE vocabulary on the driver, which sends its
    content (a fixed size) to the executors.
    """
    spark: SparkSession = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(Vocabulary.read(path))
    kept = [c for c in (kept if kept is not None else docs.columns) if c != text]
    body = fresh_name(docs, "_text")
    given = docs.select(*kept, F.col(text).alias(body))
    added = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        added += ", ids array<int>"
    empty = spark.createDataFrame([], added)
    new = [c for c in empty.columns]
    clash = {c.lower() for c in new} & {c.lower() for c in kept}
    if clash:  # the operator's columns win
        kept = [c for c in kept if c.lower() not in clash]
        given = given.select(*kept, body)
    schema = given.select(*kept).schema
    for column in empty.schema:
        schema = schema.add(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, table = _book(vocabulary.value)
        book.remembered = remembered
        for batch in slices(batches, body, slice_bytes):
            texts = batch.column(body).to_pylist()
            counts, digests, decoded, ids = [], [], [], []
            for found in _encode_slice(book, texts):
                numbers = found.split(",") if found else []
                counts.append(len(numbers))
                digests.append(hashlib.sha256(found.encode()).hexdigest())
                plain = hashlib.sha256()
                for part in decode_stream(numbers, table):
                    plain.update(part.encode())
                decoded.append(plain.hexdigest())
                if with_ids:
                    ids.append(np.array(numbers, dtype=np.int32))
            columns = [batch.column(c) for c in kept]
            columns += [
                pa.array(counts, pa.int64()), pa.array(digests, pa.string()),
                pa.array(decoded, pa.string()),
            ]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *new])

    return given.mapInArrow(run, schema)


def decode(docs: DataFrame, path: str, ids: str = "ids", name: str = "text") -> DataFrame:
    """All columns but one of the same name, and the text of an array of ids (null ids:
    null text)."""
    if name.lower() != ids.lower():
        docs = without(docs, name)
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.read(path))
    schema = docs.select("*", F.lit("").alias(name)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, table = _book(vocabulary.value)
        for batch in batches:
            texts = [
                None if row is None else "".join(decode_stream(map(str, row), table))
                for row in batch.column(ids).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())],
                names=[*batch.schema.names, name],
            )

    return docs.mapInArrow(run, schema)
