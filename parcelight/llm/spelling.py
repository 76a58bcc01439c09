"""Spelling variants by blocked Gram matrices.

Words are counted over all texts. Two words are near if one inserted, deleted or
replaced letter makes them equal. A word's vector counts its letters; the squared
distance of two vectors follows from their inner product, and near words are at most two
apart, in the same or in neighbouring lengths. So the words are dealt into blocks by
length, each block's inner products are one matrix product, and the pairs at most two
apart have their letters compared.

A block of all words of a length would make the products quadratic in the vocabulary.
The edit lies in one half of the shorter word, and what is outside that half is equal in
both words: words meet in one block per half, of the same length or one letter more, with
equal letters outside. A block of more than :data:`BLOCK` words has its half halved
again, until it is small enough or the region is one letter wide; such a block
holds at most a few thousand words, since two letters are free. A pair counts in the
one region that holds its first difference.

Each text's words are counted inside ``mapInArrow``, combined per
task and added up by Spark. Blocks are dealt by their key, so a task holds a run of small
blocks or one block; partial results per word (how many near words, the commonest) are
combined before the shuffle. Forms are followed by pointer doubling over the words
that have one: a form is at least twice as common as its word, so a chain has at
most as many steps as the largest count has bits.

Defined cases: a null or empty text has no words, a null id counts as an empty one.
Repeated rows count each time. Words may have any length. Ties go to the form that is
first in code-point order. Without words the result has no rows. Other columns of the
input are neither read nor returned.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelight.llm.common import forget, store

RUN = re.compile("[A-Za-zÀ-ÿ]+")
SHORTEST, RAREST = 5, 3
# Every crc32 that this divides loses a letter.
DAMAGE = 97

# Words of a block before it is cut finer; rows of a matrix product; counts that a task
# holds before it passes them on.
BLOCK = 4096
TILE = 1024
PACK = 256
HELD = 300_000

# Latin letters as columns of the count matrix: a-z, then U+00C0 to U+00FF.
_COLUMN = np.full(256, -1, np.int16)
_COLUMN[97:123] = np.arange(26)
_COLUMN[192:256] = np.arange(26, 90)
_LETTERS = 90


def damaged(word: bytes, seed: int) -> str:
    """The word, without one letter if its checksum (``seed``: that of what stands
    before it) says so."""
    text = word.decode()
    check = zlib.crc32(word, seed)
    if check % DAMAGE:
        return text
    at = check % len(text)
    return text[:at] + text[at + 1 :]


def count_words(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(word, n): words of at least :data:`SHORTEST` letters seen at least
    :data:`RAREST` times."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for row in range(batch.num_rows):
                text = batch.column(1)[row].as_py()
                if not text:
                    continue
                lowered: Counter[bytes] = Counter()
                for run, n in Counter(RUN.findall(text)).items():
                    if len(run) >= SHORTEST:
                        lowered[run.encode().lower()] += n
                seed = zlib.crc32(f"{batch.column(0)[row].as_py() or ''}:".encode())
                for word, n in lowered.items():
                    held[damaged(word, seed)] += n
                if len(held) > HELD:
                    yield counts(held)
                    held.clear()
        yield counts(held)

    def counts(held: Counter[str]) -> pa.RecordBatch:
        words = [w for w in held if len(w) >= SHORTEST]
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array([held[w] for w in words], pa.int64())],
            names=["word", "n"],
        )

    read = docs.select(F.col(id_column).cast("string"), F.col(text_column))
    return (
        read.mapInArrow(count, "word string, n bigint")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= RAREST)
    )


def _outside(low: Column, high: Column) -> Column:
    """The letters of ``word`` outside a region. ``size`` is the length of the block's
    shorter words, of which the letters from ``low`` up to ``high`` are free; a longer
    word has one more letter there."""
    word = F.col("word")
    cut = high + F.length(word) - F.col("size")
    return F.concat(
        F.substring(word, F.lit(1), low), F.lit("\u0000"), F.substring(word, cut + 1, F.length(word))
    )


_BLOCK = ["size", "low", "high", "rest"]


def _halves(rows: DataFrame) -> DataFrame:
    """Rows with the two halves of their region, and the letters outside each."""
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    return (
        rows.withColumn("_middle", middle)
        .withColumn(
            "_half",
            F.explode(
                F.array(
                    F.struct(F.col("low").alias("low"), F.col("_middle").alias("high")),
                    F.struct(F.col("_middle").alias("low"), F.col("high").alias("high")),
                )
            ),
        )
        .select("word", "n", "size", "_half.*")
        .withColumn("rest", _outside(F.col("low"), F.col("high")))
    )


def blocks(words: DataFrame) -> DataFrame:
    """(word, n) dealt into blocks: each pair of near words is in the block of the one
    region that holds its first difference. Blocks beyond :data:`BLOCK` words have
    regions of one letter."""
    length = F.length("word")
    regions = words.withColumn("size", F.explode(F.array(length, length - 1))).select(
        "word", "n", "size", F.lit(0).alias("low"), F.col("size").alias("high")
    )
    done, rows = [], _halves(regions)
    while True:
        large, path = store(
            rows.where("high - low > 1").groupBy(*_BLOCK).agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > BLOCK).drop("_n"),
            "large-blocks",
        )
        if large.isEmpty():
            forget(words.sparkSession, path)
            break
        done.append(rows.join(large, _BLOCK, "left_anti"))
        rows = _halves(rows.join(large, _BLOCK, "left_semi"))
    done.append(rows)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def _counts_of(words: list[str]) -> np.ndarray:
    letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    rows = np.repeat(np.arange(len(words)), [len(w) for w in words])
    flat = rows * _LETTERS + _COLUMN[letters]
    return np.bincount(flat, minlength=len(words) * _LETTERS).reshape(-1, _LETTERS).astype(np.float32)


def first_difference(short: str, long: str) -> int:
    """The place of the one edit between two words whose lengths differ by at most one,
    or -1 if more than one is needed, or none."""
    at, end = 0, len(short)
    while at < end and short[at] == long[at]:
        at += 1
    if len(long) > end:
        return at if short[at:] == long[at + 1 :] else -1
    return at if at < end and short[at + 1 :] == long[at + 1 :] else -1


def near_pairs(
    words: list[str], block: np.ndarray, low: list[int], high: list[int], size: list[int]
) -> Iterator[tuple[int, int]]:
    """Pairs of places of near words of the same block, each in its own region only."""
    vectors = _counts_of(words)
    norms = np.einsum("ij,ij->i", vectors, vectors)
    for a in range(0, len(words), TILE):
        for b in range(a, len(words), TILE):
            gram = vectors[a : a + TILE] @ vectors[b : b + TILE].T
            apart = norms[a : a + TILE, None] + norms[None, b : b + TILE] - 2 * gram
            close = (apart <= 2) & (block[a : a + TILE, None] == block[None, b : b + TILE])
            if a == b:
                close = np.triu(close, 1)
            for i, j in zip(*(found.tolist() for found in np.nonzero(close))):
                i, j = a + i, b + j
                short, long = (i, j) if len(words[i]) <= len(words[j]) else (j, i)
                if len(words[short]) != size[i]:
                    continue  # both are a letter longer than the block's shorter words
                at = first_difference(words[short], words[long])
                last = high[i] == size[i]  # a letter may be put in behind the last
                if at >= low[i] and (at < high[i] or last):
                    yield i, j


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per word and pack of blocks: the number of near words and the commonest of them.
    Rows come sorted by block."""

    def judged(rows: list[tuple], ids: list[int]) -> pa.RecordBatch | None:
        words = [r[0] for r in rows]
        found: dict[int, list] = {}
        pairs = near_pairs(
            words, np.array(ids), [r[3] for r in rows], [r[4] for r in rows], [r[2] for r in rows]
        )
        for i, j in pairs:
            for one, other in ((i, j), (j, i)):
                best = (-rows[other][1], words[other])
                seen = found.get(one)
                if seen is None:
                    found[one] = [1, best]
                else:
                    seen[0] += 1
                    seen[1] = min(seen[1], best)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([words[i] for i in found], pa.string()),
                pa.array([v[0] for v in found.values()], pa.int64()),
                pa.array([-v[1][0] for v in found.values()], pa.int64()),
                pa.array([v[1][1] for v in found.values()], pa.string()),
            ],
            names=["word", "n_near", "form_n", "form"],
        )

    pack: list[tuple] = []
    ids: list[int] = []
    block: list[tuple] = []
    blocks_seen = 0

    def close() -> Iterator[pa.RecordBatch]:
        """Ends a block: it goes to the pack, which is judged before it gets large."""
        nonlocal blocks_seen
        if len(block) > 1:
            if len(pack) + len(block) > PACK and pack:
                yield judged(pack, ids)
                pack.clear()
                ids.clear()
            pack.extend(block)
            ids.extend([blocks_seen] * len(block))
            blocks_seen += 1
        block.clear()

    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            if block and block[0][2:] != row[2:]:
                yield from close()
            block.append(row)
    yield from close()
    if pack:
        yield judged(pack, ids)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, form_n, form): of each word that has near words, their number and
    the commonest of them with its count."""
    partial = (
        blocks(words)
        .repartition(*_BLOCK)
        .sortWithinPartitions(*_BLOCK)
        .select("word", "n", *_BLOCK)
        .mapInArrow(_near, "word string, n_near bigint, form_n bigint, form string")
    )
    best = F.min(F.struct((-F.col("form_n")).alias("_n"), F.col("form")))
    return partial.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_best")).select(
        "word", "n_near", (-F.col("_best._n")).alias("form_n"), "_best.form"
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form) by pointer doubling."""
    reached, path = store(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step = reached.join(further, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")
        )
        stored, new_path = store(step, "roots")
        forget(forms.sparkSession, path)
        reached, path = stored.drop("_moved"), new_path
        if stored.where("_moved").isEmpty():
            return reached


def variants(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word."""
    words, _ = store(count_words(docs, id_column, text_column), "words")
    near, _ = store(near_words(words), "near-words")
    common = F.col("form_n") >= 2 * F.col("n")
    told, _ = store(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(common, F.col("form")).alias("form"),
            F.when(common, F.col("form_n")).alias("form_n"),
        ),
        "variants",
    )
    roots = _roots(told.where("form IS NOT NULL"))
    return told.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
