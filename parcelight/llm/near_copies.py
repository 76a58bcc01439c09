"""Near copies at a stated similarity: SimHash, wide enough to measure it.

Similarity is the share of common 5-word shingles (distinct ones, of all shingles of
both texts; a shorter text is one shingle). A 64-bit fingerprint with a radius of a few
bits finds only the slightest edits, so here

1. the fingerprint has 1,024 bits, over the distinct shingles. Texts of similarity s differ
   in a share acos(2s / (1 + s)) / pi of them on average; the radius is that
   plus 1.5 standard deviations, so 93 % of the pairs exactly at ``similarity`` are within
   it, nearly all above;
2. candidates are texts that agree on one of eight bands, a band being four minima of the
   shingles' hashes under fixed permutations: 98.5 % of the pairs at similarity 0.8;
3. texts of a band are compared by bit planes with carry-save counters, blocks of lanes
   being left as soon as all are beyond the radius (see :mod:`~parcelight.llm.simhash`);
   crowded bands are cut into pairs of sub-blocks, and a task returns a spanning forest,
   never its pairs;
4. links become components by star contraction.

The similarity is an estimate with a standard deviation of about 0.025: about 3 % of the pairs at
0.7, and one in a million at 0.6, count as near too.

Defined cases: a null text has no words; texts without words are copies of each other;
a null id never names a component while a member has an id; of repeated rows one stays;
an empty table gives an empty result; all columns, whatever their names, stay as they
are. Texts are read whole, in bounded pieces but for eight bytes a shingle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelight.llm.common import fresh_name, slices, store, words_of
from parcelight.llm.simhash import SMALL, LaneCounter, components

SHINGLE = 5
SIMILARITY = 0.8
WORDS = 16  # of 64 bits, in a fingerprint
BANDS = 8
MINIMA = 4  # in a band
SEED = 42
SUB_BLOCK = 4096
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _constants(name: bytes, n: int) -> np.ndarray:
    """n odd 64-bit numbers."""
    found = [xxhash.xxh64_intdigest(name, k) | 1 for k in range(n)]
    return np.array(found, dtype=np.uint64)


_MIX, _SPREAD = _constants(b"mix", WORDS), _constants(b"spread", WORDS)
_FLIP, _PERMUTE = (
    _constants(name, BANDS * MINIMA)[:, None] for name in (b"flip", b"permute")
)


def radius_for(similarity: float) -> int:
    """Differing bits up to which two fingerprints count as ``similarity`` or more."""
    bits = 64 * WORDS
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return math.floor(bits * share + 1.5 * math.sqrt(bits * share * (1 - share)))


# -- sketches ------------------------------------------------------------------
def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of the distinct shingles, ascending; none for a text without words."""
    words = words_of(text)
    if len(words) < shingle:
        parts = iter([b" ".join(words)] if words else [])
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), dtype="<u8"))


def sketch(text: str | None, shingle: int = SHINGLE) -> tuple[bytes, list[int]]:
    """Fingerprint (128 bytes) and bands (signed)."""
    hashes = shingle_hashes(text, shingle)
    counts = np.zeros(64 * WORDS, dtype=np.int64)
    minima = np.full(BANDS * MINIMA, _ALL)
    for at in range(0, len(hashes), 255):  # counts of a piece fit a byte
        part = hashes[at : at + 255]
        mixed = (part[:, None] ^ _MIX) * _SPREAD
        mixed ^= mixed >> np.uint64(31)
        mixed *= _SPREAD[::-1]
        bits = np.unpackbits(mixed.view(np.uint8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint8)
        turned = (part ^ _FLIP) * _PERMUTE
        minima = np.minimum(minima, (turned ^ (turned >> np.uint64(32))).min(axis=1))
    code = np.packbits(counts * 2 > len(hashes), bitorder="little").tobytes()
    bands = [
        xxhash.xxh64_intdigest(minima[k : k + MINIMA].tobytes(), SEED)
        for k in range(0, BANDS * MINIMA, MINIMA)
    ]
    return code, np.array(bands, dtype=np.uint64).view(np.int64).tolist()


def _row_key(id_column: str, text: str) -> Column:
    """The same for rows with the same id and text."""
    written = F.coalesce(F.concat(F.lit("="), F.col(id_column).cast("string")), F.lit("-"))
    return F.md5(F.concat(written, F.lit("\n"), F.coalesce(F.col(text), F.lit(""))))


def with_sketch(docs: DataFrame, id_column: str, text: str, shingle: int) -> DataFrame:
    """(id, key, node, code, bands): ``key`` stands for id and text, ``node`` for one code
    with its bands."""
    narrow = docs.select(
        F.col(id_column).alias("id"), _row_key(id_column, text).alias("key"),
        F.col(text).alias("text"),
    )
    id_type = narrow.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [sketch(t, shingle) for t in batch.column("text").to_pylist()]
            nodes = [xxhash.xxh3_128_digest(c + repr(b).encode()) for c, b in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("key"), pa.array(nodes, pa.binary()),
                    pa.array([c for c, _ in found], pa.binary()),
                    pa.array([b for _, b in found], pa.list_(pa.int64())),
                ],
                names=["id", "key", "node", "code", "bands"],
            )

    return narrow.mapInArrow(run, f"id {id_type}, key string, node binary, code binary, bands array<long>")


# -- bit-sliced comparison -------------------------------------------------------
def _planes(codes: np.ndarray) -> np.ndarray:
    """(bits, words): bit b of member i is bit i % 64 of word i // 64 of plane b."""
    words = -(-len(codes) // 64)
    bits = np.zeros((words * 64, codes.shape[1] * 8), dtype=np.uint8)
    bits[: len(codes)] = np.unpackbits(codes, axis=1, bitorder="little")
    packed = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
    return packed.view("<u8").astype(np.uint64)


def _lanes(marks: np.ndarray) -> np.ndarray:
    """64 marks a word; the rest of the last word is marked."""
    padded = np.ones(-(-len(marks) // 64) * 64, dtype=np.uint8)
    padded[: len(marks)] = marks
    return np.packbits(padded, bitorder="little").view("<u8").astype(np.uint64)


def _marks(lanes: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(lanes.astype("<u8").view(np.uint8), axis=-1, bitorder="little")[..., :n]


def near_lanes(difference, planes: int, over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes within the radius, of those not in ``over`` (blocks, words).
    ``difference(plane, blocks)`` gives a plane of the blocks still compared."""
    result = np.zeros_like(over)
    alive = np.flatnonzero((over != _ALL).any(axis=1))
    counter = LaneCounter(over[alive], radius)
    for plane in range(0, planes, 2):
        if not len(alive):
            return result
        counter.add(difference(plane, alive), difference(plane + 1, alive))
        if plane % 32 == 30:
            kept = (counter.over != _ALL).any(axis=1)
            if kept.sum() < 0.75 * len(alive):
                alive = alive[kept]
                counter.select(kept)
    result[alive] = counter.within()
    return result


def _large_roots(codes: np.ndarray, radius: int) -> np.ndarray:
    """First member of each member's component in one group."""
    n = len(codes)
    planes = _planes(codes)
    unused = _lanes(np.zeros(n, dtype=np.uint8))
    adjacent = np.zeros((n, len(unused)), dtype=np.uint64)
    for at in range(0, n, 256):
        size = min(256, n - at)

        def difference(plane: int, rows: np.ndarray) -> np.ndarray:
            member = at + rows
            own = planes[plane, member >> 6] >> (member & 63).astype(np.uint64) & np.uint64(1)
            return planes[plane][None, :] ^ (np.uint64(0) - own)[:, None]

        over = np.repeat(unused[None, :], size, axis=0)
        adjacent[at : at + size] = near_lanes(difference, len(planes), over, radius)
    roots = np.full(n, -1, dtype=np.int64)
    for seed in range(n):
        if roots[seed] >= 0:
            continue
        roots[seed] = seed
        frontier = np.array([seed])
        while len(frontier):
            reached = np.bitwise_or.reduce(adjacent[frontier], axis=0)
            frontier = np.flatnonzero(_marks(reached, n) & (roots < 0))
            roots[frontier] = seed
    return roots


def _small_roots(codes: np.ndarray, group: np.ndarray, radius: int) -> np.ndarray:
    """As :func:`_large_roots` for many neighbouring groups of up to ``SMALL``
    members: lane i compares member i with member i + shift."""
    n = len(codes)
    roots = np.arange(n)
    planes = _planes(codes)
    left, right = [], []
    for shift in range(1, min(SMALL, n)):
        other_group = np.ones(n, dtype=np.uint8)
        other_group[: n - shift] = group[:-shift] != group[shift:]
        if other_group.all():
            break

        def difference(plane: int, rows: np.ndarray) -> np.ndarray:
            own = planes[plane]
            following = np.append(own[1:], np.uint64(0))[rows]
            moved = own[rows] >> np.uint64(shift) | following << np.uint64(64 - shift)
            return (own[rows] ^ moved)[:, None]

        near = near_lanes(difference, len(planes), _lanes(other_group)[:, None], radius)
        found = np.flatnonzero(_marks(near[:, 0], n))
        left.append(found)
        right.append(found + shift)
    if not left:
        return roots
    a, b = np.concatenate(left), np.concatenate(right)
    while True:
        lower = np.minimum(roots[a], roots[b])
        if (roots[a] == lower).all() and (roots[b] == lower).all():
            return roots
        np.minimum.at(roots, a, lower)
        np.minimum.at(roots, b, lower)
        roots = roots[roots]


def group_roots(codes: np.ndarray, group: np.ndarray, radius: int) -> np.ndarray:
    """Index of the first member of each row's component within its group. ``codes`` is
    (n, bytes); the rows of a group are neighbours."""
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(group)])
    roots = np.arange(len(codes))
    index = np.flatnonzero(np.repeat(sizes <= SMALL, sizes))
    if len(index):
        roots[index] = index[_small_roots(codes[index], group[index], radius)]
    for start, size in zip(starts, sizes):
        if size > SMALL:
            roots[start : start + size] = start + _large_roots(codes[start : start + size], radius)
    return roots


# -- links and components --------------------------------------------------------
_ORDER = ["tile", "band", "key", "i", "j", "node"]


def links(nodes: DataFrame, radius: int, sub_block: int = SUB_BLOCK) -> DataFrame:
    """(u, v), u != v: links that span what is near within each band, of distinct
    (node, code, bands)."""
    entries = nodes.select("node", "code", F.posexplode("bands").alias("band", "key"))
    crowded = (
        entries.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        .select("band", "key", F.ceil(F.col("n") / F.lit(sub_block)).cast("int").alias("parts"))
    )
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    pairs = (
        entries.join(crowded, ["band", "key"])
        .select("*", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
        .select(
            "band", "key", "node", "code",
            F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        )
    )
    tiles = pairs.select(F.xxhash64("band", "key", "i", "j").alias("tile"), "*")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups(rows: pa.Table) -> np.ndarray:
            new = np.zeros(rows.num_rows, dtype=bool)
            for c in _ORDER[:-1]:
                values = rows.column(c).to_numpy()
                new[1:] |= values[1:] != values[:-1]
            return np.cumsum(new)

        def found(rows: pa.Table, group: np.ndarray) -> pa.RecordBatch:
            joined = b"".join(rows.column("code").to_pylist())
            codes = np.frombuffer(joined, dtype=np.uint8).reshape(rows.num_rows, -1)
            roots = group_roots(codes, group, radius)
            linked = np.flatnonzero(roots != np.arange(len(roots)))
            node = rows.column("node").combine_chunks()
            return pa.RecordBatch.from_arrays(
                [node.take(pa.array(linked)), node.take(pa.array(roots[linked]))], names=["u", "v"]
            )

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows = pa.Table.from_batches(held)
            group = groups(rows)
            # The last tile may go on in the next batch.
            cut = int(np.searchsorted(group, group[-1]))
            if cut:
                yield found(rows.slice(0, cut), group[:cut])
            held = rows.slice(cut).combine_chunks().to_batches()
        if held:
            rows = pa.Table.from_batches(held)
            yield found(rows, groups(rows))

    dealt = tiles.repartition("tile").sortWithinPartitions(*_ORDER)
    return dealt.mapInArrow(run, "u binary, v binary").distinct()


def with_components(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text",
    similarity: float = SIMILARITY, shingle: int = SHINGLE, sub_block: int = SUB_BLOCK,
) -> DataFrame:
    """(node, id, key, first_id, first_node) of every row: its component's smallest id, and
    the smallest node that has it."""
    sketched, _ = store(with_sketch(docs, id_column, text, shingle), "sketches")
    nodes, _ = store(
        sketched.groupBy("node").agg(
            F.min("id").alias("id"), F.any_value("code").alias("code"),
            F.any_value("bands").alias("bands"),
        ),
        "nodes",
    )
    found = components(links(nodes, radius_for(similarity), sub_block))
    rooted = nodes.select("node", "id").join(
        found.withColumnRenamed("node", "member"), F.col("node") == F.col("member"), "left"
    ).select("node", "id", F.coalesce("root", "node").alias("root"))
    first = rooted.groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node")).alias("first")
    )
    named = rooted.join(first, "root").select(
        "node", F.col("first.id").alias("first_id"), F.col("first.node").alias("first_node")
    )
    return sketched.select("id", "key", "node").join(named, "node")


def keep_first(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text",
    similarity: float = SIMILARITY, shingle: int = SHINGLE,
) -> DataFrame:
    """The row with the smallest id of each component; all columns stay. Rows that repeat
    this id are one; of their texts that with the smallest digest stays."""
    key = fresh_name(docs, "_key")
    rows = docs.withColumn(key, _row_key(id_column, text))
    kept = (
        with_components(docs, id_column, text, similarity, shingle)
        .where("node = first_node and id <=> first_id")
        .groupBy("node").agg(F.min("key").alias("_kept"))
    )
    found = rows.join(kept, F.col(key) == F.col("_kept"), "left_semi")
    return found.dropDuplicates([key]).drop(key)
