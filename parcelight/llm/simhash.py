"""SimHash near-duplicates by bit-sliced comparison.

1. One fingerprint per document, from all its 3-word shingles.
2. Equal fingerprints are one node. Two fingerprints at most ``radius`` = 3 bits
   apart agree on at least two of five bit blocks (3 bits spoil three at most), so
   each node enters ten buckets, one per pair of blocks, and no link is lost.
3. Within a bucket the fingerprints are stored as bit planes: word w of plane b
   holds bit b of 64 members. XOR with a member's bit gives 64 differences at
   once; carry-save counters add the planes up, and a block of lanes is left as
   soon as each of its lanes is beyond the radius.
4. A bucket of many members is cut into sub-blocks, and each pair of sub-blocks is
   a tile of its own, so no task holds more than two sub-blocks. A tile returns a
   spanning forest (at most one link per member), never its pairs.
5. Links become components by alternating star contraction.

Defined cases: a null text has no words, fingerprint zero; a null id is carried
and never names a component while one of its members has an id; repeated rows
stay; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelight.llm.common import forget, fresh_name, slices, store, words_of

RADIUS = 3
SHINGLE = 3
SEED = 42
BLOCKS = 5
# Members per sub-block of a bucket, and group size up to which lanes are
# compared by shifting the planes instead of member by member.
SUB_BLOCK = 4096
SMALL = 64
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


# -- fingerprints ------------------------------------------------------------
def fingerprint(text: str | None) -> int:
    """64-bit SimHash, unsigned."""
    words = words_of(text)
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE))))
    hashes = np.fromiter(
        map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype="<u8"
    )
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 8192):
        part = hashes[at : at + 8192].view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(part, axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint16)
    over = (counts * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(over, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str, name: str) -> DataFrame:
    """All columns of ``docs`` and the fingerprint as a signed long."""
    schema = docs.select("*", F.lit(0).cast("long").alias(name)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            found = [fingerprint(t) for t in batch.column(text).to_pylist()]
            values = pa.array(np.array(found, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, values], names=[*batch.schema.names, name]
            )

    return docs.mapInArrow(run, schema)


# -- bit-sliced comparison -----------------------------------------------------
def planes_of(codes: np.ndarray) -> np.ndarray:
    """(64, words): bit b of member i is bit i % 64 of word i // 64 of plane b."""
    words = -(-len(codes) // 64)
    bits = np.zeros((words * 64, 64), dtype=np.uint8)
    bits[: len(codes)] = np.unpackbits(
        codes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
    )
    packed = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
    return packed.view("<u8").astype(np.uint64)


class LaneCounter:
    """Counts differences of all lanes at once, up to a radius below 2**bits.

    ``over`` marks lanes known to be beyond the radius; it starts with the lanes
    that are not asked for.
    """

    def __init__(self, over: np.ndarray, radius: int):
        self.over = over
        self.radius = radius
        self.sums = [np.zeros_like(over) for _ in range(max(1, radius.bit_length()))]

    def add(self, first: np.ndarray, second: np.ndarray) -> None:
        """Carry-save: two planes and the ones go through a full adder, whose
        carry ripples up; a carry out of the top leaves the radius."""
        ones = self.sums[0]
        half = ones ^ first
        carry = (ones & first) | (half & second)
        self.sums[0] = half ^ second
        for k in range(1, len(self.sums)):
            self.sums[k], carry = self.sums[k] ^ carry, self.sums[k] & carry
        self.over = self.over | carry

    def select(self, kept: np.ndarray) -> None:
        self.over = self.over[kept]
        self.sums = [s[kept] for s in self.sums]

    def within(self) -> np.ndarray:
        """Lanes at most ``radius`` apart."""
        beyond, equal = self.over.copy(), np.full_like(self.over, _ALL)
        for k in reversed(range(len(self.sums))):
            if not self.radius >> k & 1:
                beyond |= equal & self.sums[k]
                equal &= ~self.sums[k]
            else:
                equal &= self.sums[k]
        return ~beyond


def near_lanes(
    difference, over: np.ndarray, radius: int = RADIUS, step: int = 8
) -> np.ndarray:
    """Lanes within the radius. ``difference(plane, blocks)`` gives the
    difference plane of the blocks (rows of ``over``) still alive; a block is
    abandoned when all its lanes are over."""
    result = np.zeros_like(over)
    alive = np.flatnonzero((over != _ALL).any(axis=1))
    counter = LaneCounter(over[alive], radius)
    for plane in range(0, 64, 2):
        if not len(alive):
            return result
        counter.add(difference(plane, alive), difference(plane + 1, alive))
        if plane % step == step - 2:
            kept = (counter.over != _ALL).any(axis=1)
            if kept.sum() < 0.75 * len(alive):
                alive = alive[kept]
                counter.select(kept)
    result[alive] = counter.within()
    return result


def _bits(lanes: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(
        lanes.astype("<u8").view(np.uint8), axis=-1, bitorder="little"
    )[..., :n]


def large_group_roots(codes: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Index of the smallest code of each member's component in one group."""
    n = len(codes)
    planes = planes_of(codes)
    words = planes.shape[1]
    adjacent = np.zeros((n, words), dtype=np.uint64)
    padding = np.full(words * 64, 0, dtype=np.uint8)
    padding[n:] = 1
    unused = np.packbits(padding, bitorder="little").view("<u8").astype(np.uint64)
    for at in range(0, n, 256):
        mine = codes[at : at + 256]

        def difference(plane: int, rows: np.ndarray) -> np.ndarray:
            own = (mine[rows] >> np.uint64(plane)) & np.uint64(1)
            return planes[plane][None, :] ^ (np.uint64(0) - own)[:, None]

        over = np.repeat(unused[None, :], len(mine), axis=0)
        adjacent[at : at + 256] = near_lanes(difference, over, radius)
    roots = np.full(n, -1, dtype=np.int64)
    for seed in np.argsort(codes, kind="stable"):
        if roots[seed] >= 0:
            continue
        roots[seed] = seed
        frontier = np.array([seed])
        while len(frontier):
            reached = np.bitwise_or.reduce(adjacent[frontier], axis=0)
            frontier = np.flatnonzero(_bits(reached, n) & (roots < 0))
            roots[frontier] = seed
    return roots


def _shifted(planes: np.ndarray, by: int) -> np.ndarray:
    """Lane i of the result is lane i + by (by < 64)."""
    following = np.zeros_like(planes)
    following[:, :-1] = planes[:, 1:]
    return (planes >> np.uint64(by)) | (following << np.uint64(64 - by))


def small_group_roots(
    codes: np.ndarray, group: np.ndarray, radius: int = RADIUS
) -> np.ndarray:
    """As :func:`large_group_roots` for many neighbouring groups of up to
    :data:`SMALL` members: lane i compares member i with member i + shift."""
    n = len(codes)
    roots = np.arange(n)
    planes = planes_of(codes)
    words = planes.shape[1]
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for shift in range(1, SMALL):
        other_group = np.ones(words * 64, dtype=np.uint8)
        if shift < n:
            other_group[: n - shift] = group[:-shift] != group[shift:]
        if other_group.all():
            break
        over = np.packbits(other_group, bitorder="little").view("<u8")
        over = over.astype(np.uint64)[:, None]
        moved = _shifted(planes, shift)

        def difference(plane: int, rows: np.ndarray) -> np.ndarray:
            return (planes[plane, rows] ^ moved[plane, rows])[:, None]

        near = near_lanes(difference, over, radius)[:, 0]
        left = np.flatnonzero(_bits(near, n))
        if len(left):
            pairs.append((left, left + shift))
    if not pairs:
        return roots
    a = np.concatenate([p[0] for p in pairs])
    b = np.concatenate([p[1] for p in pairs])
    while True:
        lower = np.minimum(roots[a], roots[b])
        if (roots[a] == lower).all() and (roots[b] == lower).all():
            return roots
        np.minimum.at(roots, a, lower)
        np.minimum.at(roots, b, lower)
        roots = roots[roots]


def _forest(group: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, smallest member) of complete, sorted groups."""
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(group)])
    roots = np.arange(len(codes))
    small = np.repeat(sizes <= SMALL, sizes)
    index = np.flatnonzero(small)
    if len(index):
        roots[index] = index[small_group_roots(codes[index], group[index])]
    for start, size in zip(starts, sizes):
        if size > SMALL:
            own = slice(start, start + size)
            roots[own] = start + large_group_roots(codes[own])
    linked = codes[roots] != codes
    return codes[linked], codes[roots][linked]


# -- links and components ------------------------------------------------------
def _block_masks() -> list[int]:
    """For each pair of the five blocks, the bits of both."""
    edges = [round(64 * k / BLOCKS) for k in range(BLOCKS + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    signed = [a | b for a, b in combinations(blocks, BLOCKS - RADIUS)]
    return [m - (1 << 64) if m >> 63 else m for m in signed]


def links(codes: DataFrame, sub_block: int = SUB_BLOCK) -> DataFrame:
    """(u, v), u != v: a spanning set of the links among distinct ``code``s."""
    tables = F.array(
        *[
            F.struct(F.lit(k).alias("t"), F.col("code").bitwiseAND(F.lit(m)).alias("key"))
            for k, m in enumerate(_block_masks())
        ]
    )
    entries = codes.select("code", F.inline(tables))
    sizes = entries.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n"))
    parts = F.ceil(F.col("n") / F.lit(sub_block)).cast("int")
    crowded = sizes.where("n > 1").select("t", "key", parts.alias("parts"))
    own = F.pmod(F.xxhash64("code"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    tiles = (
        entries.join(crowded, ["t", "key"])
        .withColumn("own", own)
        .withColumn("other", other)
        .select(
            F.xxhash64(
                "t", "key", F.least("own", "other"), F.greatest("own", "other")
            ).alias("tile"),
            "t", "key",
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
            "code",
        )
    )
    order = ["tile", "t", "key", "i", "j", "code"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(rows: pa.Table) -> pa.RecordBatch:
            parts = [rows.column(c).to_numpy() for c in order[:-1]]
            new = np.zeros(rows.num_rows, dtype=bool)
            new[0] = True
            for p in parts:
                new[1:] |= p[1:] != p[:-1]
            u, v = _forest(
                np.cumsum(new), rows.column("code").to_numpy().view(np.uint64)
            )
            return pa.RecordBatch.from_arrays(
                [pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"]
            )

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows = pa.Table.from_batches(held)
            same = np.ones(rows.num_rows, dtype=bool)
            for c in order[:-1]:
                values = rows.column(c).to_numpy()
                same &= values == values[-1]
            # The last tile may go on in the next batch.
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if cut:
                yield found(rows.slice(0, cut))
            held = rows.slice(cut).combine_chunks().to_batches()
        if held:
            yield found(pa.Table.from_batches(held))

    # A tile's rows meet by its hash alone: with (t, key, i, j) still to tell
    # tiles apart, a collision only makes two tiles neighbours.
    dealt = tiles.repartition("tile").sortWithinPartitions(*order)
    return dealt.mapInArrow(run, "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for nodes that have links.

    Large-star and small-star in turn, each an aggregate and a join, written to
    the shared folder between rounds, until a round changes nothing.
    """
    spark = edges.sparkSession
    edges = edges.select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).where("u != v")
    edges, path = store(edges.distinct(), "links")
    before = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), "m")
            .where("u != m").distinct()
        )
        downward = large.select("u", F.col("m").alias("v"))
        least = downward.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            downward.join(least, "u").where("v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges, new_path = store(small, "links")
        forget(spark, path)
        path = new_path
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state


def code_components(
    coded: DataFrame, id_column: str, code: str, sub_block: int = SUB_BLOCK
) -> DataFrame:
    """(code, root, first_id, first_code) of every distinct code: its component,
    and the component's smallest id with the smallest code that carries it."""
    nodes, _ = store(
        coded.groupBy(F.col(code).alias("code")).agg(
            F.min(id_column).alias("id")
        ),
        "codes",
    )
    found = components(links(nodes.select("code"), sub_block))
    rooted = nodes.join(found, F.col("code") == F.col("node"), "left").select(
        "code", "id", F.coalesce("root", "code").alias("root")
    )
    first = rooted.groupBy("root").agg(
        F.min(
            F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("code"))
        ).alias("first")
    )
    return rooted.join(first, "root").select(
        "code", "root", F.col("first.id").alias("first_id"),
        F.col("first.code").alias("first_code"),
    )


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, fingerprint, component_id) of every row."""
    coded, _ = store(
        with_fingerprint(docs.select(id_column, text), text, "_code").select(
            id_column, "_code"
        ),
        "fingerprints",
    )
    found = code_components(coded, id_column, "_code")
    return coded.join(found, F.col("_code") == F.col("code")).select(
        id_column,
        F.lower(F.lpad(F.hex("_code"), 16, "0")).alias("fingerprint"),
        F.col("first_id").alias("component_id"),
    )


def keep_first(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The row with the smallest id of each component; all columns stay. Of
    repeated rows one stays."""
    code = fresh_name(docs, "_code")
    narrow = docs.select(id_column, text)
    coded, _ = store(
        with_fingerprint(narrow, text, "_code").select(id_column, "_code"),
        "fingerprints",
    )
    first = (
        code_components(coded, id_column, "_code")
        .where("code = first_code")
        .select(F.col("first_id").alias("_first_id"), F.col("first_code").alias("_first"))
    )
    rows = with_fingerprint(docs, text, code)
    kept = rows.join(
        first,
        rows[code].eqNullSafe(F.col("_first"))
        & rows[id_column].eqNullSafe(F.col("_first_id")),
        "left_semi",
    )
    return kept.dropDuplicates([code, id_column]).select(*docs.columns)
