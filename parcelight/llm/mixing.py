"""Mixing sources to target weights by Pfair scheduling.

The documents of a source are cut into blocks of equal size. Sources have whole
numbers as weights; a *frame* holds as many blocks of each source as its weight
says, in D slots together. Block j of a source with m blocks in the frame is
released at slot floor(j D / m) and due before slot ceil((j + 1) D / m), and the
earliest deadline among the released blocks goes first. As the weights fill the
frame exactly, every block runs inside its window, so at no slot a source is a
whole block ahead of or behind its target.

At frame borders all sources stand exactly at their targets. So all frames with the
same sources follow one pattern, and a block's slot is the start of its frame plus
its place in the pattern: no run through the whole schedule is needed. When a
source runs out, the others share the slots by the same weights; with S sources
there are at most 2 S + 1 different patterns. They are the only thing scheduled
slot by slot, and their size depends on the weights, not on the rows.

Every document is placed once: nothing is dropped or repeated.

Defined cases: a null source is a source of its own; null ids come first; repeated
rows get places of their own; the last block of a source may be short; an empty
table gives an empty result; columns named like the operator's own are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelight.llm.common import store
from parcelight.operators import number_rows

BLOCK_ROWS = 32
RESOLUTION = 256  # slots of a frame, about
NO_SOURCE = "\u0000"
ADDED = ["block", "slot", "release", "deadline", "mix_order"]


def default_weights(sizes: DataFrame) -> DataFrame:
    """Between the sizes of the sources and equal shares: their square root."""
    every = Window.partitionBy(F.lit(1))  # one row per source
    root = F.sqrt(F.col("_rows").cast("double"))
    share = root / F.sum(root).over(every)
    return sizes.withColumn(
        "_weight", F.greatest(F.lit(1), F.round(share * RESOLUTION)).cast("long")
    )


def _patterns(sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kinds, places). A kind is a run of frames with the same blocks of each
    source: first frame, slots of a frame, slot of its first frame. A place is the
    slot within the frame of a source's n-th block there. ``sources`` has one row
    per source: _source, _blocks, _weight."""
    turns = sources.select(
        "_source", "_weight", "_blocks",
        F.floor(F.col("_blocks") / F.col("_weight")).alias("_full"),
        (F.col("_blocks") % F.col("_weight")).alias("_rest"),
    )
    border = F.explode(
        F.array(
            F.lit(0).cast("long"), F.col("_full"),
            F.col("_full") + F.when(F.col("_rest") > 0, F.lit(1)).otherwise(F.lit(0)),
        )
    )
    ordered = Window.partitionBy(F.lit(1)).orderBy("_from")  # 2 S + 1 rows
    runs = turns.select(border.alias("_from")).distinct().select(
        "_from", F.lead("_from").over(ordered).alias("_until")
    ).where(F.col("_until").isNotNull())
    # Sources of a run of frames, by their range of frames: S rows, listed once.
    listed = turns.agg(
        F.array_sort(F.collect_list(F.struct("_source", "_weight", "_full", "_rest"))).alias("_all")
    )

    def in_frame(s: Column) -> Column:
        return (
            F.when(F.col("_from") < s["_full"], s["_weight"])
            .when(F.col("_from") == s["_full"], s["_rest"]).otherwise(F.lit(0).cast("long"))
        )

    mixed = runs.withColumn("_all", listed.scalar()).select(
        "_from", "_until",
        F.filter(
            F.transform("_all", lambda s: F.struct(s["_source"].alias("s"), in_frame(s).alias("m"))),
            lambda x: x["m"] > 0,
        ).alias("_mix"),
    ).withColumn(
        "_slots", F.aggregate("_mix", F.lit(0).cast("long"), lambda a, x: a + x["m"])
    )
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    length = (F.col("_until") - F.col("_from")) * F.col("_slots")
    mixed = mixed.withColumn(
        "_start", F.coalesce(F.sum(length).over(before), F.lit(0).cast("long"))
    )

    def step(state: Column, t: Column) -> Column:
        def due(x: Column, i: Column) -> Column:
            done = F.get(state["done"], i)
            released = F.floor(done * F.col("_slots") / x["m"]) <= t
            deadline = F.ceil((done + 1) * F.col("_slots") / x["m"])
            return F.when(
                (done < x["m"]) & released, F.struct(deadline.alias("d"), i.alias("i"))
            )

        chosen = F.array_min(F.transform("_mix", due))["i"]
        return F.struct(
            F.transform(
                state["done"], lambda n, i: F.when(i == chosen, n + 1).otherwise(n)
            ).alias("done"),
            F.concat(state["order"], F.array(chosen)).alias("order"),
        )

    start = F.struct(
        F.transform("_mix", lambda x: F.lit(0).cast("long")).alias("done"),
        F.array().cast("array<int>").alias("order"),
    )
    slots = F.sequence(F.lit(0).cast("long"), F.col("_slots") - 1)
    planned = mixed.withColumn("_order", F.aggregate(slots, start, step, lambda s: s["order"]))
    placed = planned.select(
        "_from", "_slots", "_mix", F.posexplode("_order").alias("_pos", "_i")
    ).select("_from", "_slots", F.get("_mix", F.col("_i")).alias("_x"), "_pos")
    nth = Window.partitionBy("_from", "_x.s").orderBy("_pos")  # within a pattern
    places = placed.select(
        "_from", F.col("_x.s").alias("_source"), F.col("_x.m").alias("_m"),
        (F.row_number().over(nth) - 1).cast("long").alias("_nth"),
        F.col("_pos").cast("long").alias("_pos"),
    )
    kinds = mixed.select("_from", "_until", "_slots", "_start")
    return kinds, places


def mix(
    docs: DataFrame,
    weights: dict[str, int] | None = None,
    id_column: str = "doc_id",
    source: str = "source",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """All columns with block, slot, release and deadline (in slots) and
    ``mix_order``, by which rows are read in the mixed order.

    ``weights``: whole numbers, 1 for sources not named; by default
    :func:`default_weights`.
    """
    own = {c.lower() for c in ADDED}
    columns = [c for c in docs.columns if c.lower() not in own]
    inner = {c: f"_c{i}" for i, c in enumerate(columns)}
    rows = docs.select(*[F.col(f"`{c}`").alias(i) for c, i in inner.items()]).withColumn(
        "_source", F.coalesce(F.col(inner[source]).cast("string"), F.lit(NO_SOURCE))
    )
    numbered = number_rows(
        rows, [F.col("_source"), F.col(inner[id_column]).asc_nulls_first()], "_n", start=0
    )
    sizes = numbered.groupBy("_source").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_n").alias("_first")
    )
    if weights is None:
        weighted = default_weights(sizes)
    else:
        named = F.lit(1).cast("long")
        for name, weight in weights.items():
            named = F.when(F.col("_source") == name, F.lit(int(weight)).cast("long")).otherwise(named)
        weighted = sizes.withColumn("_weight", named)
    sources, _ = store(
        weighted.withColumn("_blocks", F.ceil(F.col("_rows") / F.lit(block_rows))), "mix-sources"
    )
    kinds, places = _patterns(sources)
    kinds, _ = store(kinds, "mix-kinds")
    places, _ = store(places, "mix-places")
    borders = kinds.agg(
        F.array_sort(F.collect_list(F.struct("_from", "_slots", "_start"))).alias("_kinds")
    )
    known = sources.select("_source", "_first", "_weight", borders.scalar().alias("_kinds"))
    placed = (
        numbered.join(known, "_source")
        .withColumn("_place", F.col("_n") - F.col("_first"))
        .withColumn("block", F.floor(F.col("_place") / F.lit(block_rows)))
        .withColumn("_frame", F.floor(F.col("block") / F.col("_weight")))
        .withColumn("_nth", F.col("block") % F.col("_weight"))
        .withColumn(
            "_kind",
            F.element_at(F.filter("_kinds", lambda k: k["_from"] <= F.col("_frame")), -1),
        )
        .withColumn("_from", F.col("_kind._from"))
        .drop("_kinds")
        .join(places, ["_from", "_source", "_nth"])
    )
    slots = F.col("_kind._slots")
    begin = F.col("_kind._start") + (F.col("_frame") - F.col("_from")) * slots
    return placed.select(
        *[F.col(i).alias(c) for c, i in inner.items()],
        F.col("block").cast("long").alias("block"),
        (begin + F.col("_pos")).cast("long").alias("slot"),
        (begin + F.floor(F.col("_nth") * slots / F.col("_m"))).cast("long").alias("release"),
        (begin + F.ceil((F.col("_nth") + 1) * slots / F.col("_m"))).cast("long").alias("deadline"),
        ((begin + F.col("_pos")) * block_rows + F.col("_place") % block_rows)
        .cast("long").alias("mix_order"),
    )


def in_mixed_order(
    docs: DataFrame, weights: dict[str, int] | None = None,
    id_column: str = "doc_id", source: str = "source", block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The documents, all columns, sorted into the mixed order: files and rows
    within files follow it."""
    inner = {c: f"_d{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(f"`{c}`").alias(i) for c, i in inner.items()])
    mixed = mix(renamed, weights, inner[id_column], inner[source], block_rows)
    return mixed.orderBy("mix_order").select(
        *[F.col(i).alias(c) for c, i in inner.items()]
    )
