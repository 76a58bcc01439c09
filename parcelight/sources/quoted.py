"""Records of delimited text whose quoted fields hold line breaks, from files that stay
splittable.

A line alone does not tell whether it begins inside a quoted field. But it tells where it
ends for either beginning, and so acts on the state (outside 0, inside 1) as one of four
functions: it keeps it, swaps it, or sets it to 0 or to 1. Functions compose, so the
state before any line follows from a prefix scan: first over the lines of each split
that do not keep the state, then over the splits of each file, one row each. Only
splits that contain such lines, or begin inside a field, are looked at line by line: their
lines are cut into records where the state is 0, and a record that goes on in the next
split is put together from its pieces. All other lines are records as they are.

A quote opens a field only at its beginning; elsewhere in an unquoted field it is a
character like others. Line ends inside a field read as ``\\n``.
"""

from __future__ import annotations

from os.path import commonprefix

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelight.storage import materialize

SPLIT = ["file", "start"]


def file_name(names: list[str]) -> Column:
    """The file of a row, among files of these names, in the order of the names but
    without what they share at both ends: it travels with every row."""
    path = F.col("_metadata.file_path")
    names = [name.replace(":///", ":/", 1) for name in names]  # as in the metadata
    start = len(commonprefix(names))
    rests = [name[start:] for name in names]
    end = 0
    if len({len(rest) for rest in rests}) == 1:  # else the order might change
        end = len(commonprefix([rest[::-1] for rest in rests]))
    if not names or not start + end:
        return path
    shared = F.startswith(path, F.lit(names[0][:start])) & F.endswith(
        path, F.lit(names[0][len(names[0]) - end:])
    )
    return F.when(shared, F.substring(path, F.lit(start + 1), F.length(path) - (start + end))).otherwise(path)


def _patterns(sep: str) -> tuple[str, str]:
    """Lines, without doubled quotes, that end inside a field if they begin outside, and
    if inside."""
    rest = rf"[^{sep}]*+"
    whole = rf'(?:"[^"]*+"{rest}|(?:[^"{sep}]{rest})?)'
    opened = rf'(?:{whole}{sep})*+"[^"]*+'
    return rf"\A{opened}\z", rf'\A[^"]*+(?:"{rest}{sep}{opened})?\z'


def read_lines(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """(file, start, row, value, swaps, sets): lines with their place, and how they act
    on the state; ``sets`` is null for lines that do not set it."""
    outside, inside = _patterns(sep)
    # A doubled quote leaves either state as it is.
    value = F.replace(F.col("value"), F.lit('""'), F.lit(""))
    has_quote = F.contains(value, F.lit('"'))
    ends = [F.when(has_quote, value.rlike(p)).otherwise(F.lit(bool(i))).cast("int")
            for i, p in enumerate((outside, inside))]
    text = spark.read.text(path)
    return text.select(
        file_name(text.inputFiles()).alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
        "value", ends[0].alias("_out"), ends[1].alias("_in"),
    ).select(
        *SPLIT, "row", "value",
        F.when((F.col("_out") == 1) & (F.col("_in") == 0), 1).otherwise(0).alias("swaps"),
        F.when(F.col("_out") == F.col("_in"), F.col("_out")).alias("sets"),
    )


def _composed(window) -> dict[str, Column]:
    """The function of all rows of a window: what the last setting row leaves and the
    swaps after it, or all swaps."""
    swaps = F.sum("swaps").over(window)
    at_set = F.last(F.when(F.col("sets").isNotNull(), F.struct("sets", F.col("_swaps").alias("swaps"))), True)
    last = at_set.over(window)
    return {"swaps": (swaps - F.coalesce(last["swaps"], F.lit(0))) % 2, "sets": last["sets"]}


def _applied(function: dict[str, Column], state: Column) -> Column:
    return (F.coalesce(function["sets"], state) + F.coalesce(function["swaps"], F.lit(0))) % 2


def split_states(lines: DataFrame) -> DataFrame:
    """(file, start, first, before, plain): each split with its first line, the
    state it begins in and whether all its lines are records as they are."""
    within = Window.partitionBy(*SPLIT).orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    # Lines that act on the state are few; only they are put in order.
    acting = lines.where("swaps = 1 OR sets IS NOT NULL").select(*SPLIT, "row", "swaps", "sets")
    acting = acting.withColumn("_swaps", F.sum("swaps").over(within))
    function = _composed(within)
    acts = acting.select(*SPLIT, "row", *[c.alias(n) for n, c in function.items()]).groupBy(*SPLIT).agg(
        F.max_by(F.struct("swaps", "sets"), "row").alias("_act")
    )
    splits = lines.groupBy(*SPLIT).agg(F.min("row").alias("first")).join(acts, SPLIT, "left").select(
        *SPLIT, "first", F.col("_act").isNull().alias("_quiet"),
        # As one line would act: what is set and swapped afterwards is set.
        F.when(F.col("_act.sets").isNull(), F.coalesce("_act.swaps", F.lit(0))).otherwise(0).alias("swaps"),
        ((F.col("_act.sets") + F.col("_act.swaps")) % 2).alias("sets"),
    )
    # One row per split of a file.
    along = Window.partitionBy("file").orderBy("start")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    counted = splits.withColumn(
        "_swaps", F.sum("swaps").over(along.rowsBetween(Window.unboundedPreceding, 0))
    )
    before = _applied(_composed(earlier), F.lit(0))
    return counted.withColumn("before", before).select(
        *SPLIT, "first", "before", (F.col("_quiet") & (F.col("before") == 0)).alias("plain")
    )


def records(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """(file, start, row, value): whole records, placed where they begin."""
    there = lines.join(splits.where(~F.col("plain")), SPLIT)
    plain = lines.join(splits.where(~F.col("plain")).select(*SPLIT), SPLIT, "left_anti").select(
        *SPLIT, "row", "value"
    )
    along = Window.partitionBy(*SPLIT).orderBy("row")
    up_to_here = along.rowsBetween(Window.unboundedPreceding, 0)
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    counted = there.withColumn("_swaps", F.sum("swaps").over(up_to_here))
    begins = (_applied(_composed(earlier), F.col("before")) == 0).cast("int")
    pieces = (
        counted.withColumn("_begins", begins)
        .withColumn("_record", F.sum("_begins").over(up_to_here))
        .groupBy(*SPLIT, "_record")
        .agg(F.min("row").alias("row"), F.sort_array(F.collect_list(F.struct("row", "value"))).alias("_lines"))
    )
    # A piece without a beginning belongs to the last record begun in an earlier split.
    last = pieces.groupBy(*SPLIT).agg(F.max(F.struct("_record", "row")).alias("_last"))
    begun = F.when(F.col("_last._record") > 0, F.struct("start", F.col("_last._record"), F.col("_last.row")))
    owner = F.last(begun, True).over(
        Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    )
    owners = last.select(*SPLIT, F.lit(0).cast("bigint").alias("_record"), owner.alias("_owner"))
    itself = F.struct("start", "_record", "row")
    whole = (
        pieces.join(owners, [*SPLIT, "_record"], "left")
        .select("file", F.coalesce("_owner", itself).alias("_at"), "start", "_lines")
        .groupBy("file", "_at")
        .agg(F.sort_array(F.collect_list(F.struct("start", "_lines"))).alias("_pieces"))
    )
    joined = F.array_join(F.flatten(F.transform("_pieces", lambda p: p["_lines"]["value"])), "\n")
    return plain.unionByName(
        whole.select("file", "_at.start", F.col("_at.row").alias("row"), joined.alias("value"))
    )


def read_records(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame | None:
    """(file, start, row, value): the records of files without their headers, or None
    if every line is a record. Lines that must be put together are stored first, so that
    their places are the same in every pass."""
    lines = read_lines(spark, path, sep)
    if lines.where("swaps = 1 OR sets = 1").isEmpty():
        return None
    lines = materialize(lines, "lines")
    splits = materialize(split_states(lines), "splits")
    headers = splits.where("start = 0").select(*SPLIT, F.col("first").alias("row"))
    return records(lines, splits).join(headers, [*SPLIT, "row"], "left_anti").where(
        F.col("value").rlike(r"[^\x00-\x20]")  # blank lines are no records
    )
