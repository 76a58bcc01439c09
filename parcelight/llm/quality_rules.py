"""Quality rules: counted limits, then robust multivariate outliers.

Counted per whole text, in SQL functions only: words, their characters, symbols,
repeated lines and words in repeated 3-word windows. A document that passes the
counted limits gives a vector of six transformed statistics. Per language and source
the minimum covariance determinant estimate of these vectors is found: from two
starting points (all rows; medians and median deviations), concentration steps
each refit mean and covariance to the ``SUPPORT`` share of rows that lie closest,
until the determinant stands still; the start with the smaller one wins. A
document is rejected when its Mahalanobis distance to its group's estimate is beyond ``CUTOFF``.

Statistics that most documents share exactly (no symbols at all) would make the
covariance singular; ``FLOORS`` are added to it, the least spread a statistic is
credited with. Shares of rows are found with counts over logarithmic buckets of
the distance, so no group is sorted or gathered: each step is two aggregates with
map-side combine, and a source that holds a third of all rows is spread like any
other. Groups of fewer than ``MIN_GROUP`` rows are pooled per language, then
together; a pool that is still smaller is judged by the counted limits alone.

Defined cases: a null text has no words and fails; null language or source is a
value of its own; a null id is carried; repeated rows are judged alike; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelight.llm.common import forget, fresh_name, store

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SUPPORT = 0.5  # share of a group's rows that the estimate rests on
MIN_GROUP = 64
MAX_STEPS = 12
# 1 - 1e-9 quantile of chi-square with six degrees of freedom, its median, and
# how much wider than normal the tails of clean text are taken to be.
CUTOFF = 53.0
MEDIAN = 5.348
BUCKETS = 32  # per power of two of the squared distance

STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FLOORS = [0.2, 0.05, 0.04, 0.1, 0.1, 0.05]
P = len(FLOORS)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _once(values: Column) -> Column:
    """The fields of a struct as columns. A generator is a border that filters
    are not pushed across, which would count everything again for each use."""
    return F.inline(F.array(values))


def _covered(hashes: Column) -> Column:
    """Words in windows that occur twice or more: the union of [i, i + 3) over
    the places i of such windows."""

    def places(ordered: Column) -> Column:
        def shared(x: Column, i: Column) -> Column:
            before = F.get(ordered, i - 1)["h"] == x["h"]
            after = F.get(ordered, i + 1)["h"] == x["h"]
            return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

        found = F.transform(F.filter(ordered, shared), lambda x: x["i"])
        return F.sort_array(found)

    def union(at: Column) -> Column:
        def reach(x: Column, i: Column) -> Column:
            following = F.coalesce(F.get(at, i + 1) - x, F.lit(3))
            return F.least(F.lit(3), following).cast("long")

        return F.aggregate(
            F.transform(at, reach), F.lit(0).cast("long"), lambda a, x: a + x
        )

    numbered = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return _let(F.sort_array(numbered), lambda o: _let(places(o), union))


def with_statistics(docs: DataFrame, text: str, prefix: str = "") -> DataFrame:
    """All columns and the counted statistics, ``prefix`` before their names.
    ``n_lines`` (lines with a word) and ``n_upper`` (A-Z) go into the vector."""
    t, w, h, lines = (fresh_name(docs, n) for n in ("_t", "_w", "_h", "_lines"))
    body = F.coalesce(F.col(text), F.lit(""))
    has_word = F.length(F.regexp_replace(F.col(t), SPACE + "+", ""))

    def left_out(pattern: str) -> Column:
        return (F.length(t) - F.length(F.regexp_replace(F.col(t), pattern, ""))).cast("long")

    window = F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.xxhash64(
            F.get(F.col(w), i), F.get(F.col(w), i + 1), F.get(F.col(w), i + 2)
        ),
    )
    prepared = (
        docs.withColumn(t, body)
        .withColumn(w, F.filter(F.split(F.col(t), SPACE + "+"), lambda x: x != ""))
        .withColumn(
            lines,
            F.filter(F.split(F.col(t), "\n"), lambda x: F.length(F.trim(F.translate(x, "\t\n\x0b\x0c\r", "     "))) > 0),
        )
        .withColumn(h, F.when(F.size(w) >= 3, window))
    )
    repeated = (
        F.when(F.col(h).isNull(), F.lit(0).cast("long"))
        .when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
        .otherwise(_covered(F.col(h)))
    )
    counted = F.struct(
        F.size(w).cast("long").alias(prefix + "n_words"),
        has_word.cast("long").alias(prefix + "word_chars"),
        left_out(SYMBOLS).alias(prefix + "n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias(prefix + "n_dup_lines"),
        repeated.alias(prefix + "n_repeat_words"),
        F.size(lines).cast("long").alias(prefix + "n_lines"),
        left_out("[A-Z]").alias(prefix + "n_upper"),
    )
    return prepared.select(*docs.columns, _once(counted))


def base_failed(prefix: str = "") -> Column:
    words, again = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    return (words < MIN_WORDS) | (100 * again > MAX_REPEAT_PERCENT * words)


def vector(prefix: str = "") -> list[Column]:
    """Transformed statistics of a document that has words."""

    def n(name: str) -> Column:
        return F.col(prefix + name).cast("double")

    def share(part: str, whole: str) -> Column:
        return F.sqrt(n(part) / F.greatest(n(whole), F.lit(1.0)))

    return [
        F.log1p(n("n_words")),
        F.log1p(n("word_chars") / F.greatest(n("n_words"), F.lit(1.0))),
        share("n_symbols", "word_chars"),
        share("n_dup_lines", "n_lines"),
        share("n_repeat_words", "n_words"),
        share("n_upper", "word_chars"),
    ]


# -- estimates -------------------------------------------------------------------
_LOWER = [(i, j) for i in range(P) for j in range(i + 1)]


def with_distance(rows: DataFrame, x: list[str], name: str) -> DataFrame:
    """z by z, so that no expression repeats the one before it."""
    out = rows
    for i in range(P):
        rest = F.col(x[i]) - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * F.col(f"_z{j}")
        out = out.withColumn(f"_z{i}", rest / F.col(f"l{i}{i}"))
    total = sum((F.col(f"_z{i}") * F.col(f"_z{i}") for i in range(P)), F.lit(0.0))
    return out.select(*rows.columns, total.alias(name))


def _factored(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Cholesky factor and log determinant from covariance columns c00.. ."""
    out = rows
    for i, j in _LOWER:
        rest = F.col(f"c{i}{j}")
        for k in range(j):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        out = out.withColumn(
            f"l{i}{j}",
            F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}"),
        )
    log_det = sum((F.log(F.col(f"l{i}{i}")) for i in range(P)), F.lit(0.0)) * 2
    return out.select(
        *keys,
        *[F.col(f"m{i}") for i in range(P)],
        *[F.col(f"l{i}{j}") for i, j in _LOWER],
        log_det.alias("log_det"),
    )


def _moments(rows: DataFrame, keys: list[str], x: list[str]) -> DataFrame:
    """Mean and floored covariance. Sums are of differences to m0.. where
    present, which keeps digits."""
    around = [F.col(c) - F.col(f"m{i}") for i, c in enumerate(x)]
    sums = rows.groupBy(*keys, *[f"m{i}" for i in range(P)]).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(d).alias(f"s{i}") for i, d in enumerate(around)],
        *[F.sum(around[i] * around[j]).alias(f"q{i}{j}") for i, j in _LOWER],
    )
    mean = [F.col(f"s{i}") / F.col("n") for i in range(P)]
    floor = [F.lit(f * f) for f in FLOORS]
    return sums.select(
        *keys,
        *[(F.col(f"m{i}") + mean[i]).alias(f"m{i}") for i in range(P)],
        *[
            (F.col(f"q{i}{j}") / F.col("n") - mean[i] * mean[j]
             + (floor[i] if i == j else F.lit(0.0))).alias(f"c{i}{j}")
            for i, j in _LOWER
        ],
    )


def _bucket(d2: Column) -> Column:
    return F.floor(F.log2(d2 + F.lit(1e-9)) * BUCKETS).cast("int")


def _at_share(rows: DataFrame, keys: list[str], share: float) -> DataFrame:
    """Per key, the bucket up to which at least ``share`` of the rows lie."""
    counts = rows.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*keys)
    running = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    # A group has some thousand buckets at most, however many rows.
    return (
        counts.select(
            *keys, "_b", F.sum("_n").over(running).alias("_upto"),
            F.sum("_n").over(whole).alias("_all"),
        )
        .where(F.col("_upto") >= F.ceil(F.lit(share) * F.col("_all")))
        .groupBy(*keys).agg(F.min("_b").alias("_cut"))
    )


def _group_names(rows: DataFrame) -> DataFrame:
    """(lang, source, group, wide): the group whose estimate judges a pair: its own, or
    all rows of its language, or all rows; and the group of its language where that
    judges any pair."""
    pairs = rows.groupBy("_lang", "_source").agg(F.count(F.lit(1)).alias("n"))
    langs = pairs.groupBy("_lang").agg(F.sum("n").alias("all"), F.min("n").alias("least"))
    own = F.concat(F.lit("2"), "_lang", F.lit("\u0001"), "_source")
    whole = F.when(F.col("all") >= MIN_GROUP, F.concat(F.lit("1"), "_lang"))
    large = F.col("n") >= MIN_GROUP
    return pairs.join(langs, "_lang").select(
        "_lang", "_source",
        F.coalesce(F.when(large, own), whole, F.lit("0")).alias("_group"),
        F.when(F.col("least") < MIN_GROUP, whole).alias("_wide"),
    )


def _keyed(rows: DataFrame, lang: str, source: str) -> DataFrame:
    none = F.lit("\u0000")
    return rows.withColumn("_lang", F.coalesce(F.col(lang).cast("string"), none)).withColumn(
        "_source", F.coalesce(F.col(source).cast("string"), none)
    )


def fit(stats: DataFrame, lang: str = "lang", source: str = "source") -> tuple[DataFrame, DataFrame]:
    """(group of each language and source, estimate of each group). ``stats``
    has the statistics and should be a stored table, as each step reads it."""
    spark = stats.sparkSession
    x = [f"x{i}" for i in range(P)]
    passed = _keyed(stats.where(~base_failed()), lang, source).select(
        "_lang", "_source", *[v.alias(n) for v, n in zip(vector(), x)]
    )
    names, _ = store(_group_names(passed), "rule-groups")
    # A row counts in each group that judges a pair and has it.
    everyone = F.lit("0") if not names.where("_group = '0'").isEmpty() else F.lit(None)
    own = F.when(F.substring("_group", 1, 1) == "2", F.col("_group"))
    member = F.explode(F.array_compact(F.array(own, F.col("_wide"), everyone.cast("string"))))
    rows, _ = store(
        passed.join(names, ["_lang", "_source"]).select(member.alias("_group"), *x), "rule-vectors"
    )
    names = names.drop("_wide")
    counted = rows.groupBy("_group").agg(F.count(F.lit(1)).alias("n"))
    enough = counted.where(F.col("n") >= MIN_GROUP).select("_group")

    # Start 0: all rows, around their mean. Start 1: medians and deviations.
    # Stored, they are known to be small, and the rows need not move.
    means, _ = store(
        rows.groupBy("_group").agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(x)]),
        "rule-means",
    )
    classic = _moments(rows.join(means, "_group"), ["_group"], x)
    medians, _ = store(
        rows.groupBy("_group").agg(
            *[F.percentile_approx(c, 0.5, 10_000).alias(f"m{i}") for i, c in enumerate(x)]
        ),
        "rule-medians",
    )
    apart = rows.join(medians, "_group").groupBy("_group", *[f"m{i}" for i in range(P)]).agg(
        *[
            F.percentile_approx(F.abs(F.col(c) - F.col(f"m{i}")), 0.5, 10_000).alias(f"d{i}")
            for i, c in enumerate(x)
        ]
    )
    robust = apart.select(
        "_group", *[f"m{i}" for i in range(P)],
        *[
            (F.pow(F.col(f"d{i}") * 1.4826, 2) + F.lit(FLOORS[i] ** 2) if i == j else F.lit(0.0)).alias(f"c{i}{j}")
            for i, j in _LOWER
        ],
    )
    starts = classic.withColumn("_start", F.lit(0)).unionByName(robust.withColumn("_start", F.lit(1)))
    keys = ["_group", "_start"]
    params, path = store(
        _factored(starts.join(enough, "_group", "left_semi"), keys), "rule-estimates"
    )

    def measured() -> DataFrame:
        near = with_distance(rows.join(params, "_group"), x, "_d2")
        return near.withColumn("_b", _bucket(F.col("_d2")))

    reached = None
    for _ in range(MAX_STEPS):
        near = measured()
        # Stored, the cuts are known to be few, and the rows need not move.
        cuts, cut_path = store(_at_share(near, keys, SUPPORT), "rule-cuts")
        inner = near.join(cuts, keys).where("_b <= _cut")
        params, newer = store(_factored(_moments(inner, keys, x), keys), "rule-estimates")
        forget(spark, path)
        forget(spark, cut_path)
        path = newer
        now = params.agg(F.sum(F.round("log_det", 3))).first()[0]
        if now == reached:
            break
        reached = now

    near = measured()
    half = _at_share(near, keys, 0.5).select(*keys, F.col("_cut").alias("_half"))
    best = params.groupBy("_group").agg(F.min_by("_start", F.struct("log_det", "_start")).alias("_start"))
    scale = F.pow(F.lit(2.0), (F.col("_half") + 1) / F.lit(float(BUCKETS))) / F.lit(MEDIAN)
    estimates, _ = store(
        params.join(best, keys, "left_semi").join(half, keys)
        .withColumn("scale", F.greatest(scale, F.lit(1.0))).drop("_start", "_half"),
        "rule-estimates",
    )
    return names, estimates


def judge(
    stats: DataFrame, model: tuple[DataFrame, DataFrame],
    lang: str = "lang", source: str = "source", prefix: str = "",
) -> DataFrame:
    """Adds ``prefix`` + base_failed, distance (null without an estimate), kept."""
    names, estimates = model
    x = [f"_x{i}" for i in range(P)]
    given = stats.columns
    keyed = _keyed(stats, lang, source).select(
        "*", *[v.alias(n) for v, n in zip(vector(prefix), x)]
    )
    # A pair that had no row to fit is judged with the widest group.
    grouped = keyed.join(names, ["_lang", "_source"], "left").withColumn(
        "_group", F.coalesce("_group", F.lit("0"))
    )
    joined = grouped.join(estimates, "_group", "left")
    near = with_distance(joined, x, "_raw").select(
        *joined.columns, _once(F.struct(F.col("_raw").alias("_d2")))
    )
    distance = F.sqrt(F.col("_d2") / F.col("scale"))
    outlier = F.coalesce(distance > F.lit(CUTOFF ** 0.5), F.lit(False))
    return near.select(
        *given,
        base_failed(prefix).alias(prefix + "base_failed"),
        distance.alias(prefix + "distance"),
        (~base_failed(prefix) & ~outlier).alias(prefix + "kept"),
    )


def quality_rules(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text",
    lang: str = "lang", source: str = "source",
) -> DataFrame:
    """Statistics and verdict of every row."""
    narrow = docs.select(
        id_column, F.col(lang).alias("_l"), F.col(source).alias("_s"), F.col(text).alias("_text")
    )
    stats, _ = store(with_statistics(narrow, "_text").drop("_text"), "rule-statistics")
    found = judge(stats, fit(stats, "_l", "_s"), "_l", "_s")
    return found.select(id_column, *STATISTICS, "base_failed", "kept", "distance")


def keep_good(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """The rows that the rules keep, with their columns."""
    narrow = docs.select(
        F.col(lang).alias("_l"), F.col(source).alias("_s"), F.col(text).alias("_text")
    )
    stats, _ = store(with_statistics(narrow, "_text").drop("_text"), "rule-statistics")
    model = fit(stats, "_l", "_s")
    # Working names of our own, whatever the columns are called.
    inner = [f"_c{i}" for i in range(len(docs.columns))]
    place = dict(zip(docs.columns, inner))
    rows = with_statistics(docs.toDF(*inner), place[text], "_rule_")
    kept = judge(rows, model, place[lang], place[source], "_rule_").where("_rule_kept")
    return kept.select(*[F.col(i).alias(c) for i, c in zip(inner, docs.columns)])
