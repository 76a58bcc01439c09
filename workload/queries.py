"""One query per operator, over the views of :mod:`workload.views`.

Stage queries read the stored table of the stage before them, as a run does;
the ``etl_`` queries run their whole stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelight import functions as X
from parcelight import sinks, sources
from parcelight.constants import (
    EXPORT_COLUMNS,
    F1_GATE,
    LEAD_COLUMNS,
    MODEL_COLUMNS,
    RESIDENTIAL_CODES,
    SOURCE_COLUMNS,
)
from parcelight.operators import RANK_ERROR, number_rows, top_counts
from parcelight.plans import (
    audit,
    cleaning,
    diagnostics,
    export,
    features,
    ingest,
    profiling,
    runs,
    scoring,
)
from parcelight.sources.tables import by_city, by_codes
from parcelight.storage import materialize, new_path
from parcelight.streaming import append_arrivals
from workload import views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _row_wise(name: str, table: str, **columns) -> None:
    """Registers a query that shows expressions per OBJECTID of a stage table."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = views.stage(spark, sf_dir, table)
        return df.select(
            "OBJECTID", *[make().alias(c) for c, make in columns.items()]
        )

    QUERIES[name] = run


# -- sources ----------------------------------------------------------------------


@query
def src_tsv_scan(spark, sf_dir):
    path = views.source_file(spark, sf_dir, "owners")
    return sources.read_tsv(spark, path, SOURCE_COLUMNS["owners"], ordinal=False)


@query
def src_tsv_full_width(spark, sf_dir):
    rows = sources.read_tsv(spark, views.source_file(spark, sf_dir, "sales"), ordinal=False)
    # A number's text may differ between engines, its value does not.
    return rows.withColumn("Sale_Price", X.parse_number("Sale_Price"))


@query
def src_table_scan(spark, sf_dir):
    return views.leads(spark, sf_dir).select(*LEAD_COLUMNS)


@query
def src_projected_scan(spark, sf_dir):
    return views.tables(spark, sf_dir, "leads").lead_details()


@query
def src_by_city(spark, sf_dir):
    found = by_city(views.leads(spark, sf_dir), "nation_5")
    return found.select("OBJECTID", "Parcel", "PHY_CITY", "JV")


@query
def src_by_codes(spark, sf_dir):
    found = by_codes(views.leads(spark, sf_dir), ["001", "002"])
    return found.select("OBJECTID", "Parcel", "DOR_UC", "JV")


@query
def src_latest_run_scores(spark, sf_dir):
    tables = sources.LeadTables(spark, new_path(spark, "runs"))
    ranked = scoring.rank_leads(views.scores(spark, sf_dir))
    sinks.append_run_scores(ranked, tables, "RUN_A", "PREDICT")
    half = ranked.withColumn("hot_lead_score", F.col("hot_lead_score") / 2)
    sinks.append_run_scores(half, tables, "RUN_B", "PREDICT")
    return tables.scores().select("run_id", "OBJECTID", "hot_lead_score", "rank")


# -- sinks ------------------------------------------------------------------------


@query
def sink_overwrite_count(spark, sf_dir):
    tables = sources.LeadTables(spark, new_path(spark, "overwrite"))
    rows = views.clean(spark, sf_dir)
    sinks.overwrite_table(rows.limit(10), tables, "leads_clean")
    written = sinks.overwrite_table(rows, tables, "leads_clean")
    return tables.read("leads_clean").agg(
        F.lit(written).cast("bigint").alias("written"),
        F.count(F.lit(1)).alias("read_back"),
    )


@query
def sink_append_ignore_dups(spark, sf_dir):
    """Residential leads first, with a changed value; then all leads, which
    must not replace or repeat them; then the same again."""
    tables = sources.LeadTables(spark, new_path(spark, "append"))
    rows = views.leads(spark, sf_dir).select(*LEAD_COLUMNS)
    first = by_codes(rows, list(RESIDENTIAL_CODES)).withColumn("JV", F.col("JV") + 1)
    sinks.append_new_rows(first, tables, "leads", "OBJECTID", F.col("Parcel"))
    for _ in range(2):
        sinks.append_new_rows(rows, tables, "leads", "OBJECTID")
    return tables.read("leads").select("OBJECTID", "Parcel", "JV")


@query
def sink_append_indexed(spark, sf_dir):
    """As above, with the keys of each part kept by bucket."""
    tables = sources.LeadTables(spark, new_path(spark, "indexed"))
    rows = views.leads(spark, sf_dir).select(*LEAD_COLUMNS)
    first = by_codes(rows, list(RESIDENTIAL_CODES)).withColumn("JV", F.col("JV") + 1)
    for batch in (first, rows, rows.where("OBJECTID % 7 = 0")):
        sinks.append_new_rows(batch, tables, "leads", "OBJECTID", index_from=1)
    return tables.read("leads").select("OBJECTID", "Parcel", "JV")


@query
def sink_append_layout(spark, sf_dir):
    """A batch that lacks columns, then one with values as text."""
    tables = sources.LeadTables(spark, new_path(spark, "layout"))
    rows = views.leads(spark, sf_dir)
    few = rows.where("OBJECTID % 2 = 0").select("OBJECTID", "Parcel")
    sinks.append_new_rows(few, tables, "leads", "OBJECTID", unique=True)
    texts = rows.select("OBJECTID", "Parcel", F.col("ACT_YR_BLT").cast("string"), "PHY_CITY")
    sinks.append_new_rows(texts, tables, "leads", "OBJECTID", unique=True)
    return tables.read("leads").select("OBJECTID", "Parcel", "ACT_YR_BLT", "PHY_CITY", "JV")


@query
def sink_scored_run(spark, sf_dir):
    tables = sources.LeadTables(spark, new_path(spark, "scored"))
    ranked = scoring.rank_leads(views.scores(spark, sf_dir))
    for again in (False, True):
        sinks.append_run_scores(ranked, tables, "RUN_A", "PREDICT", replace_run=again)
    return tables.read("scored_leads").drop("created_at")


@query
def sink_export_file(spark, sf_dir):
    path = new_path(spark, "export")
    rows = export_format(spark, sf_dir)
    sinks.write_ranked_file(rows, path)
    return spark.read.schema(rows.schema).option("header", True).csv(path)


# -- projections ------------------------------------------------------------------


@query
def proj_to_number(spark, sf_dir):
    return views.history(spark, sf_dir).select(
        F.col("_ord").alias("ord"),
        X.parse_number("Just_Value").alias("value"),
        X.number_or_zero("Just_Value").alias("value_or_zero"),
        X.parse_number("Hist_Tax_Year").alias("tax_year"),
    )


@query
def proj_text_norm(spark, sf_dir):
    return views.property_rows(spark, sf_dir).select(
        F.col("_ord").alias("ord"),
        X.normal_text("City_Desc", upper=True).alias("city"),
        X.normal_text("NBHD_Code").alias("neighborhood"),
        X.normal_text("City_Desc", upper=True, strict_nulls=True).alias("strict_city"),
    )


@query
def proj_code_prefix(spark, sf_dir):
    return views.property_rows(spark, sf_dir).select(
        F.col("_ord").alias("ord"), X.code_prefix("Prop_Use_Code").alias("code")
    )


@query
def proj_zip5(spark, sf_dir):
    return views.owners(spark, sf_dir).select(
        F.col("_ord").alias("ord"), X.zip5("Owner_Mail_Zip").alias("zip")
    )


@query
def proj_year_prefix(spark, sf_dir):
    return views.sales(spark, sf_dir).select(
        F.col("_ord").alias("ord"), X.year_prefix("Sale_Date").alias("yr")
    )


@query
def proj_null_fill(spark, sf_dir):
    parcels = ingest.prepare_property(views.property_rows(spark, sf_dir))
    sold = ingest.prepare_sales(views.sales(spark, sf_dir))
    return ingest.fill_missing(parcels.join(sold, "Parcel", "left")).select(
        "Parcel", "DOR_UC", "SALE_PRC1", "SALE_YR1", "QUAL_CD1", "SALE_PRC2", "SALE_YR2"
    )


@query
def proj_out_fields(spark, sf_dir):
    rows = views.leads(spark, sf_dir)
    shuffled = rows.select(*sorted(rows.columns, reverse=True))
    return ingest.select_lead_columns(shuffled)


# -- source preparation -------------------------------------------------------------


def _prepared(name: str, prepare, view) -> None:
    QUERIES[name] = lambda spark, sf_dir: prepare(view(spark, sf_dir))


_prepared("prep_property", ingest.prepare_property, views.property_rows)
_prepared("prep_owners", ingest.prepare_owners, views.owners)
_prepared("prep_history", ingest.prepare_history, views.history)
_prepared("prep_land", ingest.prepare_land, views.land)
_prepared("prep_improvements", ingest.prepare_improvements, views.improvements)
_prepared("prep_sales", ingest.prepare_sales, views.sales)


@query
def prep_imprv_filter(spark, sf_dir):
    kept = ingest.drop_non_buildings(views.improvements(spark, sf_dir))
    return kept.groupBy("Imprv_Type").agg(F.count(F.lit(1)).alias("n"))


@query
def etl_build_leads(spark, sf_dir):
    return ingest.build_leads(views.source_tables(spark, sf_dir), numbered=False)


@query
def etl_leads_from_files(spark, sf_dir):
    """All six tables through tab-separated files: the rows' order is then
    known only from the files."""
    folder = views.source_folder(spark, sf_dir)
    return ingest.build_leads(sources.read_source_tables(spark, folder))


@query
def etl_assign_objectid(spark, sf_dir):
    parcels = ingest.build_leads(views.source_tables(spark, sf_dir))
    return parcels.select("OBJECTID", "Parcel")


@query
def etl_resume_slice(spark, sf_dir):
    rest = ingest.resume_slice(views.leads(spark, sf_dir), loaded=250, goal=750)
    return rest.select("OBJECTID", "Parcel")


# -- cleaning -----------------------------------------------------------------------


@query
def clean_code_pad(spark, sf_dir):
    bare = views.leads(spark, sf_dir).withColumn(
        "DOR_UC", F.ltrim("DOR_UC", F.lit("0"))
    )
    return cleaning.pad_use_code(bare).select("OBJECTID", "DOR_UC")


@query
def clean_residential(spark, sf_dir):
    return cleaning.keep_residential(views.leads(spark, sf_dir)).select(
        "OBJECTID", "DOR_UC"
    )


@query
def clean_jv_min(spark, sf_dir):
    return cleaning.keep_minimum_value(views.leads(spark, sf_dir)).select(
        "OBJECTID", "JV"
    )


@query
def clean_value_fence(spark, sf_dir):
    rows = cleaning.keep_residential(views.leads(spark, sf_dir))
    fence = cleaning.value_fence(cleaning.keep_minimum_value(rows))
    return fence.select(*[F.round(c, 4).alias(c) for c in fence.columns])


def _filtered(spark, sf_dir):
    stored = views.leads(spark, sf_dir)
    return cleaning.filter_leads(stored, cleaning.fit_fence(stored))


@query
def clean_sketched_fence(spark, sf_dir):
    """Quartiles of the eligible values from the sketches of two loads: how many values
    are behind them, and that their ranks are within the stated error."""
    leads = views.leads(spark, sf_dir)
    loads = [leads.where(F.col("OBJECTID") % 2 == i) for i in (0, 1)]
    sketches = materialize(
        cleaning.sketch_load(loads[0]).union(cleaning.sketch_load(loads[1])), "sketches")
    fence = cleaning.sketched_fence(sketches).first()
    value, n = F.col("JV"), F.count(F.lit(1))
    error = RANK_ERROR + 1 / n  # a rank is one value on either side, whatever the error
    within = [
        ((F.avg((value < fence[q]).cast("int")) - error <= p)
         & (F.avg((value <= fence[q]).cast("int")) + error >= p)).alias(q)
        for q, p in (("q1", 0.25), ("q3", 0.75))
    ]
    ranks = cleaning.eligible_leads(leads).agg(n.alias("n"), *within)
    return ranks.unpivot("n", ["q1", "q3"], "quartile", "within_error")


@query
def clean_jv_iqr(spark, sf_dir):
    return _filtered(spark, sf_dir).select(
        "OBJECTID", "DOR_UC", "JV"
    )


@query
def clean_city_corrections(spark, sf_dir):
    rows = _filtered(spark, sf_dir)
    return cleaning.spell_city(rows).select("OBJECTID", "PHY_CITY")


@query
def clean_city_fill(spark, sf_dir):
    rows = _filtered(spark, sf_dir)
    return cleaning.fill_city(rows).select("OBJECTID", "PHY_CITY", "PHY_ZIPCD")


@query
def clean_unknown_share(spark, sf_dir):
    rows = _filtered(spark, sf_dir)
    return cleaning.unknown_city_share(cleaning.fill_city(rows))


@query
def clean_act_year(spark, sf_dir):
    rows = _filtered(spark, sf_dir)
    return cleaning.fill_actual_year(rows).select("OBJECTID", "DOR_UC", "ACT_YR_BLT")


@query
def clean_eff_year(spark, sf_dir):
    rows = cleaning.fill_actual_year(_filtered(spark, sf_dir))
    return cleaning.fill_effective_year(rows).select(
        "OBJECTID", "ACT_YR_BLT", "EFF_YR_BLT"
    )


@query
def clean_living_area_null(spark, sf_dir):
    return cleaning.blank_living_area(views.leads(spark, sf_dir)).select(
        "OBJECTID", "TOT_LVG_AR"
    )


@query
def clean_repair_counts(spark, sf_dir):
    return cleaning.repair_counts(_filtered(spark, sf_dir))


@query
def etl_clean_leads(spark, sf_dir):
    stored = views.leads(spark, sf_dir)
    clean = cleaning.clean_leads(stored, cleaning.fit_cleaning(stored))
    return clean.drop("created_at")


# -- features -----------------------------------------------------------------------

_row_wise("feat_property_age", "leads_clean",
          property_age=lambda: features.property_age(views.AS_OF_YEAR))
_row_wise("feat_corporate_owner", "leads_clean",
          is_corporate_owner=features.corporate_owner)
_row_wise("feat_absentee_owner", "leads_clean",
          is_absentee_owner=features.absentee_owner)
_row_wise("feat_out_of_state", "leads_clean",
          is_out_of_state_owner=features.out_of_state_owner,
          strict=lambda: features.out_of_state_owner(strict_nulls=True))
_row_wise("feat_price_per_sqft", "leads_clean", price_per_sqft=features.price_per_sqft)
_row_wise("feat_lot_coverage", "leads_clean", lot_coverage_ratio=features.lot_coverage)
_row_wise("feat_renovation_gap", "leads_clean", renovation_gap=features.renovation_gap)
_row_wise("feat_value_tier", "leads_clean",
          value_tier=lambda: X.value_tier("JV"),
          value_tier_encoded=lambda: X.value_tier_code("JV"))
_row_wise("feat_distressed_sale", "leads_clean",
          distressed_sale_history=features.distressed_sale)
_row_wise("feat_never_sold", "leads_clean", never_sold=features.never_sold)
_row_wise("feat_land_ratio", "leads",
          land_ratio=lambda: F.round(features.land_ratio(), 6))


@query
def feat_neighborhood_ratio(spark, sf_dir):
    rated = features.with_neighborhood_ratio(views.clean(spark, sf_dir))
    return rated.select(
        "OBJECTID",
        F.round("neighborhood_value_ratio", 6).alias("neighborhood_value_ratio"),
    )


@query
def feat_neighborhood_ratio_strict(spark, sf_dir):
    """Leads built, cleaned and rated with unknown neighbourhoods left unknown."""
    leads = materialize(
        ingest.build_leads(views.source_tables(spark, sf_dir), strict_nulls=True), "strict"
    )
    clean = cleaning.clean_leads(leads, cleaning.fit_cleaning(leads))
    rated = features.with_neighborhood_ratio(clean)
    return rated.select(
        "OBJECTID", "NBRHD_CD",
        F.round("neighborhood_value_ratio", 6).alias("neighborhood_value_ratio"),
    )


@query
def feat_hot_lead(spark, sf_dir):
    rows = features.add_features(views.clean(spark, sf_dir), views.AS_OF_YEAR)
    return rows.select("OBJECTID", X.signal_score().alias("signals"), "hot_lead")


@query
def etl_features(spark, sf_dir):
    rows = features.engineer(views.clean(spark, sf_dir), views.AS_OF_YEAR)
    return rows.drop("created_at").withColumn(
        "neighborhood_value_ratio", F.round("neighborhood_value_ratio", 6)
    )


@query
def feat_flag_balance(spark, sf_dir):
    return features.flag_balance(views.features(spark, sf_dir))


@query
def feat_signal_histogram(spark, sf_dir):
    return features.signal_histogram(views.features(spark, sf_dir))


@query
def feat_tier_distribution(spark, sf_dir):
    return features.tier_distribution(views.features(spark, sf_dir))


@query
def feat_valuation_counts(spark, sf_dir):
    return features.valuation_counts(views.features(spark, sf_dir))


@query
def agg_group_mean_top(spark, sf_dir):
    return features.top_groups_by_size(views.features(spark, sf_dir))


# -- aggregations and profiles ----------------------------------------------------------


@query
def agg_record_count(spark, sf_dir):
    return profiling.record_count(views.leads(spark, sf_dir))


@query
def agg_summary_stats(spark, sf_dir):
    return profiling.summary_stats(views.leads(spark, sf_dir))


@query
def agg_value_counts(spark, sf_dir):
    columns = ["PHY_CITY", "DOR_UC", "QUAL_CD1", "OWN_STATE_"]
    return profiling.value_counts_by_column(views.leads(spark, sf_dir), columns, 20)


@query
def profile_nulls_zeros(spark, sf_dir):
    return profiling.nulls_and_zeros(views.clean(spark, sf_dir))


@query
def profile_coverage(spark, sf_dir):
    return profiling.field_coverage(views.leads(spark, sf_dir))


@query
def profile_buckets(spark, sf_dir):
    return profiling.range_buckets(views.leads(spark, sf_dir))


@query
def profile_of_load(spark, sf_dir):
    """What two loads counted as they were written; no row is read for it."""
    tables = sources.LeadTables(spark, new_path(spark, "profiled"))
    rows = views.leads(spark, sf_dir).select(*LEAD_COLUMNS)
    for load in (0, 1):
        sinks.append_new_rows(
            rows.where(F.col("OBJECTID") % 2 == load), tables, "leads", "OBJECTID",
            unique=True, checks=profiling.load_checks())
    return profiling.load_profile(tables)


@query
def profile_describe(spark, sf_dir):
    latest = profiling.latest_values(
        views.history(spark, sf_dir), ["Just_Value", "Land_Value"]
    )
    return profiling.describe_numbers(
        latest, {"Just_Value": 1000.0, "Land_Value": 20000.0}
    )


@query
def profile_describe_improvements(spark, sf_dir):
    rows = ingest.drop_non_buildings(views.improvements(spark, sf_dir))
    columns = {"Actual_YrBlt": 1900.0, "Heated_SquareFeet": 1000.0}
    numbers = rows.select(*[X.parse_number(c).alias(c) for c in columns])
    return profiling.describe_numbers(numbers, columns)


@query
def profile_describe_sales(spark, sf_dir):
    rows = views.sales(spark, sf_dir).where(X.parse_number("Sale_Line_Num") == 0)
    price = rows.select(X.parse_number("Sale_Price").alias("Sale_Price"))
    return profiling.describe_numbers(price, {"Sale_Price": 100000.0})


@query
def profile_describe_features(spark, sf_dir):
    rows = views.features(spark, sf_dir).withColumn("land_ratio", features.land_ratio())
    return profiling.describe_numbers(rows, {
        "JV": 100000.0, "property_age": 30.0, "renovation_gap": 1.0,
        "price_per_sqft": 1.0, "lot_coverage_ratio": 0.5, "land_ratio": 0.2,
        "neighborhood_value_ratio": 0.8,
    })


@query
def profile_tax_years(spark, sf_dir):
    return profiling.tax_years(views.history(spark, sf_dir))


@query
def profile_owners(spark, sf_dir):
    return profiling.owner_profile(views.owners(spark, sf_dir))


@query
def agg_top_states(spark, sf_dir):
    """States of out-of-state owners."""
    rows = views.leads(spark, sf_dir).where(profiling.out_of_state())
    return top_counts(rows, "OWN_STATE_", 8)


@query
def profile_join_coverage(spark, sf_dir):
    return profiling.join_coverage(views.source_tables(spark, sf_dir))


@query
def profile_survival(spark, sf_dir):
    return profiling.survival_funnel(views.leads(spark, sf_dir))


@query
def profile_survival_estimate(spark, sf_dir):
    return profiling.survival_estimate(
        views.property_rows(spark, sf_dir), views.history(spark, sf_dir)
    )


@query
def profile_rule_compare(spark, sf_dir):
    return profiling.rule_compare(views.sales(spark, sf_dir))


@query
def profile_matched_codes(spark, sf_dir):
    return profiling.matched_codes(views.sales(spark, sf_dir))


@query
def profile_range_violations(spark, sf_dir):
    return profiling.range_violations(views.features(spark, sf_dir), as_of_year=2000)


@query
def set_key_intersect(spark, sf_dir):
    return profiling.common_keys(
        views.owners(spark, sf_dir), views.sales(spark, sf_dir)
    )


# -- ranking, scores, export --------------------------------------------------------------


@query
def score_rank(spark, sf_dir):
    return scoring.rank_leads(views.scores(spark, sf_dir))


@query
def score_topk(spark, sf_dir):
    return scoring.top_leads(views.scores(spark, sf_dir), 25).select(
        "OBJECTID", "hot_lead_score"
    )


@query
def score_summary(spark, sf_dir):
    return scoring.score_summary(views.scores(spark, sf_dir))


@query
def export_join(spark, sf_dir):
    return export.with_details(
        views.scores(spark, sf_dir), views.leads(spark, sf_dir)
    )


@query
def export_join_matched(spark, sf_dir):
    return export.matched_count(export_join(spark, sf_dir))


@query
def export_temperature(spark, sf_dir):
    return export.with_temperature(views.scores(spark, sf_dir)).select(
        "OBJECTID", "hot_lead_score", "temperature"
    )


@query
def export_temperature_counts(spark, sf_dir):
    return export.temperature_counts(export_temperature(spark, sf_dir))


@query
def export_format(spark, sf_dir):
    ranked = scoring.rank_leads(views.scores(spark, sf_dir))
    return export.export_leads(ranked, views.leads(spark, sf_dir))


# -- model --------------------------------------------------------------------------------


@query
def ml_class_balance(spark, sf_dir):
    return scoring.class_balance(views.features(spark, sf_dir))


@query
def ml_stratified_split(spark, sf_dir):
    return scoring.with_split(views.features(spark, sf_dir)).select(
        "OBJECTID", "hot_lead", "is_test"
    )


@query
def ml_standard_scale(spark, sf_dir):
    rows = scoring.with_split(scoring.model_input(views.features(spark, sf_dir)))
    scaled = scoring.scale_columns(rows, MODEL_COLUMNS, ~F.col("is_test"))
    return scaled.select("OBJECTID", *[F.round(c, 6).alias(c) for c in MODEL_COLUMNS])


@query
def ml_cv_folds(spark, sf_dir):
    return scoring.with_fold(views.features(spark, sf_dir)).select(
        "OBJECTID", "hot_lead", "fold"
    )


def _rounded(metrics: DataFrame) -> DataFrame:
    return metrics.withColumns(
        {c: F.round(c, 6) for c in ("precision", "recall", "f1")}
    )


@query
def ml_eval_metrics(spark, sf_dir):
    return _rounded(scoring.confusion_metrics(views.predictions(spark, sf_dir)))


@query
def ml_fold_metrics(spark, sf_dir):
    rows = scoring.with_fold(views.predictions(spark, sf_dir))
    return _rounded(scoring.confusion_metrics(rows, ["fold"]))


@query
def ml_train_score(spark, sf_dir):
    """Every row scored by boosted trees fitted on the training rows, and again
    by the stored model. Facts about the scores, which are Spark's own."""
    rows = views.features(spark, sf_dir)
    trained = views.training(spark, sf_dir)
    own = scoring.score(rows, trained.model).select("OBJECTID", "hot_lead", "hot_lead_score")
    stored = scoring.score(rows, scoring.load_model(trained.path)).select(
        "OBJECTID", F.col("hot_lead_score").alias("stored_score")
    )
    return own.join(stored, "OBJECTID").select(
        "OBJECTID", "hot_lead",
        F.col("hot_lead_score").between(0.0, 1.0).alias("is_probability"),
        (F.col("hot_lead_score") == F.col("stored_score")).alias("same_when_loaded"),
        F.lit(trained.f1 >= F1_GATE and trained.saved).alias("above_gate"),
    )


@query
def ml_fitted_scaler(spark, sf_dir):
    """Mean and deviation that the stored model scales each input with."""
    scaler = views.training(spark, sf_dir).model.stages[1]
    rows = [
        (c, round(float(m), 4), round(float(s), 4))
        for c, m, s in zip(MODEL_COLUMNS, scaler.mean, scaler.std)
    ]
    return spark.createDataFrame(rows, "feature string, mean double, deviation double")


@query
def ml_feature_importance(spark, sf_dir):
    """The inputs, and that their shares are shares."""
    shares = views.training(spark, sf_dir).importance
    whole = shares.agg(F.round(F.sum("importance"), 6).alias("total"))
    return shares.select(
        "feature", (F.col("importance") >= 0).alias("is_share"), whole.scalar().alias("total")
    )


@query
def ml_cross_validation(spark, sf_dir):
    """Rows of each fold by actual class, and that F1 is above that of calling every row
    hot, the best a guess without inputs can do."""
    folds = views.training(spark, sf_dir).folds
    hot, cold = F.col("tp") + F.col("fn"), F.col("fp") + F.col("tn")
    return folds.select(
        "fold", hot.alias("hot"), cold.alias("cold"),
        (F.col("f1") > 2 * hot / (2 * hot + cold)).alias("above_chance"),
    )


@query
def ml_held_out_rows(spark, sf_dir):
    """Each row's fold in the cross-validation that predicted it, joined back to
    the features."""
    predicted = views.training(spark, sf_dir).held_out
    rows = diagnostics.with_predictions(views.features(spark, sf_dir), predicted)
    return rows.select(
        "OBJECTID", "fold", "PHY_CITY", F.col("prediction").isin(0.0, 1.0).alias("is_class")
    )


# -- diagnostics -----------------------------------------------------------------------------


def _folded(spark, sf_dir):
    return scoring.with_fold(views.predictions(spark, sf_dir))


@query
def diag_fold_profile(spark, sf_dir):
    return diagnostics.fold_profile(_folded(spark, sf_dir))


@query
def diag_fold_top_values(spark, sf_dir):
    wanted = {"PHY_CITY": 5, "DOR_UC": None, "NBRHD_CD": 5, "value_tier": None}
    return diagnostics.fold_top_values(_folded(spark, sf_dir), wanted)


@query
def diag_worst_fold(spark, sf_dir):
    return diagnostics.worst_fold(_folded(spark, sf_dir))


@query
def diag_error_profile(spark, sf_dir):
    return diagnostics.error_profile(diagnostics.of_worst_fold(_folded(spark, sf_dir)))


@query
def diag_error_top_values(spark, sf_dir):
    wanted = {"PHY_CITY": 3, "value_tier": 3, "DOR_UC": 3}
    worst = diagnostics.of_worst_fold(_folded(spark, sf_dir))
    return diagnostics.error_top_values(worst, wanted)


@query
def diag_fold_label_rate(spark, sf_dir):
    return diagnostics.fold_label_rate(_folded(spark, sf_dir))


# -- run log ---------------------------------------------------------------------------------


@query
def log_latest_status(spark, sf_dir):
    return audit.latest_status(views.run_log(spark, sf_dir))


@query
def log_last_run(spark, sf_dir):
    return audit.last_run(views.run_log(spark, sf_dir))


@query
def log_run_summary(spark, sf_dir):
    return audit.run_summary(views.run_log(spark, sf_dir))


@query
def log_run_complete(spark, sf_dir):
    return audit.run_completion(views.run_log(spark, sf_dir), "TRAIN")


# -- whole runs ---------------------------------------------------------------------------------


@query
def etl_incremental_load(spark, sf_dir):
    """Leads loaded from the files in two steps; the second takes up where
    the first stopped, a third finds nothing to do."""
    tables = sources.LeadTables(spark, new_path(spark, "incremental"))
    folder = views.source_folder(spark, sf_dir)
    first = runs.load_leads(tables, folder, goal=100)
    rest = runs.load_leads(tables, folder)
    return tables.read("leads").select(
        *LEAD_COLUMNS,
        F.lit(first).cast("bigint").alias("first_load"),
        F.lit(rest).cast("bigint").alias("second_load"),
    )


@query
def etl_arrivals(spark, sf_dir):
    """Stored leads picked up as arriving files, twice."""
    tables = sources.LeadTables(spark, new_path(spark, "arrivals"))
    stored = views.tables(spark, sf_dir, "leads")
    marks = new_path(spark, "arrival-marks")
    schema = stored.read("leads").schema
    for _ in range(2):
        rows = spark.readStream.schema(schema).parquet(stored.folders("leads")[0])
        append_arrivals(rows, tables, "leads", "OBJECTID", marks).awaitTermination()
    return tables.read("leads").select("OBJECTID", "Parcel", "JV")


@query
def run_stage_counts(spark, sf_dir):
    """Run log of a run up to the features: rows in and out of each stage."""
    tables = sources.LeadTables(spark, new_path(spark, "run"))
    sinks.overwrite_table(views.leads(spark, sf_dir), tables, "leads")
    run = runs.Run(tables, "TRAIN", as_of_year=views.AS_OF_YEAR, run_id="RUN_A")
    run.through_features()
    run.through_features()  # completed stages are left alone
    return audit.run_summary(tables.read("pipeline_log"), "RUN_A").select(
        "stage", "status", "records_in", "records_out"
    )


@query
def run_train_predict(spark, sf_dir):
    """Training run, then a scoring run with the stored model: its export, with
    rank and band held against the score."""
    tables = sources.LeadTables(spark, new_path(spark, "run"))
    sinks.overwrite_table(views.leads(spark, sf_dir), tables, "leads")
    model = new_path(spark, "model")
    year = views.AS_OF_YEAR
    runs.Run(tables, "TRAIN", as_of_year=year, run_id="RUN_T").train(model)
    runs.Run(tables, "PREDICT", as_of_year=year, run_id="RUN_P").predict(model)
    out = tables.read("export_leads")
    order = [F.desc("hot_lead_score"), F.asc("OBJECTID")]
    expected = number_rows(out.select("OBJECTID", "hot_lead_score"), order, "expected")
    return out.join(expected.select("OBJECTID", "expected"), "OBJECTID").select(
        *[c for c in EXPORT_COLUMNS if c not in ("rank", "hot_lead_score", "temperature")],
        (F.col("rank") == F.col("expected")).alias("rank_follows"),
        (F.col("temperature") == X.temperature("hot_lead_score")).alias("band_follows"),
    )


@query
def run_resume(spark, sf_dir):
    """Log of a run that failed on leads nobody keeps, was taken up when they
    were repaired, and went on to the features."""
    tables = sources.LeadTables(spark, new_path(spark, "run"))
    good = views.leads(spark, sf_dir)
    sinks.overwrite_table(good.withColumn("DOR_UC", F.lit("900")), tables, "leads")
    first = runs.Run(tables, "TRAIN", as_of_year=views.AS_OF_YEAR)
    try:
        first.through_features()
    except ValueError:
        sinks.overwrite_table(good, tables, "leads")
    again = runs.Run(tables, "TRAIN", as_of_year=views.AS_OF_YEAR)
    again.through_features()
    log = tables.read("pipeline_log").where(F.col("run_id") == first.run_id)
    place = Window.partitionBy("run_id").orderBy("id")  # the stages of one run
    return log.select(
        F.row_number().over(place).alias("step"), "stage", "status", "records_out"
    )


@query
def sink_reset_tables(spark, sf_dir):
    """Rows of the stage tables before and after emptying them."""
    tables = sources.LeadTables(spark, new_path(spark, "reset"))
    sinks.overwrite_table(views.leads(spark, sf_dir), tables, "leads")
    ranked = scoring.rank_leads(views.scores(spark, sf_dir))
    sinks.append_run_scores(ranked, tables, "RUN_A", "PREDICT")

    def sizes() -> dict[str, DataFrame]:
        return {t: tables.read(t) for t in ("leads", "scored_leads", "leads_clean")}

    before = {t: df.count() for t, df in sizes().items()}
    sinks.empty_tables(tables)
    out = None
    for table, df in sizes().items():
        row = df.agg(F.count(F.lit(1)).alias("after")).select(
            F.lit(table).alias("table_name"),
            F.lit(before[table]).cast("bigint").alias("before"), "after",
        )
        out = row if out is None else out.unionByName(row)
    return out


# -- flagship -----------------------------------------------------------------------------------


def hot_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw appraisal tables to the hot leads and why, strongest signals first.

    The joined leads are stored once: cleaning and features read them for
    their statistics and again for the rows."""
    joined = ingest.build_leads(views.source_tables(spark, sf_dir), numbered=False)
    leads = materialize(joined, "leads")
    clean = cleaning.clean_leads(leads, cleaning.fit_cleaning(leads))
    rows = features.engineer(clean, views.AS_OF_YEAR)
    return (
        rows.withColumn("signals", X.signal_score())
        .where("hot_lead = 1")
        .select("Parcel", "OWN_NAME", "PHY_CITY", "JV", "value_tier", "property_age",
                "never_sold", "is_absentee_owner", "is_out_of_state_owner",
                "distressed_sale_history", "signals")
        .orderBy(F.desc("signals"), F.desc("JV"), "Parcel", "OWN_NAME")
    )


QUERIES["etl_hot_leads"] = hot_leads
