"""Fixed values and table layouts of the lead-scoring data model.

Everything in the first block is a fixed value: the results are defined by
these exact lists, codes and cut-offs.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------

# Text that counts as missing in a source file (exact match, untrimmed).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Source tables and the columns read from each.
SOURCE_COLUMNS = {
    "property": ["Parcel", "City_Desc", "NBHD_Code", "Prop_Use_Code"],
    "owners": ["Parcel", "Owner_Mail_Name", "Owner_Mail_Addr1",
               "Owner_Mail_State", "Owner_Mail_Zip"],
    "history": ["Parcel", "Hist_Tax_Year", "Just_Value", "Land_Value",
                "County_Exempt_Amount"],
    "land": ["Parcel", "Land_SqFt"],
    "improvements": ["Parcel", "Imprv_Type", "Actual_YrBlt",
                     "Effective_YrBlt", "Heated_SquareFeet", "Bldg_Num"],
    "sales": ["Parcel", "Sale_Line_Num", "Sale_Date", "Sale_Price",
              "DOR_Qual_Code"],
}
SOURCE_FILES = {
    "property": "Property.txt",
    "owners": "Owners.txt",
    "history": "HistoryRE.txt",
    "land": "Land.txt",
    "improvements": "Improvements.txt",
    "sales": "Sales.txt",
}

# Improvement types that are ownership history, not buildings.
NON_BUILDING_TYPES = ("SOHM", "NSOHM")

# Columns of the leads table, in order.
LEAD_COLUMNS = [
    "OBJECTID", "Parcel", "OWN_NAME", "OWN_ADDR1", "OWN_STATE_", "PHY_ADDR1",
    "PHY_CITY", "PHY_ZIPCD", "JV", "JV_HMSTD", "JV_CHNG", "LND_VAL",
    "LND_SQFOOT", "DOR_UC", "ACT_YR_BLT", "EFF_YR_BLT", "TOT_LVG_AR",
    "NO_BULDNG", "NO_RES_UNT", "SALE_PRC1", "SALE_PRC2", "SALE_YR1",
    "SALE_YR2", "QUAL_CD1", "NBRHD_CD",
]
LEAD_TEXT_COLUMNS = [
    "Parcel", "OWN_NAME", "OWN_ADDR1", "OWN_STATE_", "PHY_ADDR1", "PHY_CITY",
    "DOR_UC", "QUAL_CD1", "NBRHD_CD",
]

RESIDENTIAL_CODES = ("001", "002", "007", "010")
MIN_JUST_VALUE = 1000
FENCE_FACTOR = 1.5
UNKNOWN_CITY = "UNKNOWN"
UNKNOWN_CITY_LIMIT_PCT = 5.0
CITY_SPELLING = {"LACROSSE": "LA CROSSE"}
ZIP_TO_CITY = {
    32601: "GAINESVILLE",
    32602: "GAINESVILLE",
    32603: "GAINESVILLE",
    32604: "GAINESVILLE",
    32605: "GAINESVILLE",
    32606: "GAINESVILLE",
    32607: "GAINESVILLE",
    32608: "GAINESVILLE",
    32609: "GAINESVILLE",
    32610: "GAINESVILLE",
    32611: "GAINESVILLE",
    32612: "GAINESVILLE",
    32615: "ALACHUA",
    32616: "ALACHUA",
    32640: "HAWTHORNE",
    32641: "GAINESVILLE",
    32643: "HIGH SPRINGS",
    32653: "GAINESVILLE",
    32666: "KEYSTONE HEIGHTS",
    32668: "MICANOPY",
    32694: "WALDO",
}

CORPORATE_KEYWORDS = (
    "LLC", "INC", "CORP", "TRUST", "ESTATE", "PROPERTIES", "GROUP",
    "HOLDINGS", "PARTNERS", "INVESTMENTS", "REALTY", "ENTERPRISES", "LTD",
)
HOME_STATE = "FL"
# Upper edge (inclusive) of each value tier, lowest tier first.
VALUE_TIERS = (
    ("distressed", 50_000.0),
    ("entry", 150_000.0),
    ("mid", 300_000.0),
    ("upper", 500_000.0),
    ("premium", float("inf")),
)
OLD_PROPERTY_YEARS = 30
UNDERVALUED_RATIO = 0.8
OVERVALUED_RATIO = 1.2
HOT_LEAD_SIGNALS = 3

# Model inputs, in training order, and the label.
MODEL_COLUMNS = [
    "JV", "JV_HMSTD", "LND_VAL", "LND_SQFOOT", "TOT_LVG_AR", "ACT_YR_BLT",
    "SALE_PRC1", "SALE_YR1", "NO_BULDNG",
]
LABEL_COLUMN = "hot_lead"
TEST_SHARE = 0.20
FOLDS = 5
SEED = 42
TREES = 200
LEARNING_RATE = 0.05
TREE_DEPTH = 4
F1_GATE = 0.65

# Display columns kept beside a score, and the export layout.
DISPLAY_COLUMNS = [
    "OBJECTID", "OWN_NAME", "PHY_ADDR1", "PHY_CITY", "PHY_ZIPCD", "JV",
    "SALE_PRC1", "SALE_YR1",
]
DETAIL_COLUMNS = [
    "OBJECTID", "OWN_NAME", "OWN_ADDR1", "OWN_STATE_", "Parcel", "PHY_CITY",
    "PHY_ZIPCD", "JV", "LND_VAL", "ACT_YR_BLT", "TOT_LVG_AR", "SALE_PRC1",
    "SALE_YR1", "NO_BULDNG", "DOR_UC", "NBRHD_CD",
]
EXPORT_COLUMNS = [
    "rank", "hot_lead_score", "temperature", "OWN_NAME", "Parcel",
    "OWN_STATE_", "PHY_CITY", "PHY_ZIPCD", "JV", "LND_VAL", "ACT_YR_BLT",
    "TOT_LVG_AR", "SALE_PRC1", "SALE_YR1", "NO_BULDNG", "DOR_UC", "NBRHD_CD",
    "OBJECTID",
]
EXPORT_INT_COLUMNS = ["PHY_ZIPCD", "ACT_YR_BLT", "SALE_YR1", "NO_BULDNG"]
HOT_SCORE = 0.8
WARM_SCORE = 0.5

# Stages a run must have completed. Training does not score, scoring does not
# train.
REQUIRED_STAGES = {
    "TRAIN": ["scraper", "cleaner", "features", "model"],
    "PREDICT": ["scraper", "cleaner", "features", "predictor"],
}

# ---------------------------------------------------------------------------
# Table layouts
# ---------------------------------------------------------------------------


def _lead_type(column: str) -> T.DataType:
    if column == "OBJECTID":
        return T.LongType()
    return T.StringType() if column in LEAD_TEXT_COLUMNS else T.DoubleType()


LEADS_SCHEMA = T.StructType(
    [T.StructField(c, _lead_type(c)) for c in LEAD_COLUMNS]
    + [T.StructField("created_at", T.TimestampType())]
)

_CLEAN_TYPES = {
    "PHY_ZIPCD": T.IntegerType(),
    "ACT_YR_BLT": T.IntegerType(),
    "EFF_YR_BLT": T.IntegerType(),
}
CLEAN_SCHEMA = T.StructType(
    [T.StructField(f.name, _CLEAN_TYPES.get(f.name, f.dataType))
     for f in LEADS_SCHEMA.fields]
)

FEATURES_SCHEMA = T.StructType(
    CLEAN_SCHEMA.fields
    + [
        T.StructField("property_age", T.IntegerType()),
        T.StructField("is_corporate_owner", T.IntegerType()),
        T.StructField("is_absentee_owner", T.IntegerType()),
        T.StructField("is_out_of_state_owner", T.IntegerType()),
        T.StructField("price_per_sqft", T.DoubleType()),
        T.StructField("lot_coverage_ratio", T.DoubleType()),
        T.StructField("renovation_gap", T.IntegerType()),
        T.StructField("value_tier", T.StringType()),
        T.StructField("neighborhood_value_ratio", T.DoubleType()),
        T.StructField("distressed_sale_history", T.IntegerType()),
        T.StructField("never_sold", T.IntegerType()),
        T.StructField("value_tier_encoded", T.IntegerType()),
        T.StructField("hot_lead", T.IntegerType()),
    ]
)

SCORES_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("OBJECTID", T.LongType()),
        T.StructField("hot_lead_score", T.DoubleType()),
        T.StructField("rank", T.LongType()),
        T.StructField("pipeline_mode", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

_EXPORT_TYPES = {
    "rank": T.LongType(),
    "hot_lead_score": T.DoubleType(),
    "temperature": T.StringType(),
    "OBJECTID": T.LongType(),
}
EXPORT_SCHEMA = T.StructType(
    [
        T.StructField(
            c,
            _EXPORT_TYPES.get(
                c,
                T.IntegerType() if c in EXPORT_INT_COLUMNS else _lead_type(c),
            ),
        )
        for c in EXPORT_COLUMNS
    ]
)

RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("records_in", T.LongType()),
        T.StructField("records_out", T.LongType()),
        T.StructField("duration_secs", T.DoubleType()),
        T.StructField("pipeline_mode", T.StringType()),
        T.StructField("run_mode", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

# One row per time scores of a run were stored, so that the newest run is found
# without reading scores.
SCORED_RUNS_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

# One row a load: the range and number of the rows it added, and a sketch of the values
# among them that count for the fence.
SKETCHES_SCHEMA = T.StructType(
    [
        T.StructField("first_id", T.LongType()),
        T.StructField("last_id", T.LongType()),
        T.StructField("loaded", T.LongType()),
        T.StructField("sketch", T.BinaryType()),
    ]
)

TABLE_SCHEMAS = {
    "leads": LEADS_SCHEMA,
    "leads_clean": CLEAN_SCHEMA,
    "leads_features": FEATURES_SCHEMA,
    "scored_leads": SCORES_SCHEMA,
    "export_leads": EXPORT_SCHEMA,
    "pipeline_log": RUN_LOG_SCHEMA,
    "scored_runs": SCORED_RUNS_SCHEMA,
    "value_sketches": SKETCHES_SCHEMA,
}

# Columns a stage table is read by: its files are sorted by them.
CLUSTERING = {"leads": ["PHY_CITY", "DOR_UC"]}

# Tables that say something of the rows of another, and go when those are replaced.
DERIVED = {"leads": ["value_sketches"]}
