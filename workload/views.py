"""The six appraisal tables and a run log, projected from the test tables.

Every row of the test tables is used. Conditions on keys only change values
(missing fields, unparsable text, unmatched parcels), never drop rows.
``_ord`` is the row's place in file order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelight.constants import SOURCE_FILES
from parcelight.functions import signal_score
from parcelight.plans import ingest, scoring
from parcelight.plans.cleaning import clean_leads, fit_cleaning
from parcelight.plans.features import engineer
from parcelight.sinks import overwrite_table
from parcelight.sources import LeadTables
from parcelight.storage import new_path

AS_OF_YEAR = 2025


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _every(c: str, n: int, rest: int = 0) -> Column:
    return F.col(c) % n == rest


def _parcel(key: Column, stray: Column) -> Column:
    """No parcel for one key in 97; stray rows get a parcel nobody owns."""
    return (
        F.when(key % 97 == 0, None)
        .when(stray, F.concat(F.lit("X"), key.cast("string")))
        .otherwise(key.cast("string"))
    )


def _registered_parcel(key: Column, stray: Column) -> Column:
    """As above, and every tenth row repeats the parcel before it."""
    return (
        F.when(key % 97 == 0, None)
        .when(stray, F.concat(F.lit("X"), key.cast("string")))
        .when(key % 10 == 9, (key - 1).cast("string"))
        .otherwise(key.cast("string"))
    )


def property_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    codes = {
        "BUILDING": "00100", "HOUSEHOLD": " 00200", "MACHINERY": "00700",
        "FURNITURE": "01000",
    }
    use = F.lit("00400")
    for segment, code in codes.items():
        use = F.when(F.col("c_mktsegment") == segment, code).otherwise(use)
    nation = F.col("c_nationkey").cast("string")
    return c.select(
        _registered_parcel(F.col("c_custkey"), F.lit(False)).alias("Parcel"),
        F.when(_every("c_custkey", 7), None)
        .when(_every("c_custkey", 19), "LaCrosse")
        .otherwise(F.concat(F.lit(" nation_"), nation, F.lit(" ")))
        .alias("City_Desc"),
        F.when(~_every("c_custkey", 3), nation).alias("NBHD_Code"),
        F.when(~_every("c_custkey", 101), use).alias("Prop_Use_Code"),
        F.col("c_custkey").alias("_ord"),
    )


def owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    suffix = (
        F.when(key % 5 == 0, " llc").when(key % 5 == 1, " Trust")
        .when(key % 5 == 2, " Vincent").otherwise("")
    )
    # Some addresses have two lines, which a file holds in a quoted field.
    street = F.when(key % 31 == 5, ' "Main" St\nUnit 7 ').otherwise(" Main St ")
    return c.select(
        _registered_parcel(key, key % 11 == 0).alias("Parcel"),
        F.concat("c_name", suffix).alias("Owner_Mail_Name"),
        F.when(key % 23 != 0, F.concat(key.cast("string"), street))
        .alias("Owner_Mail_Addr1"),
        F.when(key % 13 == 0, None)
        .when(F.col("c_nationkey") % 4 == 0, "GA").otherwise(" FL")
        .alias("Owner_Mail_State"),
        F.when(key % 17 == 0, "bad").when(key % 43 == 5, "1e300-")
        .otherwise(F.concat((F.lit(32600) + key % 100).cast("string"), F.lit("-1234")))
        .alias("Owner_Mail_Zip"),
        key.alias("_ord"),
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    value = (
        F.when(key % 17 == 0, price / 1000.0).when(key % 40 == 0, price * 10.0)
        .otherwise(price)
    )
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return o.select(
        _parcel(F.col("o_custkey"), F.lit(False)).alias("Parcel"),
        F.when(key % 31 == 0, "unknown")
        .otherwise(F.year("o_orderdate").cast("string")).alias("Hist_Tax_Year"),
        F.when(key % 53 == 0, "n.a.").otherwise(value.cast("string"))
        .alias("Just_Value"),
        (price * 0.2).cast("string").alias("Land_Value"),
        F.when(urgent, "0").otherwise("50000").alias("County_Exempt_Amount"),
        key.alias("_ord"),
    )


def _line_order() -> Column:
    return F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")


def land(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    area = (F.col("l_quantity") * 100.0).cast("string")
    return li.select(
        _parcel(F.col("l_partkey"), _every("l_partkey", 21)).alias("Parcel"),
        F.when(_every("l_suppkey", 23), "n/k").otherwise(area).alias("Land_SqFt"),
        _line_order().alias("_ord"),
    )


def improvements(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").withColumn("_shipped", F.year("l_shipdate"))
    flag = F.col("l_returnflag")
    kind = (
        F.when(flag == "R", "SOHM ").when(_every("l_suppkey", 19), "NSOHM")
        .when(_every("l_suppkey", 10, 7), None).otherwise(flag)
    )
    shipped = F.col("_shipped")
    built = shipped - F.floor(F.col("l_quantity") / 3).cast("int")
    area = F.floor(F.col("l_extendedprice") / 20.0)
    return li.select(
        _parcel(F.col("l_partkey"), _every("l_partkey", 17)).alias("Parcel"),
        kind.alias("Imprv_Type"),
        F.when(_every("l_orderkey", 9), "0").otherwise(built.cast("string"))
        .alias("Actual_YrBlt"),
        F.when(_every("l_orderkey", 6), "0").otherwise(shipped.cast("string"))
        .alias("Effective_YrBlt"),
        F.when(_every("l_partkey", 13), "0").otherwise(area.cast("string"))
        .alias("Heated_SquareFeet"),
        F.when(_every("l_suppkey", 29), None)
        .otherwise(F.col("l_linenumber").cast("string")).alias("Bldg_Num"),
        _line_order().alias("_ord"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    code = (
        F.when(key % 43 == 0, None).when(key % 59 == 0, "U")
        .when(status == "F", "U-UNQUALIFIED")
        .when((status == "P") & (key % 2 == 0), " u-unverified ")
        .otherwise("Q-QUALIFIED")
    )
    return o.select(
        _parcel(F.col("o_custkey"), _every("o_custkey", 8)).alias("Parcel"),
        F.when(key % 29 == 0, "x").otherwise((key % 4).cast("string"))
        .alias("Sale_Line_Num"),
        F.when(key % 37 != 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("Sale_Date"),
        F.when(key % 3 == 0, "0").when(key % 41 == 0, "bad")
        .otherwise(F.col("o_totalprice").cast("string")).alias("Sale_Price"),
        code.alias("DOR_Qual_Code"),
        key.alias("_ord"),
    )


SOURCES = {
    "property": property_rows,
    "owners": owners,
    "history": history,
    "land": land,
    "improvements": improvements,
    "sales": sales,
}


def source_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: view(spark, sf_dir) for name, view in SOURCES.items()}


# -- source files ------------------------------------------------------------------

_folders: dict[tuple[str, str], str] = {}
_files: set[str] = set()


def write_tsv(df: DataFrame, path: str) -> None:
    """A source table as tab-separated files in row order, missing as NA."""
    (
        df.orderBy("_ord").drop("_ord").write.option("sep", "\t")
        .option("header", True).option("nullValue", "NA").option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False).csv(path)
    )


def source_file(spark: SparkSession, sf_dir: str, table: str) -> str:
    """A table as tab-separated files, written on first use and kept for the
    session, in a folder for all six."""
    key = (spark.conf.get("spark.app.id"), sf_dir)
    if key not in _folders:
        _folders[key] = new_path(spark, "county")
    path = f"{_folders[key]}/{SOURCE_FILES[table]}"
    if path not in _files:
        rows = SOURCES[table](spark, sf_dir)
        write_tsv(rows.withColumn("Remark", F.lit("not read")), path)
        _files.add(path)
    return path


def source_folder(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the six tables, all of them written."""
    paths = [source_file(spark, sf_dir, table) for table in SOURCES]
    return paths[0].rpartition("/")[0]


# -- stage tables -----------------------------------------------------------------

_stages: dict[tuple[str, str, str], LeadTables] = {}


def _build(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    if table == "leads":
        return ingest.build_leads(source_tables(spark, sf_dir))
    if table == "leads_clean":
        stored = stage(spark, sf_dir, "leads")
        return clean_leads(stored, fit_cleaning(stored))
    return engineer(stage(spark, sf_dir, "leads_clean"), AS_OF_YEAR)


def tables(spark: SparkSession, sf_dir: str, table: str) -> LeadTables:
    """Storage holding a stage table: built from the test tables on first use
    and kept for the session, as each stage of a run stores its result."""
    key = (spark.conf.get("spark.app.id"), sf_dir, table)
    if key not in _stages:
        stored = LeadTables(spark, new_path(spark, "stages"))
        overwrite_table(_build(spark, sf_dir, table), stored, table)
        _stages[key] = stored
    return _stages[key]


def stage(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return tables(spark, sf_dir, table).read(table)


def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(spark, sf_dir, "leads")


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(spark, sf_dir, "leads_clean")


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(spark, sf_dir, "leads_features")


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features with a deterministic score in place of a model's."""
    return features(spark, sf_dir).withColumn(
        "hot_lead_score", signal_score() / F.lit(7.0)
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features with a rule as the prediction, for the metric queries. It uses
    model columns only and errs both ways."""
    cheap = (F.col("JV_HMSTD") == 0) & (F.col("JV") < 150_000)
    return features(spark, sf_dir).withColumn(
        "prediction", (cheap | (F.col("SALE_PRC1") == 0)).cast("int")
    )


_trainings: dict[tuple[str, str], scoring.Training] = {}


def training(spark: SparkSession, sf_dir: str) -> scoring.Training:
    """A training with the default parameters, stored model and all; made on
    first use and kept for the session."""
    key = (spark.conf.get("spark.app.id"), sf_dir)
    if key not in _trainings:
        path = new_path(spark, "model")
        _trainings[key] = scoring.train(features(spark, sf_dir), path)
    return _trainings[key]


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log rows from the event stream: one run per user, whole minutes, so
    several rows of a run may share a time."""
    e = read(spark, sf_dir, "events")
    key = F.col("event_id")
    stages = ["scraper", "cleaner", "features", "model", "predictor", "export"]
    stage = F.element_at(
        F.array(*[F.lit(s) for s in stages]), (key % len(stages) + 1).cast("int")
    )
    failed = F.col("event_type") == "error"
    return e.select(
        key.alias("id"),
        F.concat(F.lit("RUN_"), F.lpad(F.col("user_id").cast("string"), 6, "0"))
        .alias("run_id"),
        stage.alias("stage"),
        F.when(failed, "failed").otherwise("completed").alias("status"),
        (key * 3).alias("records_in"),
        (key * 2).alias("records_out"),
        F.col("value").alias("duration_secs"),
        F.when(failed, F.concat(F.lit("stage stopped at "), key.cast("string")))
        .alias("error_message"),
        F.date_format(F.date_trunc("minute", F.col("ts")), "yyyy-MM-dd HH:mm:ss")
        .alias("created_at"),
    )
