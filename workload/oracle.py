"""The expected result of each query as SQL over the test tables.

Written against the raw tables only: every statement carries the views and
stages it needs as common table expressions.
"""

from __future__ import annotations

NUMBER = r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"
AS_OF_YEAR = 2025
KEYWORDS = (
    "LLC|INC|CORP|TRUST|ESTATE|PROPERTIES|GROUP|HOLDINGS|PARTNERS|INVESTMENTS"
    "|REALTY|ENTERPRISES|LTD"
)
LEAD_COLUMNS = (
    "OBJECTID, Parcel, OWN_NAME, OWN_ADDR1, OWN_STATE_, PHY_ADDR1, PHY_CITY, "
    "PHY_ZIPCD, JV, JV_HMSTD, JV_CHNG, LND_VAL, LND_SQFOOT, DOR_UC, ACT_YR_BLT, "
    "EFF_YR_BLT, TOT_LVG_AR, NO_BULDNG, NO_RES_UNT, SALE_PRC1, SALE_PRC2, "
    "SALE_YR1, SALE_YR2, QUAL_CD1, NBRHD_CD"
)


def num(x: str) -> str:
    return (
        f"CASE WHEN regexp_full_match(trim({x}), '{NUMBER}') "
        f"THEN TRY_CAST(trim({x}) AS DOUBLE) END"
    )


def num0(x: str) -> str:
    return f"coalesce({num(x)}, 0.0::DOUBLE)"


def parcel(key: str, stray: str = "FALSE", repeats: bool = False) -> str:
    repeat = f"WHEN {key} % 10 = 9 THEN CAST({key} - 1 AS VARCHAR)" if repeats else ""
    return (
        f"CASE WHEN {key} % 97 = 0 THEN NULL "
        f"WHEN {stray} THEN 'X' || CAST({key} AS VARCHAR) {repeat} "
        f"ELSE CAST({key} AS VARCHAR) END"
    )


LINE_ORDER = "l_orderkey, l_linenumber, l_suppkey, l_extendedprice"

# Name -> (names it builds on, body). Order matters.
CTES: dict[str, tuple[list[str], str]] = {
    "property_rows": ([], f"""
        SELECT {parcel('c_custkey', repeats=True)} AS Parcel,
               CASE WHEN c_custkey % 7 = 0 THEN NULL
                    WHEN c_custkey % 19 = 0 THEN 'LaCrosse'
                    ELSE ' nation_' || CAST(c_nationkey AS VARCHAR) || ' ' END AS City_Desc,
               CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_nationkey AS VARCHAR) END AS NBHD_Code,
               CASE WHEN c_custkey % 101 = 0 THEN NULL
                    WHEN c_mktsegment = 'BUILDING' THEN '00100'
                    WHEN c_mktsegment = 'HOUSEHOLD' THEN ' 00200'
                    WHEN c_mktsegment = 'MACHINERY' THEN '00700'
                    WHEN c_mktsegment = 'FURNITURE' THEN '01000'
                    ELSE '00400' END AS Prop_Use_Code,
               c_custkey AS ord
        FROM customer"""),
    "owner_rows": ([], f"""
        SELECT {parcel('c_custkey', 'c_custkey % 11 = 0', repeats=True)} AS Parcel,
               c_name || CASE c_custkey % 5 WHEN 0 THEN ' llc' WHEN 1 THEN ' Trust'
                              WHEN 2 THEN ' Vincent' ELSE '' END AS Owner_Mail_Name,
               CASE WHEN c_custkey % 23 <> 0
                    THEN CAST(c_custkey AS VARCHAR) || CASE WHEN c_custkey % 31 = 5
                      THEN ' "Main" St' || chr(10) || 'Unit 7 ' ELSE ' Main St ' END
                    END AS Owner_Mail_Addr1,
               CASE WHEN c_custkey % 13 = 0 THEN NULL
                    WHEN c_nationkey % 4 = 0 THEN 'GA' ELSE ' FL' END AS Owner_Mail_State,
               CASE WHEN c_custkey % 17 = 0 THEN 'bad' WHEN c_custkey % 43 = 5 THEN '1e300-'
                    ELSE CAST(32600 + c_custkey % 100 AS VARCHAR) || '-1234' END AS Owner_Mail_Zip,
               c_custkey AS ord
        FROM customer"""),
    "history_rows": ([], f"""
        SELECT {parcel('o_custkey')} AS Parcel,
               CASE WHEN o_orderkey % 31 = 0 THEN 'unknown'
                    ELSE CAST(year(o_orderdate) AS VARCHAR) END AS Hist_Tax_Year,
               CASE WHEN o_orderkey % 53 = 0 THEN 'n.a.'
                    WHEN o_orderkey % 17 = 0 THEN CAST(o_totalprice / 1000.0::DOUBLE AS VARCHAR)
                    WHEN o_orderkey % 40 = 0 THEN CAST(o_totalprice * 10.0::DOUBLE AS VARCHAR)
                    ELSE CAST(o_totalprice AS VARCHAR) END AS Just_Value,
               CAST(o_totalprice * 0.2::DOUBLE AS VARCHAR) AS Land_Value,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN '0'
                    ELSE '50000' END AS County_Exempt_Amount,
               o_orderkey AS ord
        FROM orders"""),
    "land_rows": ([], f"""
        SELECT {parcel('l_partkey', 'l_partkey % 21 = 0')} AS Parcel,
               CASE WHEN l_suppkey % 23 = 0 THEN 'n/k'
                    ELSE CAST(l_quantity * 100 AS VARCHAR) END AS Land_SqFt
        FROM lineitem"""),
    "improvement_rows": ([], f"""
        SELECT {parcel('l_partkey', 'l_partkey % 17 = 0')} AS Parcel,
               CASE WHEN l_returnflag = 'R' THEN 'SOHM ' WHEN l_suppkey % 19 = 0 THEN 'NSOHM'
                    WHEN l_suppkey % 10 = 7 THEN NULL ELSE l_returnflag END AS Imprv_Type,
               CASE WHEN l_orderkey % 9 = 0 THEN '0'
                    ELSE CAST(year(l_shipdate) - CAST(floor(l_quantity / 3) AS INTEGER) AS VARCHAR)
                    END AS Actual_YrBlt,
               CASE WHEN l_orderkey % 6 = 0 THEN '0'
                    ELSE CAST(year(l_shipdate) AS VARCHAR) END AS Effective_YrBlt,
               CASE WHEN l_partkey % 13 = 0 THEN '0'
                    ELSE CAST(CAST(floor(l_extendedprice / 20) AS BIGINT) AS VARCHAR)
                    END AS Heated_SquareFeet,
               CASE WHEN l_suppkey % 29 <> 0 THEN CAST(l_linenumber AS VARCHAR) END AS Bldg_Num,
               {LINE_ORDER}
        FROM lineitem"""),
    "sale_rows": ([], f"""
        SELECT {parcel('o_custkey', 'o_custkey % 8 = 0')} AS Parcel,
               CASE WHEN o_orderkey % 29 = 0 THEN 'x'
                    ELSE CAST(o_orderkey % 4 AS VARCHAR) END AS Sale_Line_Num,
               CASE WHEN o_orderkey % 37 <> 0
                    THEN strftime(o_orderdate, '%Y-%m-%d') END AS Sale_Date,
               CASE WHEN o_orderkey % 3 = 0 THEN '0' WHEN o_orderkey % 41 = 0 THEN 'bad'
                    ELSE CAST(o_totalprice AS VARCHAR) END AS Sale_Price,
               CASE WHEN o_orderkey % 43 = 0 THEN NULL WHEN o_orderkey % 59 = 0 THEN 'U'
                    WHEN o_orderstatus = 'F' THEN 'U-UNQUALIFIED'
                    WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN ' u-unverified '
                    ELSE 'Q-QUALIFIED' END AS DOR_Qual_Code,
               o_orderkey AS ord
        FROM orders"""),
    "prop": (["property_rows"], """
        SELECT Parcel, substr(trim(coalesce(Prop_Use_Code, 'nan')), 1, 3) AS DOR_UC,
               upper(trim(coalesce(City_Desc, 'nan'))) AS PHY_CITY,
               trim(coalesce(NBHD_Code, 'nan')) AS NBRHD_CD, ord
        FROM property_rows
        QUALIFY row_number() OVER (PARTITION BY Parcel ORDER BY ord) = 1"""),
    "own": (["owner_rows"], f"""
        SELECT Parcel, trim(coalesce(Owner_Mail_Name, 'nan')) AS OWN_NAME,
               trim(coalesce(Owner_Mail_Addr1, 'nan')) AS OWN_ADDR1,
               trim(coalesce(Owner_Mail_State, 'nan')) AS OWN_STATE_,
               {num0('substr(Owner_Mail_Zip, 1, 5)')} AS PHY_ZIPCD
        FROM owner_rows
        QUALIFY row_number() OVER (PARTITION BY Parcel ORDER BY ord) = 1"""),
    "hist": (["history_rows"], f"""
        SELECT Parcel, {num0('Just_Value')} AS JV, {num0('Land_Value')} AS LND_VAL,
               {num0('County_Exempt_Amount')} AS JV_HMSTD, 0.0::DOUBLE AS JV_CHNG
        FROM history_rows
        QUALIFY row_number() OVER (
            PARTITION BY Parcel ORDER BY {num('Hist_Tax_Year')} DESC NULLS LAST, ord) = 1"""),
    "lnd": (["land_rows"], f"""
        SELECT Parcel, sum({num0('Land_SqFt')}) AS LND_SQFOOT
        FROM land_rows WHERE Parcel IS NOT NULL GROUP BY Parcel"""),
    "imprv": (["improvement_rows"], f"""
        SELECT Parcel, ACT_YR_BLT, EFF_YR_BLT, TOT_LVG_AR, NO_BULDNG, NO_BULDNG AS NO_RES_UNT
        FROM (SELECT Parcel, {num0('Actual_YrBlt')} AS ACT_YR_BLT,
                     {num0('Effective_YrBlt')} AS EFF_YR_BLT,
                     {num0('Heated_SquareFeet')} AS TOT_LVG_AR,
                     {LINE_ORDER}
              FROM improvement_rows
              WHERE Parcel IS NOT NULL
                AND (Imprv_Type IS NULL OR trim(Imprv_Type) NOT IN ('SOHM', 'NSOHM'))
              QUALIFY row_number() OVER (
                  PARTITION BY Parcel ORDER BY {num0('Heated_SquareFeet')} DESC, {LINE_ORDER}) = 1)
        JOIN (SELECT Parcel, CAST(count(DISTINCT Bldg_Num) AS INTEGER) AS NO_BULDNG
              FROM improvement_rows
              WHERE Parcel IS NOT NULL
                AND (Imprv_Type IS NULL OR trim(Imprv_Type) NOT IN ('SOHM', 'NSOHM'))
              GROUP BY Parcel) USING (Parcel)"""),
    "sale_lines": (["sale_rows"], f"""
        SELECT Parcel, {num('Sale_Line_Num')} AS line, {num0('Sale_Price')} AS price,
               {num0('substr(Sale_Date, 1, 4)')} AS yr, coalesce(DOR_Qual_Code, '') AS code
        FROM sale_rows
        QUALIFY row_number() OVER (
            PARTITION BY Parcel, {num('Sale_Line_Num')} ORDER BY ord) = 1"""),
    "sale": (["sale_lines"], """
        SELECT a.Parcel, a.price AS SALE_PRC1, a.yr AS SALE_YR1, a.code AS QUAL_CD1,
               coalesce(b.price, 0.0::DOUBLE) AS SALE_PRC2, coalesce(b.yr, 0.0::DOUBLE) AS SALE_YR2
        FROM (SELECT * FROM sale_lines WHERE line = 0) a
        LEFT JOIN (SELECT * FROM sale_lines WHERE line = 1) b
               ON a.Parcel IS NOT DISTINCT FROM b.Parcel"""),
    "leads": (["prop", "own", "hist", "lnd", "imprv", "sale"], """
        SELECT row_number() OVER (ORDER BY prop.ord) AS OBJECTID, prop.Parcel AS Parcel,
               coalesce(OWN_NAME, '') AS OWN_NAME, coalesce(OWN_ADDR1, '') AS OWN_ADDR1,
               coalesce(OWN_STATE_, '') AS OWN_STATE_, coalesce(OWN_ADDR1, '') AS PHY_ADDR1,
               coalesce(PHY_CITY, '') AS PHY_CITY, coalesce(PHY_ZIPCD, 0)::DOUBLE AS PHY_ZIPCD,
               coalesce(JV, 0)::DOUBLE AS JV, coalesce(JV_HMSTD, 0)::DOUBLE AS JV_HMSTD,
               coalesce(JV_CHNG, 0)::DOUBLE AS JV_CHNG, coalesce(LND_VAL, 0)::DOUBLE AS LND_VAL,
               coalesce(LND_SQFOOT, 0)::DOUBLE AS LND_SQFOOT, coalesce(DOR_UC, '') AS DOR_UC,
               coalesce(ACT_YR_BLT, 0)::DOUBLE AS ACT_YR_BLT,
               coalesce(EFF_YR_BLT, 0)::DOUBLE AS EFF_YR_BLT,
               coalesce(TOT_LVG_AR, 0)::DOUBLE AS TOT_LVG_AR,
               coalesce(NO_BULDNG, 0)::DOUBLE AS NO_BULDNG,
               coalesce(NO_RES_UNT, 0)::DOUBLE AS NO_RES_UNT,
               coalesce(SALE_PRC1, 0)::DOUBLE AS SALE_PRC1, coalesce(SALE_PRC2, 0)::DOUBLE AS SALE_PRC2,
               coalesce(SALE_YR1, 0)::DOUBLE AS SALE_YR1, coalesce(SALE_YR2, 0)::DOUBLE AS SALE_YR2,
               coalesce(QUAL_CD1, '') AS QUAL_CD1, coalesce(NBRHD_CD, '') AS NBRHD_CD
        FROM prop
        LEFT JOIN own ON prop.Parcel IS NOT DISTINCT FROM own.Parcel
        LEFT JOIN hist ON prop.Parcel IS NOT DISTINCT FROM hist.Parcel
        LEFT JOIN lnd ON prop.Parcel IS NOT DISTINCT FROM lnd.Parcel
        LEFT JOIN imprv ON prop.Parcel IS NOT DISTINCT FROM imprv.Parcel
        LEFT JOIN sale ON prop.Parcel IS NOT DISTINCT FROM sale.Parcel"""),
    "padded": (["leads"], """
        SELECT * REPLACE (CASE WHEN length(trim(DOR_UC)) < 3 THEN lpad(trim(DOR_UC), 3, '0')
                               ELSE trim(DOR_UC) END AS DOR_UC)
        FROM leads"""),
    "valued": (["padded"], """
        SELECT * FROM padded WHERE DOR_UC IN ('001', '002', '007', '010') AND JV >= 1000"""),
    "fence": (["valued"], """
        SELECT quantile_cont(JV, 0.25) AS q1, quantile_cont(JV, 0.75) AS q3,
               quantile_cont(JV, 0.75)
               + 1.5 * (quantile_cont(JV, 0.75) - quantile_cont(JV, 0.25)) AS upper_bound
        FROM valued"""),
    "kept": (["valued", "fence"], """
        SELECT * FROM valued WHERE JV <= (SELECT upper_bound FROM fence)"""),
    "spelled": (["kept"], """
        SELECT * REPLACE (CASE upper(trim(PHY_CITY)) WHEN 'NAN' THEN ''
                               WHEN 'LACROSSE' THEN 'LA CROSSE'
                               ELSE upper(trim(PHY_CITY)) END AS PHY_CITY)
        FROM kept"""),
    "zips": ([], """
        SELECT * FROM (VALUES
            (32601, 'GAINESVILLE'), (32602, 'GAINESVILLE'), (32603, 'GAINESVILLE'),
            (32604, 'GAINESVILLE'), (32605, 'GAINESVILLE'), (32606, 'GAINESVILLE'),
            (32607, 'GAINESVILLE'), (32608, 'GAINESVILLE'), (32609, 'GAINESVILLE'),
            (32610, 'GAINESVILLE'), (32611, 'GAINESVILLE'), (32612, 'GAINESVILLE'),
            (32615, 'ALACHUA'), (32616, 'ALACHUA'), (32640, 'HAWTHORNE'),
            (32641, 'GAINESVILLE'), (32643, 'HIGH SPRINGS'), (32653, 'GAINESVILLE'),
            (32666, 'KEYSTONE HEIGHTS'), (32668, 'MICANOPY'), (32694, 'WALDO')
        ) AS z(zip, city)"""),
    "placed": (["spelled", "zips"], """
        SELECT s.* REPLACE (
                   CASE WHEN PHY_CITY = '' THEN coalesce(z.city, 'UNKNOWN') ELSE PHY_CITY END AS PHY_CITY,
                   coalesce(TRY_CAST(trunc(PHY_ZIPCD) AS INTEGER), 0) AS PHY_ZIPCD),
               s.PHY_CITY = '' AS was_blank
        FROM spelled s LEFT JOIN zips z ON z.zip = trunc(s.PHY_ZIPCD)"""),
    "medians": (["placed"], """
        SELECT DOR_UC, quantile_cont(ACT_YR_BLT, 0.5) AS code_year
        FROM placed WHERE ACT_YR_BLT > 0 GROUP BY DOR_UC"""),
    "dated": (["placed", "medians"], """
        SELECT p.* REPLACE (
                   CAST(trunc(CASE WHEN ACT_YR_BLT = 0 THEN coalesce(m.code_year,
                       trunc((SELECT quantile_cont(ACT_YR_BLT, 0.5) FROM placed WHERE ACT_YR_BLT > 0)))
                       ELSE ACT_YR_BLT END) AS INTEGER) AS ACT_YR_BLT),
               p.ACT_YR_BLT = 0 AS was_act0, p.EFF_YR_BLT = 0 AS was_eff0,
               p.TOT_LVG_AR = 0 AS was_area0
        FROM placed p LEFT JOIN medians m USING (DOR_UC)"""),
    "repaired": (["dated"], """
        SELECT * REPLACE (
                   CAST(trunc(CASE WHEN EFF_YR_BLT = 0 THEN ACT_YR_BLT ELSE EFF_YR_BLT END) AS INTEGER)
                       AS EFF_YR_BLT,
                   nullif(TOT_LVG_AR, 0) AS TOT_LVG_AR)
        FROM dated"""),
    "clean": (["repaired"], f"SELECT {LEAD_COLUMNS} FROM repaired"),
    "nbhd": (["clean"], """
        SELECT NBRHD_CD, avg(JV) AS mean_jv FROM clean GROUP BY NBRHD_CD"""),
    "rated": (["clean", "nbhd"], f"""
        SELECT c.*, greatest(0, {AS_OF_YEAR} - ACT_YR_BLT) AS property_age,
               CAST(regexp_matches(upper(OWN_NAME), '{KEYWORDS}') AS INTEGER) AS is_corporate_owner,
               CAST(JV_HMSTD = 0 AS INTEGER) AS is_absentee_owner,
               CAST(trim(OWN_STATE_) NOT IN ('FL', '') AS INTEGER) AS is_out_of_state_owner,
               coalesce(JV / TOT_LVG_AR, 0) AS price_per_sqft,
               coalesce(TOT_LVG_AR / nullif(LND_SQFOOT, 0), 0) AS lot_coverage_ratio,
               EFF_YR_BLT - ACT_YR_BLT AS renovation_gap,
               CASE WHEN JV <= 0 THEN NULL WHEN JV <= 50000 THEN 'distressed'
                    WHEN JV <= 150000 THEN 'entry' WHEN JV <= 300000 THEN 'mid'
                    WHEN JV <= 500000 THEN 'upper' ELSE 'premium' END AS value_tier,
               coalesce(JV / nullif(mean_jv, 0), 1.0) AS neighborhood_value_ratio,
               CAST(starts_with(upper(trim(QUAL_CD1)), 'U') AS INTEGER) AS distressed_sale_history,
               CAST(SALE_PRC1 = 0 AS INTEGER) AS never_sold,
               CASE WHEN JV <= 50000 THEN 0 WHEN JV <= 150000 THEN 1 WHEN JV <= 300000 THEN 2
                    WHEN JV <= 500000 THEN 3 ELSE 4 END AS value_tier_encoded
        FROM clean c LEFT JOIN nbhd USING (NBRHD_CD)"""),
    "signalled": (["rated"], """
        SELECT *, never_sold + is_absentee_owner + is_out_of_state_owner
                  + CAST(property_age > 30 AS INTEGER)
                  + CAST(value_tier IN ('distressed', 'entry') AS INTEGER)
                  + CAST(neighborhood_value_ratio < 0.8 AS INTEGER)
                  + distressed_sale_history AS signals
        FROM rated"""),
    "features": (["signalled"], """
        SELECT * REPLACE (coalesce(TOT_LVG_AR, 0) AS TOT_LVG_AR),
               CAST(signals >= 3 AS INTEGER) AS hot_lead
        FROM signalled"""),
    "scores": (["features"], """
        SELECT *, signals / 7.0::DOUBLE AS hot_lead_score, CAST((JV_HMSTD = 0 AND JV < 150000) OR SALE_PRC1 = 0 AS INTEGER) AS prediction,
               row_number() OVER (ORDER BY signals DESC, OBJECTID) AS rank
        FROM features"""),
    "hashed": (["scores"], """
        SELECT *, (((OBJECTID + 42) % 2147483648) * 2654435761) % 4294967296 AS h
        FROM scores"""),
    "stratified": (["hashed"], """
        SELECT *, row_number() OVER (PARTITION BY hot_lead ORDER BY h, OBJECTID) - 1 AS place,
               count(*) OVER (PARTITION BY hot_lead) AS size
        FROM hashed"""),
    "split": (["stratified"], """
        SELECT *, place < floor(size * 0.2::DOUBLE + 0.5) AS is_test FROM stratified"""),
    "folded": (["stratified"], """
        SELECT * EXCLUDE (place, size), CAST(place * 5 // size + 1 AS INTEGER) AS fold
        FROM stratified"""),
    "confusion": (["folded"], """
        SELECT fold, count(*) FILTER (hot_lead = 1 AND prediction = 1) AS tp,
               count(*) FILTER (hot_lead = 0 AND prediction = 1) AS fp,
               count(*) FILTER (hot_lead = 1 AND prediction = 0) AS fn,
               count(*) FILTER (hot_lead = 0 AND prediction = 0) AS tn
        FROM folded GROUP BY fold"""),
    "worst": (["confusion"], """
        SELECT fold FROM confusion ORDER BY CASE WHEN 2 * tp + fp + fn = 0 THEN 0
            ELSE 2 * tp / (2 * tp + fp + fn)::DOUBLE END, fold LIMIT 1"""),
    "wrong": (["folded", "worst"], """
        SELECT *, CASE WHEN hot_lead = 1 THEN 'missed' ELSE 'false alarm' END AS outcome
        FROM folded WHERE hot_lead <> prediction AND fold = (SELECT fold FROM worst)"""),
    "run_log": ([], """
        SELECT event_id AS id, 'RUN_' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS run_id,
               CASE event_id % 6 WHEN 0 THEN 'scraper' WHEN 1 THEN 'cleaner' WHEN 2 THEN 'features'
                    WHEN 3 THEN 'model' WHEN 4 THEN 'predictor' ELSE 'export' END AS stage,
               CASE WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END AS status,
               event_id * 3 AS records_in, event_id * 2 AS records_out, value AS duration_secs,
               CASE WHEN event_type = 'error'
                    THEN 'stage stopped at ' || CAST(event_id AS VARCHAR) END AS error_message,
               strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS created_at
        FROM events"""),
    "statuses": (["run_log"], """
        SELECT run_id, stage, status FROM run_log
        QUALIFY row_number() OVER (PARTITION BY run_id, stage ORDER BY created_at DESC, id DESC) = 1"""),
}


def _needed(names: list[str]) -> list[str]:
    wanted: set[str] = set()

    def visit(name: str) -> None:
        if name not in wanted:
            wanted.add(name)
            for other in CTES[name][0]:
                visit(other)

    for name in names:
        visit(name)
    return [name for name in CTES if name in wanted]


def with_ctes(names: str, select: str) -> str:
    parts = ",\n".join(
        f"{n} AS ({CTES[n][1]})" for n in _needed(names.split())
    )
    return f"WITH {parts}\n{select}"


DETAILS = (
    "OWN_NAME, OWN_ADDR1, OWN_STATE_, Parcel, PHY_CITY, PHY_ZIPCD, JV, LND_VAL, "
    "ACT_YR_BLT, TOT_LVG_AR, SALE_PRC1, SALE_YR1, NO_BULDNG, DOR_UC, NBRHD_CD"
)
FEATURE_NAMES = (
    "property_age, is_corporate_owner, is_absentee_owner, is_out_of_state_owner, "
    "price_per_sqft, lot_coverage_ratio, renovation_gap, value_tier, "
    "round(neighborhood_value_ratio, 6) AS neighborhood_value_ratio, "
    "distressed_sale_history, never_sold, value_tier_encoded, hot_lead"
)
TEMPERATURE = (
    "CASE WHEN hot_lead_score >= 0.8 THEN 'HOT' WHEN hot_lead_score >= 0.5 "
    "THEN 'WARM' ELSE 'COLD' END"
)
EXPORT = f"""
    SELECT s.rank AS rank, s.hot_lead_score AS hot_lead_score,
           {TEMPERATURE.replace('hot_lead_score', 's.hot_lead_score')} AS temperature,
           l.OWN_NAME AS OWN_NAME, l.Parcel AS Parcel, l.OWN_STATE_ AS OWN_STATE_,
           l.PHY_CITY AS PHY_CITY, coalesce(TRY_CAST(trunc(l.PHY_ZIPCD) AS INTEGER), 0) AS PHY_ZIPCD,
           l.JV AS JV, l.LND_VAL AS LND_VAL, CAST(trunc(l.ACT_YR_BLT) AS INTEGER) AS ACT_YR_BLT,
           l.TOT_LVG_AR AS TOT_LVG_AR, l.SALE_PRC1 AS SALE_PRC1,
           CAST(trunc(l.SALE_YR1) AS INTEGER) AS SALE_YR1,
           CAST(trunc(l.NO_BULDNG) AS INTEGER) AS NO_BULDNG, l.DOR_UC AS DOR_UC,
           l.NBRHD_CD AS NBRHD_CD, s.OBJECTID AS OBJECTID
    FROM scores s LEFT JOIN leads l ON s.OBJECTID = l.OBJECTID"""


def _counts(table: str, checks: dict[str, str], label: str, value: str) -> str:
    """One (label, value) row per check."""
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS {label}, count(*) FILTER ({check}) AS {value} FROM {table}"
        for name, check in checks.items()
    )


def _top(table: str, column: str, n: int | None, value: str = "value") -> str:
    limit = f" LIMIT {n}" if n else ""
    return (
        f"SELECT * FROM (SELECT '{column}' AS \"column\", {column} AS {value}, "
        f"count(*) AS n FROM {table} WHERE {column} IS NOT NULL GROUP BY {column} "
        f"ORDER BY n DESC, {column}{limit})"
    )


def _flags() -> str:
    flags = [
        "is_corporate_owner", "is_absentee_owner", "is_out_of_state_owner",
        "distressed_sale_history", "never_sold", "hot_lead",
    ]
    return "\nUNION ALL ".join(
        f"SELECT '{f}' AS flag, CAST(sum({f}) AS BIGINT) AS ones, "
        f"count(*) - CAST(sum({f}) AS BIGINT) AS zeros, "
        f"round(sum({f}) * 100.0::DOUBLE / count(*), 4) AS pct FROM features"
        for f in flags
    )


def _nulls_and_zeros(table: str = "clean") -> str:
    parts = []
    for c in ("JV", "ACT_YR_BLT", "EFF_YR_BLT", "TOT_LVG_AR", "SALE_PRC1",
              "SALE_PRC2", "LND_SQFOOT", "NO_BULDNG", "JV_HMSTD"):
        parts.append((c, "zeros", f"{c} = 0"))
    for c in ("PHY_CITY", "OWN_NAME", "OWN_STATE_", "QUAL_CD1", "NBRHD_CD"):
        parts.append((c, "empty", f"trim({c}) = ''"))
    for c in LEAD_COLUMNS.split(", "):
        parts.append((c, "nulls", f"{c} IS NULL"))
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{k}' AS \"check\", count(*) FILTER ({e}) AS n FROM {table}"
        for c, k, e in parts
    )


def _describe(table: str, columns: dict[str, float]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (v IS NULL) AS nulls, "
        f"count(*) FILTER (v = 0) AS zeros, count(*) FILTER (v < {below}) AS below, "
        "round(min(v) FILTER (v > 0), 4) AS min_positive, "
        "round(min(v), 4) AS min, round(max(v), 4) AS max, "
        "round(avg(v), 4) AS mean, round(quantile_cont(v, 0.5), 4) AS median "
        f"FROM (SELECT CAST({c} AS DOUBLE) AS v FROM {table})"
        for c, below in columns.items()
    )


LATEST_VALUES = f"""latest AS (
    SELECT {num('Just_Value')} AS Just_Value, {num('Land_Value')} AS Land_Value
    FROM history_rows WHERE Parcel IS NOT NULL
    QUALIFY row_number() OVER (
        PARTITION BY Parcel ORDER BY {num('Hist_Tax_Year')} DESC NULLS LAST, ord) = 1)"""


def _coverage() -> str:
    names = {"owners": "owner_rows", "history": "history_rows", "land": "land_rows",
             "improvements": "improvement_rows", "sales": "sale_rows"}
    base = "(SELECT DISTINCT Parcel FROM property_rows WHERE Parcel IS NOT NULL)"
    return "\nUNION ALL ".join(
        f"SELECT '{n}' AS source, count(*) FILTER (Parcel IN (SELECT Parcel FROM {t} "
        f"WHERE Parcel IS NOT NULL)) AS matched, count(*) AS base_keys, "
        f"round(count(*) FILTER (Parcel IN (SELECT Parcel FROM {t} WHERE Parcel IS NOT NULL)) "
        f"* 100.0::DOUBLE / count(*), 4) AS pct FROM {base}"
        for n, t in names.items()
    )


COVERAGE = {
    **{c: f"{c} > 0" for c in (
        "TOT_LVG_AR", "EFF_YR_BLT", "LND_SQFOOT", "SALE_PRC1", "SALE_PRC2", "SALE_YR2",
        "NO_BULDNG", "JV_HMSTD", "ACT_YR_BLT")},
    **{c: f"{c} <> ''" for c in ("QUAL_CD1", "NBRHD_CD", "OWN_STATE_")},
    "out_of_state": "OWN_STATE_ <> 'FL' AND OWN_STATE_ <> ''",
}


def _buckets(least: int = 1) -> str:
    ranges = {
        "JV": [("zero", "JV = 0"), ("under 50k", "JV > 0 AND JV < 50000"),
               ("50k-200k", "JV >= 50000 AND JV < 200000"),
               ("200k-500k", "JV >= 200000 AND JV < 500000"),
               ("500k and over", "JV >= 500000")],
        "SALE_YR1": [("never sold", "SALE_YR1 = 0"),
                     ("before 2000", "SALE_YR1 > 0 AND SALE_YR1 < 2000"),
                     ("2000-2014", "SALE_YR1 >= 2000 AND SALE_YR1 < 2015"),
                     ("2015-2019", "SALE_YR1 >= 2015 AND SALE_YR1 < 2020"),
                     ("2020 and later", "SALE_YR1 >= 2020")],
    }
    rows = "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{b}' AS bucket, count(*) FILTER ({e}) AS n FROM leads"
        for c, buckets in ranges.items() for b, e in buckets
    )
    return f"SELECT * FROM ({rows}) WHERE n >= {least}"


def _fold_top(columns: dict[str, int | None]) -> str:
    parts = []
    for c, n in columns.items():
        keep = f"WHERE place <= {n}" if n else ""
        parts.append(
            f"SELECT * FROM (SELECT fold, '{c}' AS \"column\", {c} AS value, count(*) AS n, "
            f"CAST(row_number() OVER (PARTITION BY fold ORDER BY count(*) DESC, {c}) AS INTEGER) AS place "
            f"FROM folded WHERE {c} IS NOT NULL GROUP BY fold, {c}) {keep}"
        )
    return "\nUNION ALL ".join(parts)


INPUTS = ("JV", "JV_HMSTD", "LND_VAL", "LND_SQFOOT", "TOT_LVG_AR", "ACT_YR_BLT",
          "SALE_PRC1", "SALE_YR1", "NO_BULDNG")


def _scaled() -> str:
    columns = INPUTS
    exprs = ", ".join(
        f"round(({c} - (SELECT avg({c}) FROM train)) / "
        f"(SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END FROM train), 6) AS {c}"
        for c in columns
    )
    return exprs


METRICS = """
    CASE WHEN tp + fp = 0 THEN 0 ELSE round(tp / (tp + fp)::DOUBLE, 6) END AS "precision",
    CASE WHEN tp + fn = 0 THEN 0 ELSE round(tp / (tp + fn)::DOUBLE, 6) END AS recall,
    CASE WHEN 2 * tp + fp + fn = 0 THEN 0
         ELSE round(2 * tp / (2 * tp + fp + fn)::DOUBLE, 6) END AS f1"""

ORACLE: dict[str, str] = {
    # sources
    "src_tsv_scan": with_ctes(
        "owner_rows", "SELECT Parcel, Owner_Mail_Name, Owner_Mail_Addr1, Owner_Mail_State, "
        "Owner_Mail_Zip FROM owner_rows"),
    "src_tsv_full_width": with_ctes(
        "sale_rows", "SELECT Parcel, Sale_Line_Num, Sale_Date, try_cast(Sale_Price AS DOUBLE) AS Sale_Price, "
        "DOR_Qual_Code, 'not read' AS Remark FROM sale_rows"),
    "src_table_scan": with_ctes("leads", f"SELECT {LEAD_COLUMNS} FROM leads"),
    "src_projected_scan": with_ctes("leads", f"SELECT OBJECTID, {DETAILS} FROM leads"),
    "src_by_city": with_ctes(
        "leads", "SELECT OBJECTID, Parcel, PHY_CITY, JV FROM leads WHERE PHY_CITY = 'NATION_5'"),
    "src_by_codes": with_ctes(
        "leads", "SELECT OBJECTID, Parcel, DOR_UC, JV FROM leads WHERE DOR_UC IN ('001', '002')"),
    "src_latest_run_scores": with_ctes(
        "scores", "SELECT 'RUN_B' AS run_id, OBJECTID, hot_lead_score / 2 AS hot_lead_score, rank "
        "FROM scores"),
    # sinks
    "sink_overwrite_count": with_ctes(
        "clean", "SELECT count(*) AS written, count(*) AS read_back FROM clean"),
    "sink_append_ignore_dups": with_ctes(
        "leads", "SELECT OBJECTID, Parcel, CASE WHEN DOR_UC IN ('001', '002', '007', '010') "
        "THEN JV + 1 ELSE JV END AS JV FROM leads"),
    "sink_append_indexed": with_ctes(
        "leads", "SELECT OBJECTID, Parcel, CASE WHEN DOR_UC IN ('001', '002', '007', '010') "
        "THEN JV + 1 ELSE JV END AS JV FROM leads"),
    "sink_append_layout": with_ctes(
        "leads", "SELECT OBJECTID, Parcel, CASE WHEN OBJECTID % 2 = 1 THEN ACT_YR_BLT END AS ACT_YR_BLT, "
        "CASE WHEN OBJECTID % 2 = 1 THEN PHY_CITY END AS PHY_CITY, NULL::DOUBLE AS JV FROM leads"),
    "sink_scored_run": with_ctes(
        "scores", "SELECT 'RUN_A' AS run_id, OBJECTID, hot_lead_score, rank, "
        "'PREDICT' AS pipeline_mode FROM scores"),
    # A CSV file does not tell an empty text from a missing one.
    "sink_export_file": with_ctes(
        "scores leads", f"SELECT * REPLACE (nullif(OWN_NAME, '') AS OWN_NAME, "
        f"nullif(OWN_STATE_, '') AS OWN_STATE_) FROM ({EXPORT})"),
    # projections
    "proj_to_number": with_ctes(
        "history_rows", f"SELECT ord, {num('Just_Value')} AS value, {num0('Just_Value')} AS value_or_zero, "
        f"{num('Hist_Tax_Year')} AS tax_year FROM history_rows"),
    "proj_text_norm": with_ctes(
        "property_rows", "SELECT ord, upper(trim(coalesce(City_Desc, 'nan'))) AS city, "
        "trim(coalesce(NBHD_Code, 'nan')) AS neighborhood, upper(trim(City_Desc)) AS strict_city "
        "FROM property_rows"),
    "proj_code_prefix": with_ctes(
        "property_rows", "SELECT ord, substr(trim(coalesce(Prop_Use_Code, 'nan')), 1, 3) AS code "
        "FROM property_rows"),
    "proj_zip5": with_ctes(
        "owner_rows", f"SELECT ord, {num0('substr(Owner_Mail_Zip, 1, 5)')} AS zip FROM owner_rows"),
    "proj_year_prefix": with_ctes(
        "sale_rows", f"SELECT ord, {num0('substr(Sale_Date, 1, 4)')} AS yr FROM sale_rows"),
    "proj_null_fill": with_ctes(
        "prop sale", "SELECT prop.Parcel AS Parcel, DOR_UC, coalesce(SALE_PRC1, 0) AS SALE_PRC1, "
        "coalesce(SALE_YR1, 0) AS SALE_YR1, coalesce(QUAL_CD1, '') AS QUAL_CD1, "
        "coalesce(SALE_PRC2, 0) AS SALE_PRC2, coalesce(SALE_YR2, 0) AS SALE_YR2 "
        "FROM prop LEFT JOIN sale ON prop.Parcel = sale.Parcel"),
    "proj_out_fields": with_ctes("leads", f"SELECT {LEAD_COLUMNS} FROM leads"),
    # source preparation
    "prep_property": with_ctes("prop", "SELECT Parcel, DOR_UC, PHY_CITY, NBRHD_CD FROM prop"),
    "prep_owners": with_ctes("own", "SELECT * FROM own"),
    "prep_history": with_ctes("hist", "SELECT * FROM hist"),
    "prep_land": with_ctes("lnd", "SELECT * FROM lnd"),
    "prep_imprv_filter": with_ctes(
        "improvement_rows", "SELECT Imprv_Type, count(*) AS n FROM improvement_rows "
        "WHERE Imprv_Type IS NULL OR trim(Imprv_Type) NOT IN ('SOHM', 'NSOHM') GROUP BY Imprv_Type"),
    "prep_improvements": with_ctes("imprv", "SELECT * FROM imprv"),
    "prep_sales": with_ctes("sale", "SELECT * FROM sale"),
    "etl_build_leads": with_ctes(
        "leads", f"SELECT {LEAD_COLUMNS.replace('OBJECTID, ', '')} FROM leads"),
    "etl_leads_from_files": with_ctes("leads", f"SELECT {LEAD_COLUMNS} FROM leads"),
    "etl_assign_objectid": with_ctes("leads", "SELECT OBJECTID, Parcel FROM leads"),
    "etl_resume_slice": with_ctes(
        "leads", "SELECT OBJECTID, Parcel FROM leads ORDER BY OBJECTID LIMIT 500 OFFSET 250"),
    # cleaning
    "clean_code_pad": with_ctes(
        "leads", "SELECT OBJECTID, CASE WHEN length(ltrim(DOR_UC, '0')) < 3 "
        "THEN lpad(ltrim(DOR_UC, '0'), 3, '0') ELSE ltrim(DOR_UC, '0') END AS DOR_UC FROM leads"),
    "clean_residential": with_ctes(
        "padded", "SELECT OBJECTID, DOR_UC FROM padded WHERE DOR_UC IN ('001', '002', '007', '010')"),
    "clean_jv_min": with_ctes("leads", "SELECT OBJECTID, JV FROM leads WHERE JV >= 1000"),
    "clean_value_fence": with_ctes(
        "fence", "SELECT round(q1, 4) AS q1, round(q3, 4) AS q3, "
        "round(upper_bound, 4) AS upper_bound FROM fence"),
    "clean_sketched_fence": with_ctes("valued", """
        SELECT quartile, (SELECT count(*) FROM valued) AS n, true AS within_error
        FROM (VALUES ('q1'), ('q3')) AS q(quartile)"""),
    "clean_jv_iqr": with_ctes("kept", "SELECT OBJECTID, DOR_UC, JV FROM kept"),
    "clean_city_corrections": with_ctes("spelled", "SELECT OBJECTID, PHY_CITY FROM spelled"),
    "clean_city_fill": with_ctes("placed", "SELECT OBJECTID, PHY_CITY, PHY_ZIPCD FROM placed"),
    "clean_unknown_share": with_ctes(
        "placed", "SELECT count(*) AS records, count(*) FILTER (PHY_CITY = 'UNKNOWN') AS unknown, "
        "round(avg(CASE WHEN PHY_CITY = 'UNKNOWN' THEN 1.0::DOUBLE ELSE 0 END) * 100, 4) AS unknown_pct, "
        "avg(CASE WHEN PHY_CITY = 'UNKNOWN' THEN 1.0::DOUBLE ELSE 0 END) * 100 > 5 AS warn FROM placed"),
    "clean_act_year": with_ctes("dated", "SELECT OBJECTID, DOR_UC, ACT_YR_BLT FROM dated"),
    "clean_eff_year": with_ctes("repaired", "SELECT OBJECTID, ACT_YR_BLT, EFF_YR_BLT FROM repaired"),
    "clean_living_area_null": with_ctes(
        "leads", "SELECT OBJECTID, nullif(TOT_LVG_AR, 0) AS TOT_LVG_AR FROM leads"),
    "clean_repair_counts": with_ctes("repaired", """
        SELECT count(*) FILTER (was_blank) AS city_blank,
               count(*) FILTER (was_blank AND PHY_CITY <> 'UNKNOWN') AS city_from_zip,
               count(*) FILTER (PHY_CITY = 'UNKNOWN') AS city_unknown,
               count(*) FILTER (was_act0) AS actual_year_filled,
               count(*) FILTER (ACT_YR_BLT = 0) AS actual_year_left,
               count(*) FILTER (was_eff0) AS effective_year_filled,
               count(*) FILTER (EFF_YR_BLT = 0) AS effective_year_left,
               count(*) FILTER (was_area0) AS area_blanked,
               count(*) FILTER (TOT_LVG_AR IS NULL) AS area_missing
        FROM repaired"""),
    "etl_clean_leads": with_ctes("clean", f"SELECT {LEAD_COLUMNS} FROM clean"),
    # features
    "feat_property_age": with_ctes("features", "SELECT OBJECTID, property_age FROM features"),
    "feat_corporate_owner": with_ctes(
        "features", "SELECT OBJECTID, is_corporate_owner FROM features"),
    "feat_absentee_owner": with_ctes("features", "SELECT OBJECTID, is_absentee_owner FROM features"),
    "feat_out_of_state": with_ctes(
        "features", "SELECT OBJECTID, is_out_of_state_owner, CAST(trim(OWN_STATE_) NOT IN "
        "('FL', '', 'nan') AS INTEGER) AS strict FROM features"),
    "feat_price_per_sqft": with_ctes("features", "SELECT OBJECTID, price_per_sqft FROM features"),
    "feat_lot_coverage": with_ctes("features", "SELECT OBJECTID, lot_coverage_ratio FROM features"),
    "feat_renovation_gap": with_ctes("features", "SELECT OBJECTID, renovation_gap FROM features"),
    "feat_value_tier": with_ctes(
        "features", "SELECT OBJECTID, value_tier, value_tier_encoded FROM features"),
    "feat_neighborhood_ratio": with_ctes(
        "features", "SELECT OBJECTID, round(neighborhood_value_ratio, 6) AS neighborhood_value_ratio "
        "FROM features"),
    "feat_neighborhood_ratio_strict": with_ctes("rated", """
        SELECT OBJECTID, nullif(NBRHD_CD, 'nan') AS NBRHD_CD,
               CASE WHEN NBRHD_CD = 'nan' THEN 1.0::DOUBLE
                    ELSE round(neighborhood_value_ratio, 6) END AS neighborhood_value_ratio
        FROM rated"""),
    "feat_distressed_sale": with_ctes(
        "features", "SELECT OBJECTID, distressed_sale_history FROM features"),
    "feat_never_sold": with_ctes("features", "SELECT OBJECTID, never_sold FROM features"),
    "feat_hot_lead": with_ctes("features", "SELECT OBJECTID, signals, hot_lead FROM features"),
    "feat_land_ratio": with_ctes(
        "leads", "SELECT OBJECTID, round(LND_VAL / CASE WHEN JV = 0 THEN 1 ELSE JV END, 6) AS land_ratio "
        "FROM leads"),
    "etl_features": with_ctes(
        "features", f"SELECT {LEAD_COLUMNS}, {FEATURE_NAMES} FROM features"),
    "etl_hot_leads": with_ctes(
        "features", "SELECT Parcel, OWN_NAME, PHY_CITY, JV, value_tier, property_age, never_sold, "
        "is_absentee_owner, is_out_of_state_owner, distressed_sale_history, signals "
        "FROM features WHERE hot_lead = 1"),
    "feat_flag_balance": with_ctes("features", _flags()),
    "feat_signal_histogram": with_ctes(
        "features", "SELECT signals, count(*) AS n FROM features GROUP BY signals"),
    "feat_tier_distribution": with_ctes(
        "features", "SELECT value_tier, value_tier_encoded, count(*) AS n FROM features GROUP BY ALL"),
    "feat_valuation_counts": with_ctes(
        "features", "SELECT count(*) FILTER (neighborhood_value_ratio < 0.8) AS undervalued, "
        "count(*) FILTER (neighborhood_value_ratio > 1.2) AS overvalued FROM features"),
    "agg_group_mean_top": with_ctes(
        "features", "SELECT NBRHD_CD, round(avg(JV), 4) AS mean, count(JV) AS n FROM features "
        "GROUP BY NBRHD_CD ORDER BY n DESC, NBRHD_CD LIMIT 5"),
    # aggregations and profiles
    "agg_record_count": with_ctes("leads", "SELECT count(*) AS records FROM leads"),
    "agg_summary_stats": with_ctes("leads", """
        SELECT count(*) AS total_records, count(DISTINCT PHY_CITY) AS unique_cities,
               count(DISTINCT PHY_ZIPCD) AS unique_zips,
               round(min(JV) FILTER (JV > 0), 2) AS min_value,
               round(max(JV) FILTER (JV > 0), 2) AS max_value,
               round(avg(JV) FILTER (JV > 0), 2) AS avg_value,
               count(*) FILTER (TOT_LVG_AR > 0) AS has_living_area,
               count(*) FILTER (SALE_PRC2 > 0) AS has_second_sale,
               count(*) FILTER (OWN_STATE_ <> 'FL' AND OWN_STATE_ <> '') AS out_of_state_owners
        FROM leads"""),
    "agg_value_counts": with_ctes(
        "leads", "\nUNION ALL ".join(
            _top("leads", c, n) for c, n in
            (("PHY_CITY", 20), ("DOR_UC", 20), ("QUAL_CD1", 20), ("OWN_STATE_", 20)))),
    "profile_nulls_zeros": with_ctes("clean", _nulls_and_zeros()),
    "profile_coverage": with_ctes("leads", _counts("leads", COVERAGE, "field", "n")),
    "profile_of_load": with_ctes("leads", f"""
        SELECT 'nulls' AS profile, "column", "check" AS label, n FROM ({_nulls_and_zeros("leads")})
        UNION ALL SELECT 'coverage', field, 'filled', n
        FROM ({_counts("leads", COVERAGE, "field", "n")})
        UNION ALL SELECT 'bucket', "column", bucket, n FROM ({_buckets(0)})"""),
    "profile_buckets": with_ctes("leads", _buckets()),
    "profile_describe": with_ctes("history_rows", "SELECT 1").replace(
        "\nSELECT 1", f",\n{LATEST_VALUES}\n"
        + _describe("latest", {"Just_Value": 1000.0, "Land_Value": 20000.0})),
    "profile_describe_improvements": with_ctes("improvement_rows", _describe(
        f"(SELECT {num('Actual_YrBlt')} AS Actual_YrBlt, "
        f"{num('Heated_SquareFeet')} AS Heated_SquareFeet FROM improvement_rows "
        "WHERE Imprv_Type IS NULL OR trim(Imprv_Type) NOT IN ('SOHM', 'NSOHM'))",
        {"Actual_YrBlt": 1900.0, "Heated_SquareFeet": 1000.0})),
    "profile_describe_sales": with_ctes("sale_rows", _describe(
        f"(SELECT {num('Sale_Price')} AS Sale_Price FROM sale_rows "
        f"WHERE {num('Sale_Line_Num')} = 0)", {"Sale_Price": 100000.0})),
    "profile_describe_features": with_ctes("features", _describe(
        "(SELECT *, LND_VAL / CASE WHEN JV = 0 THEN 1 ELSE JV END AS land_ratio FROM features)",
        {"JV": 100000.0, "property_age": 30.0, "renovation_gap": 1.0, "price_per_sqft": 1.0,
         "lot_coverage_ratio": 0.5, "land_ratio": 0.2, "neighborhood_value_ratio": 0.8})),
    "profile_tax_years": with_ctes(
        "history_rows", f"SELECT min({num('Hist_Tax_Year')}) AS first_year, "
        f"max({num('Hist_Tax_Year')}) AS last_year, "
        f"count(*) FILTER ({num('Hist_Tax_Year')} IS NULL) AS unreadable FROM history_rows"),
    "profile_owners": with_ctes("owner_rows", f"""
        SELECT count(*) AS owners, count(*) FILTER (trim(Owner_Mail_State) = 'FL') AS home_state,
               count(*) FILTER (trim(Owner_Mail_State) NOT IN ('FL', '', 'nan')) AS out_of_state,
               count(*) FILTER (regexp_matches(upper(Owner_Mail_Name), '{KEYWORDS}')) AS corporate,
               round(count(*) FILTER (regexp_matches(upper(Owner_Mail_Name), '{KEYWORDS}'))
                     * 100.0::DOUBLE / count(*), 4) AS corporate_pct
        FROM owner_rows"""),
    "agg_top_states": with_ctes("leads", """
        SELECT OWN_STATE_ AS value, count(*) AS n FROM leads
        WHERE OWN_STATE_ <> 'FL' AND OWN_STATE_ <> '' GROUP BY OWN_STATE_
        ORDER BY n DESC, value LIMIT 8"""),
    "profile_join_coverage": with_ctes(
        "property_rows owner_rows history_rows land_rows improvement_rows sale_rows", _coverage()),
    "profile_survival": with_ctes("padded valued kept", """
        SELECT CAST(step AS INTEGER) AS step, filter, rows,
               coalesce(lag(rows) OVER (ORDER BY step) - rows, 0) AS removed
        FROM (SELECT 1 AS step, 'all' AS filter, (SELECT count(*) FROM padded) AS rows
              UNION ALL SELECT 2, 'residential', (SELECT count(*) FROM padded
                  WHERE DOR_UC IN ('001', '002', '007', '010'))
              UNION ALL SELECT 3, 'minimum value', (SELECT count(*) FROM valued)
              UNION ALL SELECT 4, 'value fence', (SELECT count(*) FROM kept))"""),
    "profile_survival_estimate": with_ctes("property_rows history_rows", f"""
        , latest AS (
            SELECT Parcel, {num('Just_Value')} AS v FROM history_rows WHERE Parcel IS NOT NULL
            QUALIFY row_number() OVER (
                PARTITION BY Parcel ORDER BY {num('Hist_Tax_Year')} DESC NULLS LAST, ord) = 1),
        res AS (SELECT * FROM property_rows
                WHERE substr(trim(coalesce(Prop_Use_Code, 'nan')), 1, 3) IN ('001', '002', '007', '010'))
        SELECT CAST(step AS INTEGER) AS step, filter, rows,
               coalesce(lag(rows) OVER (ORDER BY step) - rows, 0) AS removed
        FROM (SELECT 1 AS step, 'all' AS filter, count(*) AS rows FROM property_rows
              UNION ALL SELECT 2, 'residential', count(*) FROM res
              UNION ALL SELECT 3, 'minimum value', count(*) FROM res
                        WHERE Parcel IN (SELECT Parcel FROM latest WHERE v >= 1000))"""),
    "profile_rule_compare": with_ctes("sale_rows", """
        SELECT count(*) FILTER (upper(trim(DOR_Qual_Code)) = 'U') AS exact_rule,
               count(*) FILTER (starts_with(upper(trim(DOR_Qual_Code)), 'U')) AS prefix_rule
        FROM sale_rows"""),
    "profile_matched_codes": with_ctes("sale_rows", """
        SELECT DOR_Qual_Code AS value, count(*) AS n FROM sale_rows
        WHERE starts_with(upper(trim(DOR_Qual_Code)), 'U') GROUP BY DOR_Qual_Code"""),
    "profile_range_violations": with_ctes(
        "features", _counts("features", {
            "negative_age": "2000 - ACT_YR_BLT < 0",
            "land_ratio_over_1": "LND_VAL / CASE WHEN JV = 0 THEN 1 ELSE JV END > 1.0",
            "lot_coverage_over_1": "lot_coverage_ratio > 1.0",
        }, "rule", "violations")),
    "set_key_intersect": with_ctes(
        "owner_rows sale_rows", "SELECT Parcel FROM owner_rows WHERE Parcel IS NOT NULL "
        "INTERSECT SELECT Parcel FROM sale_rows"),
    # ranking, scores, export
    "score_rank": with_ctes(
        "scores", "SELECT OBJECTID, OWN_NAME, PHY_ADDR1, PHY_CITY, PHY_ZIPCD, JV, SALE_PRC1, SALE_YR1, "
        "hot_lead_score, rank FROM scores"),
    "score_topk": with_ctes(
        "scores", "SELECT OBJECTID, hot_lead_score FROM scores ORDER BY rank LIMIT 25"),
    "score_summary": with_ctes(
        "scores", "SELECT count(*) AS scored, round(avg(hot_lead_score), 6) AS mean_score, "
        "count(*) FILTER (hot_lead_score > 0.5) AS above_half, "
        "count(*) FILTER (hot_lead_score > 0.8) AS above_hot FROM scores"),
    "export_join": with_ctes(
        "scores leads", f"SELECT s.OBJECTID AS OBJECTID, s.hot_lead_score AS hot_lead_score, "
        f"{', '.join('l.' + c + ' AS ' + c for c in DETAILS.split(', '))} "
        "FROM scores s LEFT JOIN leads l ON s.OBJECTID = l.OBJECTID"),
    "export_join_matched": with_ctes(
        "scores leads", "SELECT count(*) AS records, count(l.OWN_NAME) AS matched "
        "FROM scores s LEFT JOIN leads l ON s.OBJECTID = l.OBJECTID"),
    "export_temperature": with_ctes(
        "scores", f"SELECT OBJECTID, hot_lead_score, {TEMPERATURE} AS temperature FROM scores"),
    "export_temperature_counts": with_ctes(
        "scores", f"SELECT {TEMPERATURE} AS temperature, count(*) AS n FROM scores GROUP BY 1"),
    "export_format": with_ctes("scores leads", EXPORT),
    # model
    "ml_class_balance": with_ctes(
        "features", "SELECT count(*) AS records, count(*) FILTER (hot_lead = 1) AS hot, "
        "count(*) FILTER (hot_lead = 0) AS cold, "
        "round(count(*) FILTER (hot_lead = 1) * 100.0::DOUBLE / count(*), 4) AS hot_pct FROM features"),
    "ml_stratified_split": with_ctes(
        "split", "SELECT OBJECTID, hot_lead, is_test FROM split"),
    "ml_standard_scale": with_ctes("split", "SELECT 1").replace(
        "\nSELECT 1", ",\ntrain AS (SELECT * FROM split WHERE NOT is_test)\n"
        f"SELECT OBJECTID, {_scaled()} FROM split"),
    "ml_train_score": with_ctes(
        "features", "SELECT OBJECTID, hot_lead, true AS is_probability, true AS same_when_loaded, "
        "true AS above_gate FROM features"),
    "ml_fitted_scaler": with_ctes("split", "\nUNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS deviation "
        "FROM split WHERE NOT is_test" for c in INPUTS)),
    "ml_feature_importance": "\nUNION ALL ".join(
        f"SELECT '{c}' AS feature, true AS is_share, 1.0::DOUBLE AS total" for c in INPUTS),
    "ml_cross_validation": with_ctes(
        "folded", "SELECT fold, count(*) FILTER (hot_lead = 1) AS hot, "
        "count(*) FILTER (hot_lead = 0) AS cold, true AS above_chance FROM folded GROUP BY fold"),
    "ml_held_out_rows": with_ctes(
        "folded", "SELECT OBJECTID, fold, PHY_CITY, true AS is_class FROM folded"),
    "run_train_predict": with_ctes("scores leads", f"""
        SELECT * EXCLUDE (rank, hot_lead_score, temperature), true AS rank_follows,
               true AS band_follows FROM ({EXPORT})"""),
    "run_resume": with_ctes("leads clean", """
        SELECT * FROM (VALUES (1, 'scraper', 'completed', (SELECT count(*) FROM leads)),
            (2, 'cleaner', 'failed', 0), (3, 'cleaner', 'completed', (SELECT count(*) FROM clean)),
            (4, 'features', 'completed', (SELECT count(*) FROM clean)))
            AS t(step, stage, status, records_out)"""),
    "ml_cv_folds": with_ctes("folded", "SELECT OBJECTID, hot_lead, fold FROM folded"),
    "ml_eval_metrics": with_ctes(
        "confusion", f"SELECT tp, fp, fn, tn, {METRICS} FROM (SELECT CAST(sum(tp) AS BIGINT) AS tp, "
        "CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn, CAST(sum(tn) AS BIGINT) AS tn "
        "FROM confusion)"),
    "ml_fold_metrics": with_ctes("confusion", f"SELECT fold, tp, fp, fn, tn, {METRICS} FROM confusion"),
    # diagnostics
    "diag_fold_profile": with_ctes("folded", """
        SELECT fold, count(*) AS size, count(*) FILTER (hot_lead = 1) AS hot,
               count(*) FILTER (hot_lead = 0) AS cold,
               round(count(*) FILTER (hot_lead = 1) * 100.0::DOUBLE / count(*), 4) AS hot_pct,
               min(JV) AS jv_min, max(JV) AS jv_max, round(avg(JV), 4) AS jv_mean,
               min(SALE_YR1) AS sale_year_min, max(SALE_YR1) AS sale_year_max
        FROM folded GROUP BY fold"""),
    "diag_fold_top_values": with_ctes(
        "folded", _fold_top({"PHY_CITY": 5, "DOR_UC": None, "NBRHD_CD": 5, "value_tier": None})),
    "diag_worst_fold": with_ctes("confusion", """
        SELECT fold, round(f1, 6) AS f1, f1 < 0.65 AS collapsed, fn AS missed, fp AS false_alarms
        FROM (SELECT *, CASE WHEN 2 * tp + fp + fn = 0 THEN 0
                             ELSE 2 * tp / (2 * tp + fp + fn)::DOUBLE END AS f1 FROM confusion)
        ORDER BY f1, fold LIMIT 1"""),
    "diag_error_profile": with_ctes("wrong", """
        SELECT outcome, count(*) AS n, round(avg(JV), 4) AS jv_mean, min(JV) AS jv_min,
               max(JV) AS jv_max, round(avg(ACT_YR_BLT), 4) AS year_built_mean,
               round(avg(SALE_YR1), 4) AS sale_year_mean
        FROM wrong GROUP BY outcome"""),
    "diag_error_top_values": with_ctes("wrong", "\nUNION ALL ".join(f"""
        SELECT * FROM (SELECT outcome, '{c}' AS "column", {c} AS value, count(*) AS n,
            CAST(row_number() OVER (PARTITION BY outcome ORDER BY count(*) DESC, {c}) AS INTEGER) AS place
            FROM wrong WHERE {c} IS NOT NULL GROUP BY outcome, {c}) WHERE place <= 3"""
        for c in ("PHY_CITY", "value_tier", "DOR_UC"))),
    "diag_fold_label_rate": with_ctes("folded", """
        SELECT fold, round(avg(hot_lead) * 100, 4) AS hot_pct, round(avg(JV), 4) AS jv_mean, top_city
        FROM folded JOIN (
            SELECT fold, PHY_CITY AS top_city FROM folded GROUP BY fold, PHY_CITY
            QUALIFY row_number() OVER (PARTITION BY fold ORDER BY count(*) DESC, PHY_CITY) = 1)
        USING (fold) GROUP BY fold, top_city"""),
    # whole runs
    "etl_incremental_load": with_ctes(
        "leads", f"SELECT {LEAD_COLUMNS}, 100::BIGINT AS first_load, "
        "(SELECT count(*) FROM leads) - 100 AS second_load FROM leads"),
    "etl_arrivals": with_ctes("leads", "SELECT OBJECTID, Parcel, JV FROM leads"),
    "run_stage_counts": with_ctes("leads clean", """
        SELECT 'scraper' AS stage, 'completed' AS status, count(*) AS records_in,
               count(*) AS records_out FROM leads
        UNION ALL SELECT 'cleaner', 'completed', (SELECT count(*) FROM leads), count(*) FROM clean
        UNION ALL SELECT 'features', 'completed', count(*), count(*) FROM clean"""),
    "sink_reset_tables": with_ctes("leads scores", """
        SELECT 'leads' AS table_name, count(*) AS before, 0::BIGINT AS after FROM leads
        UNION ALL SELECT 'scored_leads', count(*), 0 FROM scores
        UNION ALL SELECT 'leads_clean', 0, 0"""),
    # run log
    "log_latest_status": with_ctes("statuses", "SELECT run_id, stage, status FROM statuses"),
    "log_last_run": with_ctes(
        "run_log", "SELECT run_id FROM run_log ORDER BY created_at DESC, id DESC LIMIT 1"),
    "log_run_summary": with_ctes(
        "run_log", "SELECT stage, status, records_in, records_out, duration_secs, error_message, "
        "created_at FROM run_log WHERE run_id = (SELECT run_id FROM run_log "
        "ORDER BY created_at DESC, id DESC LIMIT 1)"),
    "log_run_complete": with_ctes(
        "statuses", "SELECT run_id, count(*) FILTER (status = 'completed' AND stage IN "
        "('scraper', 'cleaner', 'features', 'model')) = 4 AS complete FROM statuses GROUP BY run_id"),
}
