"""Adapters: build the pipeline's input roles from the driver's test tables.

Each role is written twice: as Spark DataFrame code (what the queries read)
and as DuckDB SQL (what the oracle reads). Both follow the same rules; keep
them side by side when editing. Roles only rename, derive and join columns,
so their size grows with the test tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Fixed values (adapter vocabulary): bedside items besides those of ``part``, whose
# events (``_bedside``) hold what the line items lack: two pressures at one instant,
# rises within two days, readings without a time, and a second reading of one instant.
BEDSIDE_ITEMS = [(-1, "Arterial BP [Systolic]"), (-2, "Arterial BP [Diastolic]"), (-3, "Creatinine")]


def _word(c, i: int):
    return F.element_at(F.split(c, " "), i)


# Fixed values (adapter vocabulary). Item dictionary: second word of the part
# name -> chart label; first word -> suffix marking readings the features
# exclude. Ethnicity texts exercise the normaliser and the unknown-class fold.
ITEM_LABELS = {
    "ring": "Creatinine",
    "bolt": "Hematocrit",
    "widget": "Arterial BP [Systolic]",
    "plate": "Arterial BP [Diastolic]",
    "rod": "Arterial pH",
    "gear": "[Urine] Color",
    "gizmo": "Urine [Appearance]",
    "anvil": "Heart Rate",
}
ITEM_SUFFIX = {"old": " (apache)", "cold": " pulmonary"}
ETHNICITIES = ["WHITE", "BLACK/AFRICAN AMERICAN", "HISPANIC OR LATINO", "ASIAN - CHINESE",
               "HISPANIC/LATINO - PUERTO RICAN"]
LAB_ITEMS = [("view", "Sodium", "BLOOD", "Chemistry"),
             ("click", "Potassium", "Blood", "Chemistry"),
             ("purchase", "Iron", "BLOOD", "Chemistry"),
             ("signup", "Sodium, Urine", "URINE", "Chemistry"),
             ("error", "Iron Binding Capacity", "BLOOD", "Chemistry")]


def _case(col, mapping: dict, default=None):
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v)))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def _sql_case(col: str, mapping: dict, default: str | None = None) -> str:
    parts = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items())
    tail = f" ELSE '{default}'" if default is not None else ""
    return f"CASE {parts}{tail} END"


def _sql_quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# --------------------------------------------------------------------- admissions
def admissions(spark, d):
    o = table(spark, d, "orders")
    eth = F.element_at(F.array(*[F.lit(e) for e in ETHNICITIES]), (F.col("o_custkey") % 5 + 1).cast("int"))
    return o.select(
        F.col("o_orderkey").alias("hadm_id"),
        F.col("o_custkey").alias("subject_id"),
        F.col("o_orderdate").alias("admittime"),
        (F.col("o_orderdate") + F.make_dt_interval(days=(F.col("o_orderkey") % 10 + 1).cast("int"))).alias("dischtime"),
        F.col("o_orderpriority").alias("admission_type"),
        F.when(F.col("o_custkey") % 7 == 0, F.lit("UNKNOWN/NOT SPECIFIED"))
         .when(F.col("o_custkey") % 11 == 0, F.lit("PATIENT DECLINED TO ANSWER"))
         .otherwise(eth).alias("ethnicity"),
    )


_ETH_SQL = "[" + ", ".join(_sql_quote(e) for e in ETHNICITIES) + "]"
SQL_ADMISSIONS = f"""admissions_r AS (
  SELECT o_orderkey AS hadm_id, o_custkey AS subject_id, o_orderdate AS admittime,
         o_orderdate + (o_orderkey % 10 + 1) * INTERVAL 1 DAY AS dischtime,
         o_orderpriority AS admission_type,
         CASE WHEN o_custkey % 7 = 0 THEN 'UNKNOWN/NOT SPECIFIED'
              WHEN o_custkey % 11 = 0 THEN 'PATIENT DECLINED TO ANSWER'
              ELSE {_ETH_SQL}[o_custkey % 5 + 1] END AS ethnicity
  FROM orders)"""


# ----------------------------------------------------------------------- patients
def patients(spark, d):
    c = table(spark, d, "customer")
    base = F.lit("1950-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(days=(F.col("c_custkey") % 9000).cast("int"))
    dob = F.when(F.col("c_custkey") % 50 == 0, base - F.make_ym_interval(years=F.lit(300))).otherwise(base)
    return c.select(
        F.col("c_custkey").alias("subject_id"),
        F.when(F.col("c_custkey") % 3 == 0, F.lit("F")).when(F.col("c_custkey") % 3 == 1, F.lit("M")).alias("gender"),
        dob.alias("dob"),
    )


SQL_PATIENTS = """patients_r AS (
  SELECT c_custkey AS subject_id,
         CASE c_custkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' END AS gender,
         CASE WHEN c_custkey % 50 = 0
              THEN TIMESTAMP '1950-01-01' + (c_custkey % 9000) * INTERVAL 1 DAY - INTERVAL 300 YEAR
              ELSE TIMESTAMP '1950-01-01' + (c_custkey % 9000) * INTERVAL 1 DAY END AS dob
  FROM customer)"""


# -------------------------------------------------------------------------- stays
def stays(spark, d):
    li = table(spark, d, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("hadm_id"),
        _case(F.col("l_returnflag"), {"A": "MICU", "R": "CCU"}, "SICU").alias("last_careunit"),
        (F.col("l_quantity") / 10).alias("los"),
    )


SQL_STAYS = """stays_r AS (
  SELECT l_orderkey AS hadm_id,
         CASE l_returnflag WHEN 'A' THEN 'MICU' WHEN 'R' THEN 'CCU' ELSE 'SICU' END AS last_careunit,
         l_quantity / 10 AS los
  FROM lineitem)"""


# ------------------------------------------------------------------------- charts
ROW_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _chart_value_num():
    bucket = F.pmod(F.floor(F.col("l_extendedprice")), F.lit(200))
    return bucket, bucket + F.col("l_discount")


def charts(spark, d):
    """Chart events: one reading per line item. ``valuenum`` is text (with
    'n/a' for about 5 % of rows) and ``storetime`` is missing for line 5, so
    the tolerant parsers and the earliest-time rule have work to do."""
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders").select(F.col("o_orderkey"), F.col("o_custkey"))
    bucket, num = _chart_value_num()
    j = li.join(o, li.l_orderkey == o.o_orderkey, "left")
    own = j.select(
        F.struct(*[F.col(c) for c in ROW_ORDER]).alias("row_order"),
        F.col("l_orderkey").alias("hadm_id"),
        F.col("o_custkey").alias("subject_id"),
        F.col("l_partkey").alias("itemid"),
        F.col("l_shipdate").alias("charttime"),
        F.when(F.col("l_linenumber") != 5,
               F.col("l_shipdate") + F.make_dt_interval(days=(F.col("l_linenumber") - 3).cast("int"))).alias("storetime"),
        _case(F.col("l_returnflag"), {"A": "Yellow", "R": "Red"}, "Clear").alias("value"),
        F.when(bucket >= 190, F.lit("n/a")).otherwise(num.cast("string")).alias("valuenum"),
        F.lit("units").alias("valueuom"),
    )
    return own.unionByName(_bedside(spark, d))


# (item, hours after the admission, value) of the four bedside readings of a line item;
# the same text in Spark and in DuckDB.
_BEDSIDE = [("-1", "l_partkey % 60", "100 + l_partkey % 90"), ("-2", "l_partkey % 60", "60 + l_suppkey % 70"),
            ("-3", "l_partkey % 40", "0.5 + (l_partkey % 24) / 8.0"),
            ("-3", "l_partkey % 40 + CASE WHEN l_suppkey % 3 = 0 THEN 0 WHEN l_suppkey % 3 = 1 THEN 12 ELSE 60 END",
             "0.5 + (l_partkey % 24) / 8.0 + (l_suppkey % 9) / 8.0")]
_BEDSIDE_ROWS = "l_linenumber = 1 AND l_orderkey % 4 = 0"
_BEDSIDE_TIMELESS = "l_partkey % 11 = 0"


def _bedside(spark, d):
    """Bedside readings of every fourth order's first line items. The second
    creatinine reading falls on the first, twelve or sixty hours later."""
    li = table(spark, d, "lineitem").where(_BEDSIDE_ROWS)
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    readings = F.array(*[F.struct(F.lit(i).alias("at"), F.expr(f"CAST({item} AS BIGINT)").alias("itemid"), F.expr(f"CAST({hours} AS INT)").alias("hours"),
                                  F.expr(f"CAST({value} AS DOUBLE)").alias("num")) for i, (item, hours, value) in enumerate(_BEDSIDE)])
    rows = li.join(o, li.l_orderkey == o.o_orderkey).withColumn("r", F.explode(readings))
    time = F.when(~F.expr(_BEDSIDE_TIMELESS), F.col("o_orderdate") + F.make_dt_interval(hours=F.col("r.hours")))
    order = [(F.col("l_linenumber") + 100 * (F.col("r.at") + 1)).cast("int").alias(c) if c == "l_linenumber" else F.col(c) for c in ROW_ORDER]
    return rows.select(
        F.struct(*order).alias("row_order"), F.col("l_orderkey").alias("hadm_id"), F.col("o_custkey").alias("subject_id"),
        F.col("r.itemid").alias("itemid"), time.alias("charttime"), time.alias("storetime"), F.lit("Clear").alias("value"),
        F.col("r.num").cast("string").alias("valuenum"), F.lit("units").alias("valueuom"))


_BEDSIDE_SQL = " UNION ALL ".join(f"""
  SELECT l.l_orderkey, o.o_custkey, CAST({item} AS BIGINT), b.t, b.t, 'Clear', CAST({value} AS DOUBLE), l.l_orderkey,
         l.l_linenumber + {100 * (i + 1)}, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice, l.l_discount, l.l_tax,
         l.l_returnflag, l.l_linestatus, l.l_shipdate
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey,
       LATERAL (SELECT CASE WHEN NOT ({_BEDSIDE_TIMELESS}) THEN o.o_orderdate + ({hours}) * INTERVAL 1 HOUR END AS t) b
  WHERE {_BEDSIDE_ROWS}""" for i, (item, hours, value) in enumerate(_BEDSIDE))
SQL_CHARTS = """charts_r AS (
  SELECT l.l_orderkey AS hadm_id, o.o_custkey AS subject_id, l.l_partkey AS itemid,
         l.l_shipdate AS charttime,
         CASE WHEN l.l_linenumber <> 5 THEN l.l_shipdate + (l.l_linenumber - 3) * INTERVAL 1 DAY END AS storetime,
         CASE l.l_returnflag WHEN 'A' THEN 'Yellow' WHEN 'R' THEN 'Red' ELSE 'Clear' END AS value,
         CASE WHEN (floor(l.l_extendedprice)::BIGINT % 200) >= 190 THEN NULL
              ELSE (floor(l.l_extendedprice)::BIGINT % 200) + l.l_discount END AS valuenum,
         l.l_orderkey AS o1, l.l_linenumber AS o2, l.l_partkey AS o3, l.l_suppkey AS o4, l.l_quantity AS o5,
         l.l_extendedprice AS o6, l.l_discount AS o7, l.l_tax AS o8, l.l_returnflag AS o9,
         l.l_linestatus AS o10, l.l_shipdate AS o11
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  UNION ALL""" + _BEDSIDE_SQL + ")"
SQL_ROW_ORDER = "o1, o2, o3, o4, o5, o6, o7, o8, o9, o10, o11"


def items(spark, d):
    """Item dictionary from ``part``; every 97th part is left out so some
    events stay unmatched."""
    p = table(spark, d, "part").where(F.col("p_partkey") % 97 != 0)
    label = F.concat(_case(_word(F.col("p_name"), 2), ITEM_LABELS, "Other"),
                     F.coalesce(_case(_word(F.col("p_name"), 1), ITEM_SUFFIX), F.lit("")))
    category = F.concat(F.col("p_type"), F.lit(" - Lab's Results/Panel ("), F.lower(F.col("p_type")), F.lit(")"))
    bedside = spark.createDataFrame(BEDSIDE_ITEMS, "itemid long, label string")
    return p.select(
        F.col("p_partkey").alias("itemid"),
        label.alias("label"),
        category.alias("category"),
        F.lit("units").alias("unitname"),
    ).unionByName(bedside.select("itemid", "label", F.lit("BEDSIDE").alias("category"), F.lit("units").alias("unitname")))


SQL_ITEMS = f"""items_r AS (
  SELECT p_partkey AS itemid,
         coalesce({_sql_case("split_part(p_name, ' ', 2)", ITEM_LABELS, "Other")}, 'Other')
           || coalesce({_sql_case("split_part(p_name, ' ', 1)", ITEM_SUFFIX)}, '') AS label,
         p_type || ' - Lab''s Results/Panel (' || lower(p_type) || ')' AS category,
         'units' AS unitname
  FROM part WHERE p_partkey % 97 <> 0
  UNION ALL SELECT * FROM (VALUES {", ".join(f"({i}::BIGINT, '{x}', 'BEDSIDE', 'units')" for i, x in BEDSIDE_ITEMS)}) b)"""


# ---------------------------------------------------------------- diagnoses / codes
def diagnoses(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey, "left").select(
        F.col("l_orderkey").alias("hadm_id"), F.col("o_custkey").alias("subject_id"),
        F.col("l_partkey").alias("icd9_code"))


SQL_DIAGNOSES = """diagnoses_r AS (
  SELECT l.l_orderkey AS hadm_id, o.o_custkey AS subject_id, l.l_partkey AS icd9_code
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


def crosswalk(spark, d):
    """Code -> category map: parts with size <= 40; every 13th part maps to the
    label category '135', every 37th to no category."""
    p = table(spark, d, "part").where(F.col("p_size") <= 40)
    hcc = (F.when(F.col("p_partkey") % 37 == 0, F.lit(None).cast("string"))
            .when(F.col("p_partkey") % 13 == 0, F.lit("135"))
            .otherwise((F.col("p_partkey") % 140).cast("string")))
    return p.select(F.col("p_partkey").alias("icd"), hcc.alias("hcc"))


SQL_CROSSWALK = """crosswalk_r AS (
  SELECT p_partkey AS icd,
         CASE WHEN p_partkey % 37 = 0 THEN NULL WHEN p_partkey % 13 = 0 THEN '135'
              ELSE CAST(p_partkey % 140 AS VARCHAR) END AS hcc
  FROM part WHERE p_size <= 40)"""


def code_titles(spark, d):
    return table(spark, d, "part").select(F.col("p_partkey").alias("icd9_code"), F.col("p_name").alias("short_title"))


SQL_TITLES = """titles_r AS (SELECT p_partkey AS icd9_code, p_name AS short_title FROM part)"""


# ------------------------------------------------------------ prescriptions / cpt
def prescriptions(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate")
    p = table(spark, d, "part").select("p_partkey", "p_name")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    j = li.join(p, li.l_partkey == p.p_partkey, "left").join(o, li.l_orderkey == o.o_orderkey, "left")
    return j.select(F.col("l_orderkey").alias("hadm_id"), F.col("o_custkey").alias("subject_id"),
                    F.col("p_name").alias("drug"), F.col("l_shipdate").alias("startdate"))


SQL_PRESCRIPTIONS = """prescriptions_r AS (
  SELECT l.l_orderkey AS hadm_id, o.o_custkey AS subject_id, p.p_name AS drug, l.l_shipdate AS startdate
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
                  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


def drug_orders(spark, d, words):
    """Prescriptions whose drug text names one of ``words`` for three quarters of the
    parts (in changing case, with a dose) and the part's name otherwise; every
    thirteenth has no start time. Start times lie around the admission."""
    p = table(spark, d, "part").select("p_partkey", "p_name")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(p, li.l_partkey == p.p_partkey, "left").join(o, li.l_orderkey == o.o_orderkey, "left")
    word = F.element_at(F.array(*[F.lit(w) for w in words]), (F.col("l_partkey") % len(words) + 1).cast("int"))
    named = F.concat(F.when(F.col("l_suppkey") % 2 == 0, F.upper(word)).otherwise(F.initcap(word)), F.lit(" 10mg"))
    start = F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("l_suppkey") * 7 % 120 - 10).cast("int"))
    return j.select(F.col("l_orderkey").alias("hadm_id"), F.col("o_custkey").alias("subject_id"),
                    F.when(F.col("l_partkey") % 4 == 0, F.col("p_name")).otherwise(named).alias("drug"),
                    F.when(F.col("l_partkey") % 13 != 0, start).alias("startdate"))


def sql_drug_orders(words) -> str:
    listed = "[" + ", ".join(_sql_quote(w) for w in words) + "]"
    word = f"{listed}[CAST(l.l_partkey % {len(words)} + 1 AS INTEGER)]"
    return f"""prescriptions_r AS (
  SELECT l.l_orderkey AS hadm_id, o.o_custkey AS subject_id,
         CASE WHEN l.l_partkey % 4 = 0 THEN p.p_name
              WHEN l.l_suppkey % 2 = 0 THEN upper({word}) || ' 10mg' ELSE upper({word}[1]) || {word}[2:] || ' 10mg' END AS drug,
         CASE WHEN l.l_partkey % 13 <> 0 THEN o.o_orderdate + (l.l_suppkey * 7 % 120 - 10) * INTERVAL 1 HOUR END AS startdate
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


def procedures(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    p = table(spark, d, "part").select("p_partkey", "p_brand", "p_name")
    j = li.join(p, li.l_partkey == p.p_partkey, "left")
    return j.select(F.col("l_orderkey").alias("hadm_id"),
                    F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("")).alias("cpt_cd"),
                    F.col("p_name").alias("description"))


SQL_PROCEDURES = """procedures_r AS (
  SELECT l.l_orderkey AS hadm_id, replace(p.p_brand, 'Brand#', '') AS cpt_cd, p.p_name AS description
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey)"""


# ----------------------------------------------------------------------------- labs
def lab_events(spark, d):
    e = table(spark, d, "events")
    return e.select(
        F.col("user_id").alias("subject_id"),
        F.when(F.col("event_id") % 17 != 0, F.col("user_id")).alias("hadm_id"),
        F.col("event_type").alias("itemid"),
        F.col("ts").alias("charttime"),
        F.col("value").cast("string").alias("value"),
        F.col("value").alias("valuenum"),
        F.lit("mEq/L").alias("valueuom"),
        F.lit(None).cast("string").alias("flag"),
    )


def lab_items(spark, d=None):
    return spark.createDataFrame(LAB_ITEMS, "itemid string, label string, fluid string, category string")


SQL_LAB_EVENTS = """labevents_r AS (
  SELECT user_id AS subject_id, CASE WHEN event_id % 17 <> 0 THEN user_id END AS hadm_id,
         event_type AS itemid, ts AS charttime, value AS valuenum
  FROM events)"""
SQL_LAB_ITEMS = "labitems_r AS (SELECT * FROM (VALUES " + ", ".join(
    "(" + ", ".join(_sql_quote(x) for x in row) + ")" for row in LAB_ITEMS) + ") t(itemid, label, fluid, category))"


# ------------------------------------------------------------- paired readings input
PAIRED_LABELS = {"view": "Arterial BP [Systolic]", "click": "Arterial BP [Diastolic]",
                 "purchase": "Non Invasive BP [Systolic]", "error": "Non Invasive BP [Diastolic]",
                 "signup": "Pulmonary Artery Pressure systolic"}


def paired_readings_input(spark, d):
    """Chart-shaped rows from all ``events``, one series per event type: two systolic,
    two diastolic and an excluded one; readings pair on user and day."""
    e = table(spark, d, "events")
    label = _case(F.col("event_type"), PAIRED_LABELS)
    return e.select(
        F.col("user_id").alias("hadm_id"),
        F.date_trunc("DAY", F.col("ts")).cast("timestamp_ntz").alias("eventtime"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
         + F.make_dt_interval(days=(F.col("user_id") % 10).cast("int"))).alias("admittime"),
        label.alias("label"),
        F.col("value").alias("valuenum"),
    )


SQL_PAIRED = f"""paired_r AS (
  SELECT user_id AS hadm_id, date_trunc('day', ts) AS eventtime,
         TIMESTAMP '2024-01-01' + (user_id % 10) * INTERVAL 1 DAY AS admittime,
         {_sql_case("event_type", PAIRED_LABELS)} AS label,
         value AS valuenum
  FROM events)"""


# -------------------------------------------------------------------- model rows
def model_rows(spark, d):
    """One row per order: label = fully shipped order; features from its line
    items (null for orders without lines) and the order itself."""
    o = table(spark, d, "orders")
    li = table(spark, d, "lineitem")
    per_order = li.groupBy("l_orderkey").agg(
        F.avg("l_quantity").alias("ft_avg_qty"),
        F.avg("l_discount").alias("ft_avg_discount"),
        F.max((F.col("l_returnflag") == "R").cast("int")).alias("ft_returned"))
    j = o.join(per_order, o.o_orderkey == per_order.l_orderkey, "left")
    return j.select(
        F.col("o_orderkey").alias("hadm_id"),
        (F.col("o_orderstatus") == "F").cast("int").alias("hcc_cd_135"),
        "ft_avg_qty", "ft_avg_discount", "ft_returned",
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("ft_urgent"),
        (F.col("o_orderpriority") == "5-LOW").cast("int").alias("ft_admit_type_newborn"),
        F.lit(0).alias("ft_zero"),
        (F.col("o_totalprice") / 1000).alias("ft_total"),
    )


SQL_MODEL_ROWS = """model_r AS (
  SELECT o.o_orderkey AS hadm_id, CAST(o.o_orderstatus = 'F' AS INTEGER) AS hcc_cd_135,
         p.ft_avg_qty, p.ft_avg_discount, p.ft_returned,
         CAST(o.o_orderpriority = '1-URGENT' AS INTEGER) AS ft_urgent,
         CAST(o.o_orderpriority = '5-LOW' AS INTEGER) AS ft_admit_type_newborn,
         0 AS ft_zero, o.o_totalprice / 1000 AS ft_total
  FROM orders o LEFT JOIN (
    SELECT l_orderkey, avg(l_quantity) AS ft_avg_qty, avg(l_discount) AS ft_avg_discount,
           max(CAST(l_returnflag = 'R' AS INTEGER)) AS ft_returned
    FROM lineitem GROUP BY l_orderkey) p ON o.o_orderkey = p.l_orderkey)"""

MODEL_FEATURES = ["ft_avg_qty", "ft_avg_discount", "ft_returned", "ft_urgent", "ft_admit_type_newborn",
                  "ft_zero", "ft_total"]
