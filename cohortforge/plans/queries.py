"""Query registry: every operator run over the adapted test tables, with the
matching DuckDB oracle SQL where SQL can state the result.

Each query is ``fn(spark, sf_dir) -> DataFrame``. Output doubles are rounded
to 6 decimals on both sides and timestamps are rendered as text, so the
comparison is about values, not float formatting.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, TimestampNTZType, TimestampType

from cohortforge.operators import aggregates as ag
from cohortforge.operators import features as fx
from cohortforge.operators.joins import lookup_join, match_statistics, merge_features
from cohortforge.plans import pipeline as pl
from cohortforge.plans import presets as P
from cohortforge.plans.presets import EXTERNAL_MODELS, TREE_SETTINGS
from cohortforge.plans import sqlparts as S
from cohortforge.plans.sqlparts import cci, fl, hours_lt, tv, with_ctes
from cohortforge.sources import adapters as A

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, d: str) -> DataFrame:
            return tidy(fn(spark, d))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return deco


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, DoubleType):
            cols.append(F.round(F.col(f"`{f.name}`"), digits).alias(f.name))
        elif isinstance(f.dataType, (TimestampNTZType, TimestampType)):
            cols.append(F.col(f"`{f.name}`").cast("string").alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def r6(expr: str) -> str:
    return f"round({expr}, 6)"


BLOOD = tv("fluid = 'blood'")
IRON = tv("label = 'iron'")


# =========================================================================== labs
def _labs(spark, d):
    return fx.prepare_labs(A.lab_events(spark, d), A.lab_items(spark, d))


def _lab_sql(name: str, cond: str, hit: str, as_bool: bool = False) -> str:
    v = f"bool_or({tv(hit)})" if as_bool else f"max({fl(hit)})"
    return with_ctes(S.LABS_CTES, f"SELECT hadm_id, {v} AS {name} FROM labs WHERE {cond} GROUP BY hadm_id")


@query("threshold_flag_low", _lab_sql("ft_low_sodium", f"{cci('label', 'sodium')} AND {BLOOD}",
                                      "valuenum < 5"))
def q_threshold_low(spark, d):
    """Low-value flag on a lab test matched by label substring and fluid."""
    return fx.threshold_flag(_labs(spark, d), "ft_low_sodium", "<", 5, label_contains="sodium", fluid="blood")


@query("threshold_flag_high", _lab_sql("ft_high_potassium",
                                       f"{cci('label', 'potassium')} AND {BLOOD}",
                                       "valuenum > 300"))
def q_threshold_high(spark, d):
    return fx.threshold_flag(_labs(spark, d), "ft_high_potassium", ">", 300, label_contains="potassium",
                             fluid="blood")


@query("threshold_flag_exact", _lab_sql("ft_anemic", f"{IRON} AND {BLOOD}",
                                        "valuenum < 20", as_bool=True))
def q_threshold_exact(spark, d):
    return fx.threshold_flag(_labs(spark, d), "ft_anemic", "<", 20, label_equals="iron", fluid="blood",
                             as_bool=True)


# ==================================================================== label / categories
def _label(spark, d):
    return fx.category_label(A.diagnoses(spark, d), A.crosswalk(spark, d), A.admissions(spark, d))


@query("category_label", with_ctes(S.LABEL_CTES, "SELECT hadm_id, subject_id, hcc_cd_135, "
                                   "CAST(admittime AS VARCHAR) AS admittime, CAST(dischtime AS VARCHAR) AS dischtime "
                                   "FROM label_full"))
def q_category_label(spark, d):
    """Label per admission from code -> category map (m:1 checked) + times."""
    return _label(spark, d)


HCC19 = fl("hcc = '19'")
_MERGED = """merged AS (
  SELECT d.hadm_id, d.subject_id, x.hcc FROM diagnoses_r d LEFT JOIN crosswalk_r x ON d.icd9_code = x.icd
  WHERE d.hadm_id IS NOT NULL AND d.subject_id IS NOT NULL)"""


def _profile_sql(long_ctes: list[str], with_sum: bool = True) -> str:
    s = ", " + r6("sum(value)") + " AS sum" if with_sum else ""
    q = lambda p: r6(f"quantile_cont(l.value, {p})")
    return with_ctes(long_ctes, f"""
SELECT l.feature, count(l.value) AS count, {r6('avg(l.value)')} AS mean, {r6('stddev_samp(l.value)')} AS std,
       {r6('min(l.value)')} AS min, {q(0.25)} AS p25, {q(0.5)} AS p50, {q(0.75)} AS p75,
       {r6('max(l.value)')} AS max{s}
FROM long l GROUP BY l.feature""".lstrip())


_ONEHOT_LONG = """cats AS (SELECT DISTINCT hcc FROM merged WHERE hcc IS NOT NULL),
g AS (SELECT DISTINCT hadm_id, subject_id FROM merged),
hit AS (SELECT DISTINCT hadm_id, subject_id, hcc FROM merged WHERE hcc IS NOT NULL),
long AS (
  SELECT 'hcc_cd_' || c.hcc AS feature, CAST(CASE WHEN h.hcc IS NOT NULL THEN 1 ELSE 0 END AS DOUBLE) AS value
  FROM g CROSS JOIN cats c
  LEFT JOIN hit h ON h.hadm_id = g.hadm_id AND h.subject_id = g.subject_id AND h.hcc = c.hcc)"""


@query("category_onehot", with_ctes([A.SQL_DIAGNOSES, A.SQL_CROSSWALK, _MERGED, _ONEHOT_LONG.split(",\nlong AS")[0]], """
SELECT g.hadm_id, g.subject_id, 'hcc_cd_' || c.hcc AS feature,
       CASE WHEN h.hcc IS NOT NULL THEN 1 ELSE 0 END AS value
FROM g CROSS JOIN cats c
LEFT JOIN hit h ON h.hadm_id = g.hadm_id AND h.subject_id = g.subject_id AND h.hcc = c.hcc""".lstrip()))
def q_category_onehot(spark, d):
    """All categories one-hot per (admission, subject), shown in long form."""
    wide = fx.category_onehot(A.diagnoses(spark, d), A.crosswalk(spark, d))
    cols = [c for c in wide.columns if c.startswith("hcc_cd_")]
    return wide.unpivot(["hadm_id", "subject_id"], cols, "feature", "value")


@query("category_select", with_ctes([A.SQL_DIAGNOSES, A.SQL_CROSSWALK, _MERGED],
                                    f"SELECT hadm_id, max({HCC19}) AS ft_hcc_cd_19_dbtes_wo_comp "
                                    "FROM merged GROUP BY hadm_id, subject_id"))
def q_category_select(spark, d):
    """One category column, renamed; subject dropped."""
    onehot = fx.category_onehot(A.diagnoses(spark, d), A.crosswalk(spark, d))
    return fx.category_select(onehot, "19", "ft_hcc_cd_19_dbtes_wo_comp")


@query("unmapped_codes", with_ctes([A.SQL_DIAGNOSES, A.SQL_CROSSWALK, A.SQL_TITLES], """
SELECT t.short_title, count(*) AS n
FROM diagnoses_r d LEFT JOIN titles_r t ON d.icd9_code = t.icd9_code
WHERE NOT EXISTS (SELECT 1 FROM crosswalk_r x WHERE x.icd = d.icd9_code) AND t.short_title IS NOT NULL
GROUP BY t.short_title""".lstrip()))
def q_unmapped(spark, d):
    """Codes with no category, counted by title."""
    return fx.unmapped_codes(A.diagnoses(spark, d), A.crosswalk(spark, d), A.code_titles(spark, d))


@query("category_statistics", _profile_sql([A.SQL_DIAGNOSES, A.SQL_CROSSWALK, _MERGED, _ONEHOT_LONG]))
def q_category_statistics(spark, d):
    """describe + sum of every category column."""
    wide = fx.category_onehot(A.diagnoses(spark, d), A.crosswalk(spark, d))
    cols = [c for c in wide.columns if c.startswith("hcc_cd_")]
    return ag.profile_columns(wide, cols)


_PROFILE_COLS = ["l_quantity", "l_discount", "l_tax"]


@query("feature_profile", _profile_sql(["long AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM lineitem" for c in _PROFILE_COLS) + ")"]))
def q_feature_profile(spark, d):
    """Transposed describe (count, mean, std, min, quartiles, max, sum)."""
    return ag.profile_columns(A.table(spark, d, "lineitem"), _PROFILE_COLS)


# ============================================================================ charts
def _clean(spark, d, item_filter=None):
    return fx.clean_events(A.charts(spark, d), A.items(spark, d), _label(spark, d), item_filter=item_filter)


def _dedup(spark, d, item_filter=True):
    return pl.clean_chart_events(A.charts(spark, d), A.items(spark, d), _label(spark, d),
                                 item_filter=pl.chart_item_filter() if item_filter else None)


def _readings(spark, d, item_filter, columns=pl.CHART_COLUMNS, with_label=False):
    """First readings of the items of one feature, narrow, written once, and the label
    frame (with its check of the codes), which joins the readings only ``with_label``.
    An item is part of the key, so the other items can go before the de-duplication."""
    from cohortforge.session import materialize
    label = _label(spark, d)
    ev = materialize(pl.clean_chart_events(A.charts(spark, d), A.items(spark, d), None, item_filter=item_filter, columns=columns), "readings")
    if with_label:
        label = materialize(label, "label")
        ev = ev.join(label, on=["subject_id", "hadm_id"], how="left")
    return ev, label


_TIMES = ("hadm_id", "itemid", "eventtime", "valuenum", "label", "row_order")


@query("clean_events", with_ctes(S.EVENTS_CTES, """
SELECT hadm_id, subject_id, itemid, CAST(charttime AS VARCHAR) AS charttime, CAST(storetime AS VARCHAR) AS storetime,
       CAST(eventtime AS VARCHAR) AS eventtime, value, valuenum, label, category, hcc_cd_135,
       CAST(admittime AS VARCHAR) AS admittime FROM ev2""".lstrip()))
def q_clean_events(spark, d):
    """Events + dictionary + parsed times/values + normalised category + label."""
    ev = _clean(spark, d)
    return ev.select("hadm_id", "subject_id", "itemid", "charttime", "storetime", "eventtime", "value", "valuenum",
                     "label", "category", "hcc_cd_135", "admittime")


@query("match_statistics", with_ctes(S.EVENTS_CTES, "SELECT _d_items, count(*) AS n FROM ev GROUP BY _d_items"))
def q_match_statistics(spark, d):
    """Matched / unmatched event counts of the dictionary join."""
    joined = lookup_join(A.charts(spark, d), A.items(spark, d), "itemid", indicator="_d_items")
    return match_statistics(joined, "_d_items")


@query("dedupe_first", with_ctes(S.EVENTS_CTES, "SELECT hadm_id, itemid, CAST(eventtime AS VARCHAR) AS eventtime, "
                                 "value, valuenum FROM dd"))
def q_dedupe(spark, d):
    """First reading per (admission, item, instant) in file order."""
    return _dedup(spark, d, item_filter=False).select("hadm_id", "itemid", "eventtime", "value", "valuenum")


# ======================================================================== procedures
_CODES = ["3", "7", "12", "21", "7"]
_CODE_LIST_SQL = "(" + ", ".join(f"'{c}'" for c in dict.fromkeys(_CODES)) + ")"


@query("code_list_flag", with_ctes([A.SQL_PROCEDURES], f"""
SELECT hadm_id, max({fl(f'cpt_cd IN {_CODE_LIST_SQL}')}) AS ft_contrast_imaging
FROM procedures_r WHERE hadm_id IS NOT NULL GROUP BY hadm_id""".lstrip()))
def q_code_list(spark, d):
    return fx.code_list_flag(A.procedures(spark, d), _CODES)


@query("code_prefix_flag", with_ctes([A.SQL_PROCEDURES], f"""
SELECT hadm_id, max({fl(f'cpt_cd IN {_CODE_LIST_SQL}')}) AS ft_contrast_imaging
FROM procedures_r WHERE hadm_id IS NOT NULL AND (starts_with(cpt_cd, '1') OR starts_with(cpt_cd, '2'))
GROUP BY hadm_id""".lstrip()))
def q_code_prefix(spark, d):
    return fx.code_prefix_flag(A.procedures(spark, d), ["1", "2"], _CODES)


@query("code_and_text_flag", with_ctes([A.SQL_PROCEDURES], f"""
SELECT hadm_id, max({fl("cpt_cd = '7'")} * {fl("contains(lower(description), 'ring')")}) AS ft_mechanical_ventilation
FROM procedures_r WHERE hadm_id IS NOT NULL GROUP BY hadm_id""".lstrip()))
def q_code_text(spark, d):
    return fx.code_and_text_flag(A.procedures(spark, d), "7", "ring")


# =================================================================== keyword groups
_GROUPS = {"shape": ["ring", "bolt", "gear"], "size": ["small", "large"], "temp": ["hot", "cold"]}
_GHOURS = (24, 240, 2400)


def _keyword_sql(parts: bool = False, groups=_GROUPS, hours=_GHOURS, source: str | None = None):
    words = [w for ws in groups.values() for w in ws]

    def hit(ws):
        return "(" + " OR ".join(f"coalesce(contains(lower(p.drug), '{w}'), false)" for w in ws) + ")"

    def win(h):
        return hours_lt("p.startdate", "a.admittime", h)

    cols = [f"max(CAST({hit(words)} AS INTEGER)) AS ft_any_nephrotoxin_rx"]
    cols += [f"max(CAST({hit(words)} AND {win(h)} AS INTEGER)) AS ft_any_nephrotoxin_rx_within_{h}" for h in hours]
    for g, ws in groups.items():
        for w in ws:
            cols.append(f"max(CAST({hit([w])} AS INTEGER)) AS ft_nephrotoxin_{w}_rx")
            cols += [f"max(CAST({hit([w])} AND {win(h)} AS INTEGER)) AS ft_nephrotoxin_{w}_rx_within_{h}"
                     for h in hours]
        cols.append(f"max(CAST({hit(ws)} AS INTEGER)) AS ft_nephrotoxin_{g}_rx")
        cols += [f"max(CAST({hit(ws)} AND {win(h)} AS INTEGER)) AS ft_nephrotoxin_{g}_rx_within_{h}" for h in hours]
    ctes = [source or A.SQL_PRESCRIPTIONS, A.SQL_ADMISSIONS]
    body = f"""
SELECT p.hadm_id, {', '.join(cols)}
FROM prescriptions_r p LEFT JOIN admissions_r a ON p.hadm_id = a.hadm_id AND p.subject_id = a.subject_id
WHERE p.hadm_id IS NOT NULL GROUP BY p.hadm_id""".lstrip()
    return (ctes, body) if parts else with_ctes(ctes, body)


@query("keyword_group_windows", _keyword_sql())
def q_keyword(spark, d):
    """Keyword / group / any flags, each also within x hours of admission."""
    return fx.keyword_group_windows(A.prescriptions(spark, d), A.admissions(spark, d), _GROUPS, _GHOURS)


def _drug_words(groups) -> list[str]:
    return [w for ws in groups.values() for w in ws]


@query("keyword_groups_preset", _keyword_sql(groups=P.DRUG_GROUPS, hours=P.DRUG_WINDOW_HOURS, source=A.sql_drug_orders(_drug_words(P.DRUG_GROUPS))))
def q_keyword_preset(spark, d):
    """All drugs and groups of the preset with their three windows."""
    return fx.keyword_group_windows(A.drug_orders(spark, d, _drug_words(P.DRUG_GROUPS)), A.admissions(spark, d), P.DRUG_GROUPS, P.DRUG_WINDOW_HOURS)


@query("keyword_groups_older", _keyword_sql(groups=P.DRUG_GROUPS_V1, hours=P.DRUG_WINDOW_HOURS, source=A.sql_drug_orders(_drug_words(P.DRUG_GROUPS_V1))))
def q_keyword_older(spark, d):
    """The older drug list with the group of its own name."""
    return fx.keyword_group_windows(A.drug_orders(spark, d, _drug_words(P.DRUG_GROUPS_V1)), A.admissions(spark, d), P.DRUG_GROUPS_V1, P.DRUG_WINDOW_HOURS)


# ==================================================================== other visits
_OV_PARTS = ([A.SQL_ADMISSIONS, A.SQL_STAYS, f"""ov_p AS (
  SELECT x.hadm_id, y.hadm_id AS h2,
         floor((epoch(y.admittime) - epoch(x.dischtime)) / 86400) AS dd
  FROM admissions_r x JOIN admissions_r y ON x.subject_id = y.subject_id AND x.hadm_id <> y.hadm_id),
ov_q AS (SELECT p.*, s.los, lower(s.last_careunit) AS cu FROM ov_p p LEFT JOIN stays_r s ON p.h2 = s.hadm_id)"""], f"""
SELECT hadm_id,
  max({fl('dd < 30')}) AS ft_prior_admission_30, max({fl('dd < 60')}) AS ft_prior_admission_60,
  max({fl('dd < 90')}) AS ft_prior_admission_90, max({fl('dd < 120')}) AS ft_prior_admission_120,
  {r6('max(CASE WHEN dd < 30 THEN los END)')} AS ft_avg_icu_los_within_30,
  max({fl("cu = 'micu'")} * {fl('dd < 30')}) AS ft_micu_within_30,
  max({fl("cu = 'ccu'")} * {fl('dd < 30')}) AS ft_ccu_within_30
FROM ov_q GROUP BY hadm_id""")
_OV_SQL = with_ctes(*_OV_PARTS)


@query("other_visits_within_days", _OV_SQL)
def q_other_visits(spark, d):
    """Other admissions of the same subject within N days (as-of, no self-join)."""
    return fx.other_visits_within_days(A.admissions(spark, d), A.stays(spark, d))


_OVP_SQL = with_ctes([A.SQL_ADMISSIONS, A.SQL_STAYS, f"""ovp_p AS (
  SELECT x.hadm_id, y.hadm_id AS h2,
         CASE WHEN y.admittime < x.admittime THEN (epoch(x.admittime) - epoch(y.dischtime)) / 86400 END AS gd
  FROM admissions_r x JOIN admissions_r y ON x.subject_id = y.subject_id AND x.hadm_id <> y.hadm_id),
ovp_q AS (SELECT p.*, s.los, lower(s.last_careunit) AS cu FROM ovp_p p LEFT JOIN stays_r s ON p.h2 = s.hadm_id)"""], f"""
SELECT hadm_id,
  max({fl('gd < 30')}) AS ft_prior_admission_30, max({fl('gd < 60')}) AS ft_prior_admission_60,
  max({fl('gd < 90')}) AS ft_prior_admission_90, max({fl('gd < 120')}) AS ft_prior_admission_120,
  {r6('max(CASE WHEN gd < 30 THEN los END)')} AS ft_avg_icu_los_within_30,
  max({fl("cu = 'micu'")} * {fl('gd < 30')}) AS ft_micu_within_30,
  max({fl("cu = 'ccu'")} * {fl('gd < 30')}) AS ft_ccu_within_30
FROM ovp_q GROUP BY hadm_id""")


@query("other_visits_prior", _OVP_SQL)
def q_other_visits_prior(spark, d):
    """Earlier admissions of the subject discharged less than N days before
    this admission (``direction="prior"``: dyadic position blocks, no pairs)."""
    return fx.other_visits_within_days(A.admissions(spark, d), A.stays(spark, d), direction="prior")


# ==================================================================== demographics
_TYPES = ["1-urgent", "2-high", "3-medium", "4-not specified", "5-low"]
_RACES = ["asian_chinese", "black_african_american", "hispanic_latino_puerto_rican", "hispanic_or_latino", "white"]
_FOLD = ["patient_declined_to_answer", "unknown_not_specified"]
_ETH_NORM = "replace(replace(replace(replace(lower(a.ethnicity), '/', '_'), ' ', '_'), '-', ''), '__', '_')"


def _demo_sql(parts: bool = False, norm: str = _ETH_NORM, races: list | None = None, fold_list: list | None = _FOLD,
              fold_name: str = "ft_race_missing_info"):
    races = _RACES if races is None else races
    cols = [f"max({fl(f'lower(a.admission_type) = ' + chr(39) + t + chr(39))}) AS \"ft_admit_type_{t}\""
            for t in _TYPES]
    cols += [f"max({fl(f'{norm} = ' + chr(39) + r + chr(39))}) AS \"ft_race_{r}\"" for r in races]
    if fold_list:
        fold = " OR ".join(f"{norm} = '{r}'" for r in fold_list)
        cols.append(f"max({fl(fold)}) AS {fold_name}")
    days = "floor((epoch(a.admittime) - epoch(p.dob)) / 86400)"
    ctes = [A.SQL_ADMISSIONS, A.SQL_PATIENTS]
    body = f"""
SELECT a.hadm_id,
  {r6(f'avg(CASE WHEN {days} / 365.25 >= -1 AND {days} <= 106751 THEN {days} / 365.25 END)')} AS ft_age,
  first(CASE p.gender WHEN 'F' THEN 0 WHEN 'M' THEN 1 END) AS ft_gender,
  {', '.join(cols)}
FROM admissions_r a LEFT JOIN patients_r p ON a.subject_id = p.subject_id
WHERE a.hadm_id IS NOT NULL GROUP BY a.hadm_id""".lstrip()
    return (ctes, body) if parts else with_ctes(ctes, body)


def _demo(spark, d):
    return fx.demographics(A.admissions(spark, d), A.patients(spark, d))


_ETH_NORM_V1 = "replace(replace(lower(a.ethnicity), '/', '_'), ' ', '_')"
_RACES_V1 = ["asian_-_chinese", "black_african_american", "hispanic_latino_-_puerto_rican", "hispanic_or_latino",
             "patient_declined_to_answer", "unknown_not_specified", "white"]


@query("demographics", _demo_sql())
def q_demographics(spark, d):
    """Gender, age, one-hot admission type and ethnicity with unknowns folded."""
    return _demo(spark, d)


@query("demographics_v1", _demo_sql(norm=_ETH_NORM_V1, races=_RACES_V1, fold_list=None))
def q_demographics_v1(spark, d):
    """Oldest form: older ethnicity normaliser, unknown classes not folded."""
    from cohortforge.functions import normalize_ethnicity_v1
    return fx.demographics(A.admissions(spark, d), A.patients(spark, d), fold=None,
                           normalizer=normalize_ethnicity_v1)


@query("demographics_dev", _demo_sql(norm=_ETH_NORM_V1, races=[r for r in _RACES_V1 if r not in _FOLD], fold_name="ft_race_missing_information"))
def q_demographics_dev(spark, d):
    """Development form: older normaliser, unknown classes folded under another name."""
    from cohortforge.functions import normalize_ethnicity_v1
    return fx.demographics(A.admissions(spark, d), A.patients(spark, d), fold_name="ft_race_missing_information",
                           normalizer=normalize_ethnicity_v1)


# ================================================================== chart features
def _ph_sql(masked: bool, parts: bool = False, means: bool = True):
    low = "valuenum < 7.3"
    flags = {"ft_low_blood_ph": tv(low)}
    for h in (6, 12, 24, 36, 48):
        flags[f"ft_low_blood_ph_within_{h}_hrs"] = f"({tv(low)} AND {hours_lt('eventtime', 'admittime', h)})"
    cols = [f"max(CAST({c} AS INTEGER)) AS {k}" for k, c in flags.items()]
    for k, c in flags.items() if means else ():
        v = f"CASE WHEN {c} THEN valuenum END" if masked else "valuenum"
        cols.append(f"{r6(f'avg({v})')} AS {k.replace('ft_', 'ft_avg_', 1)}")
    if means:
        cols.append(f"{r6('avg(valuenum)')} AS ft_blood_ph")
    body = f"""
SELECT hadm_id, {', '.join(cols)} FROM dd
WHERE (coalesce(contains(label, 'pH'), false) OR coalesce(contains(label, 'PH'), false)) AND hadm_id IS NOT NULL
GROUP BY hadm_id""".lstrip()
    return (S.EVENTS_CTES, body) if parts else with_ctes(S.EVENTS_CTES, body)


@query("low_value_windows", _ph_sql(False))
def q_low_value(spark, d):
    """Low blood pH flags within x hours; means unmasked (as originally defined)."""
    ev, label = _readings(spark, d, pl.chart_item_filter(()))
    return fx.low_value_windows(ev, anchors=label)


@query("low_value_flags_only", _ph_sql(False, means=False))
def q_low_value_flags(spark, d):
    """Older form: the six low-pH flags without the means."""
    ev, label = _readings(spark, d, pl.chart_item_filter(()))
    return fx.low_value_windows(ev, with_means=False, anchors=label)


@query("low_value_windows_masked", _ph_sql(True))
def q_low_value_masked(spark, d):
    return fx.low_value_windows(_readings(spark, d, pl.chart_item_filter(()), with_label=True)[0], masked=True)


def _bp_sql(src: str, ctes: list[str], parts: bool = False, low: bool = True):
    excl = " AND ".join(f"NOT {cci('label', w)}" for w in ("unloading", "pulmonary", "pap"))
    s2 = "(s.valuenum BETWEEN 140 AND 179 OR d.valuenum BETWEEN 90 AND 119)"
    cols = [f"max({fl('s.valuenum BETWEEN 120 AND 129')} * {fl('d.valuenum < 80')}) AS ft_elevated_bp",
            *([f"max({fl('s.valuenum < 119')} * {fl('d.valuenum < 79')}) AS ft_abnormally_low_bp"] if low else []),
            f"max({fl('s.valuenum BETWEEN 130 AND 139 OR d.valuenum BETWEEN 80 AND 89')}) AS ft_hbp_stg_1",
            f"max({fl(s2)}) AS ft_hbp_stg_2",
            f"max({fl('s.valuenum > 180 OR d.valuenum > 120')}) AS ft_hbp_crisis"]
    cols += [f"max(CAST({tv(s2)} AND {hours_lt('s.eventtime', 's.admittime', h)} AS INTEGER)) "
             f"AS ft_hbp_stg_2_within_{h}_hours" for h in (6, 12, 24, 36, 48)]
    ctes = ctes + [f"""
sy AS (SELECT * FROM {src} WHERE {cci('label', 'systolic')} AND {excl} AND hadm_id IS NOT NULL),
di AS (SELECT * FROM {src} WHERE {cci('label', 'diastolic')} AND {excl} AND hadm_id IS NOT NULL)""".strip()]
    body = f"""
SELECT s.hadm_id, {', '.join(cols)}
FROM sy s JOIN di d ON s.hadm_id = d.hadm_id AND s.eventtime IS NOT DISTINCT FROM d.eventtime
GROUP BY s.hadm_id""".lstrip()
    return (ctes, body) if parts else with_ctes(ctes, body)


@query("paired_reading_bands", _bp_sql("paired_r", [A.SQL_PAIRED]))
def q_paired(spark, d):
    """Blood-pressure bands over co-occurring readings (pre-aggregated, no pairs)."""
    return fx.paired_reading_bands(A.paired_readings_input(spark, d))


def _hema_sql(parts: bool = False):
    v = "valuenum"
    male = tv("g.ft_gender = 1")
    above = f"({male} AND {tv(v + ' > 50')}) OR (NOT {male} AND {tv(v + ' > 47')})"
    below = f"({male} AND {tv(v + ' < 42')}) OR (NOT {male} AND {tv(v + ' < 37')})"
    ctes = S.EVENTS_CTES + [A.SQL_PATIENTS, S.DEMO_GENDER]
    body = f"""
SELECT dd.hadm_id, {r6(f'avg({v})')} AS ft_avg_hematocrit,
  max(CAST({above} AS INTEGER)) AS ft_above_normal_hematocrit,
  max(CAST({below} AS INTEGER)) AS ft_below_normal_hematocrit,
  max({fl(v + ' < 20')}) AS ft_way_below_normal_hematocrit
FROM dd LEFT JOIN demo_gender g ON dd.hadm_id = g.hadm_id
WHERE {cci('label', 'hematocrit')} AND NOT {cci('label', 'apache')} AND dd.hadm_id IS NOT NULL
GROUP BY dd.hadm_id""".lstrip()
    return (ctes, body) if parts else with_ctes(ctes, body)


@query("group_reference_range", _hema_sql())
def q_group_range(spark, d):
    """Hematocrit above / below a gender-dependent range (unknown -> other range)."""
    ev, _ = _readings(spark, d, pl.chart_item_filter(("hematocrit",), ()), _TIMES)
    return fx.group_reference_range(ev, fx.gender_frame(A.admissions(spark, d), A.patients(spark, d)))


def _creat_sql(parts: bool = False, baseline: bool = True):
    ctes = S.EVENTS_CTES + [S.serial_rows()]
    body = f"""
SELECT hadm_id,
  max(CAST({tv('delta >= 0.3')} AND {tv('(epoch(eventtime) - epoch(prev_t)) <= 172800')} AS INTEGER))
    AS ft_creatinine_increase_within_48,
  max({fl('valuenum >= 1.5 * baseline')}) AS ft_creatinine_increase_from_baseline,
  max({fl('baseline > 1')}) AS ft_baseline_creat_gt_1,{(' ' + r6('avg(baseline)') + ' AS ft_baseline_creatinine,') if baseline else ''}
  {r6('avg(valuenum)')} AS ft_avg_creatinine
FROM cr2 GROUP BY hadm_id""".lstrip()
    return (ctes, body) if parts else with_ctes(ctes, body)


@query("serial_change", _creat_sql())
def q_serial(spark, d):
    """Rise against previous reading within 48 h, against baseline, levels."""
    return fx.serial_change(_readings(spark, d, pl.chart_item_filter(("creatin",), ()), _TIMES)[0])


_AUDIT = dict(match="e", max_value=150, rise_hours=2400)


def _creat_audit_sql() -> str:
    secs = _AUDIT["rise_hours"] * 3600
    rise = f"CAST({tv('delta >= 0.3')} AND {tv(f'(epoch(eventtime) - epoch(prev_t)) <= {secs}')} AS INTEGER)"
    rows = S.serial_rows(match=_AUDIT["match"], max_value=_AUDIT["max_value"])
    return with_ctes(S.EVENTS_CTES + [rows, f"a AS (SELECT *, {rise} AS rise FROM cr2)"], f"""
SELECT hadm_id, {r6('valuenum')} AS valuenum, {r6('delta')} AS delta,
  {r6('(epoch(eventtime) - epoch(prev_t)) / 3600')} AS delta_hours, {r6('baseline')} AS baseline,
  rise AS ft_creatinine_increase_within_2400,
  {fl('valuenum >= 1.5 * baseline')} AS ft_creatinine_increase_from_baseline,
  {fl('baseline > 1')} AS ft_baseline_creat_gt_1
FROM a WHERE hadm_id IN (SELECT hadm_id FROM a GROUP BY hadm_id HAVING max(rise) = 1)""".lstrip())


@query("serial_change_audit", _creat_audit_sql())
def q_serial_audit(spark, d):
    """Row-level audit of the admissions with a rise (wide match so that the
    test tables produce rows)."""
    ev, _ = _readings(spark, d, pl.chart_item_filter((_AUDIT["match"],), ()), with_label=True)
    return fx.serial_change_audit(ev, **_AUDIT)


_URINE_VALUES = ["clear", "red", "yellow"]


def _urine_sql(how: str = "FULL OUTER") -> str:
    def side(label, prefix, alias):
        cols = ", ".join(f"max({fl(f'lower(value) = {chr(39)}{v}{chr(39)}')}) AS {prefix}_{v}" for v in _URINE_VALUES)
        return (f"{alias} AS (SELECT hadm_id, {cols} FROM dd WHERE {cci('label', 'urine')} AND hadm_id IS NOT NULL "
                f"AND replace(replace(label, '[', ''), ']', '') = '{label}' GROUP BY hadm_id)")
    sel = ", ".join([f"c.ft_urine_color_{v}" for v in _URINE_VALUES] +
                    [f"a.ft_urine_appearance_{v}" for v in _URINE_VALUES])
    return with_ctes(S.EVENTS_CTES + [side("Urine Color", "ft_urine_color", "col"),
                                      side("Urine Appearance", "ft_urine_appearance", "app")], f"""
SELECT coalesce(c.hadm_id, a.hadm_id) AS hadm_id, {sel}
FROM col c {how} JOIN app a ON c.hadm_id = a.hadm_id""".lstrip())


def _urine(spark, d):
    return _readings(spark, d, pl.chart_item_filter(("urine",), ()), ("hadm_id", "itemid", "eventtime", "value", "label", "row_order"))[0]


@query("categorical_readings_onehot", _urine_sql())
def q_urine(spark, d):
    """One-hot text readings per exact label, sides aggregated then outer-joined."""
    return fx.categorical_readings_onehot(_urine(spark, d))


@query("categorical_readings_left", _urine_sql("LEFT"))
def q_urine_left(spark, d):
    """Older form: sides left-joined, so entities of the later sides only are lost."""
    return fx.categorical_readings_onehot(_urine(spark, d), how="left")


# =========================================================================== merges
def _merge_sql() -> str:
    return with_ctes(S.LABEL_CTES + [A.SQL_PROCEDURES, S.LABS_CTES[0], S.LABS_CTES[1], S.LABS, f"""f1 AS (SELECT hadm_id, hcc_cd_135 FROM label_g),
f2 AS (SELECT hadm_id, max({fl("cpt_cd IN ('3', '7', '12', '21')")}) AS ft_contrast_imaging
       FROM procedures_r WHERE hadm_id IS NOT NULL GROUP BY hadm_id),
f3 AS (SELECT hadm_id, max({fl('valuenum < 5')}) AS ft_low_sodium FROM labs
       WHERE {cci('label', 'sodium')} AND {BLOOD} GROUP BY hadm_id),
f4 AS (SELECT hadm_id, max({fl("cpt_cd = '7'")} * {fl("contains(lower(description), 'ring')")})
         AS ft_mechanical_ventilation FROM procedures_r WHERE hadm_id IS NOT NULL GROUP BY hadm_id),
k AS (SELECT hadm_id FROM f1 UNION SELECT hadm_id FROM f2 UNION SELECT hadm_id FROM f3 UNION SELECT hadm_id FROM f4)"""], """
SELECT k.hadm_id, f1.hcc_cd_135, f2.ft_contrast_imaging, f3.ft_low_sodium, f4.ft_mechanical_ventilation
FROM k LEFT JOIN f1 ON k.hadm_id = f1.hadm_id LEFT JOIN f2 ON k.hadm_id = f2.hadm_id
LEFT JOIN f3 ON k.hadm_id = f3.hadm_id LEFT JOIN f4 ON k.hadm_id = f4.hadm_id""")


@query("merge_features", _merge_sql())
def q_merge(spark, d):
    """N-way full outer merge on the entity in one shuffle."""
    label = _label(spark, d).select("hadm_id", "hcc_cd_135")
    proc = A.procedures(spark, d)
    sodium = fx.threshold_flag(_labs(spark, d), "ft_low_sodium", "<", 5, label_contains="sodium", fluid="blood")
    return merge_features([label, fx.code_list_flag(proc, _CODES), sodium, fx.code_and_text_flag(proc, "7", "ring")])


# ============================================================ chart features (flagship)
def _chart_features_sql(as_parts: bool = False):
    parts = [("f_creat", _creat_sql(parts=True)), ("f_hema", _hema_sql(parts=True)),
             ("f_bp", _bp_sql("dd", S.EVENTS_CTES, parts=True)), ("f_ph", _ph_sql(False, parts=True))]
    ctes = []
    for name, (c, body) in parts:
        ctes += c + [f"{name} AS ({body})"]
    keys = " UNION ".join(f"SELECT hadm_id FROM {n}" for n, _ in parts)
    ctes.append(f"ck AS ({keys})")
    joins = " ".join(f"LEFT JOIN {n} ON ck.hadm_id = {n}.hadm_id" for n, _ in parts)
    body = f"SELECT ck.hadm_id, {', '.join(n + '.* EXCLUDE (hadm_id)' for n, _ in parts)} FROM ck {joins}"
    return (ctes, body) if as_parts else with_ctes(ctes, body)


@query("chart_features_all_bins", _chart_features_sql())
def q_chart_features(spark, d):
    """Flagship: creatinine, hematocrit, blood pressure and blood pH features
    of all hash bins in one job, merged per admission in one shuffle."""
    gender = fx.gender_frame(A.admissions(spark, d), A.patients(spark, d))
    return pl.chart_features(A.charts(spark, d), A.items(spark, d), _label(spark, d), gender)


@query("paired_reading_bands_no_low", _bp_sql("dd", S.EVENTS_CTES, low=False))
def q_paired_no_low(spark, d):
    """Older band set (no low band) on the chart events."""
    bands = {k: v for k, v in P.PRESSURE_BANDS.items() if k != "ft_abnormally_low_bp"}
    ev, label = _readings(spark, d, pl.chart_item_filter(("systolic", "diastolic"), ()))
    return fx.paired_reading_bands(ev, bands=bands, anchors=label)


@query("serial_change_no_baseline", _creat_sql(baseline=False))
def q_serial_v1(spark, d):
    """Older creatinine set without the baseline level column."""
    return fx.serial_change(_readings(spark, d, pl.chart_item_filter(("creatin",), ()), _TIMES)[0], with_baseline=False)


# ====================================================================== bins and io
def _scratch(spark, name):
    import uuid
    from cohortforge.session import scratch_path
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


_BIN = "substr(md5(CAST(hadm_id AS VARCHAR)), 1, 2)"


@query("hash_bins", with_ctes([A.SQL_CHARTS], f"SELECT {_BIN} AS bin_id, count(*) AS n FROM charts_r GROUP BY 1"))
def q_hash_bins(spark, d):
    """Hash-partitioned sink (256 md5 bins of the entity), read back: rows per bin."""
    from cohortforge.sources.io import read_bins, write_hash_bins
    path = _scratch(spark, "bins")
    write_hash_bins(A.charts(spark, d), path, "hadm_id")
    return ag.value_counts(read_bins(spark, path), "bin_id")


_SOME_BINS = ["00", "ff", "22", "3e"]


@query("hash_bin_roundtrip", with_ctes([A.SQL_CHARTS], f"""
SELECT hadm_id, itemid, CAST(charttime AS VARCHAR) AS charttime, {_BIN} AS bin_id FROM charts_r
WHERE {_BIN} IN ('00', 'ff', '22', '3e')""".lstrip()))
def q_hash_bin_roundtrip(spark, d):
    """Write the bins, read a few back (partition pruning keeps the others unread)."""
    from cohortforge.sources.io import read_bins, write_hash_bins
    path = _scratch(spark, "bins")
    write_hash_bins(A.charts(spark, d), path, "hadm_id")
    return read_bins(spark, path, _SOME_BINS).select("hadm_id", "itemid", "charttime", "bin_id")


@query("bin_row_cap", with_ctes([A.SQL_CHARTS], f"""
SELECT hadm_id, itemid, bin_id FROM (
  SELECT hadm_id, itemid, {_BIN} AS bin_id,
         row_number() OVER (PARTITION BY {_BIN} ORDER BY {A.SQL_ROW_ORDER}) AS rn FROM charts_r)
WHERE rn <= 50""".lstrip()))
def q_bin_row_cap(spark, d):
    """Row-cap option: first n rows of each bin in file order."""
    from cohortforge.operators.windows import first_n_in_order
    from cohortforge.sources.io import with_hash_bin
    c = with_hash_bin(A.charts(spark, d), "hadm_id")
    return first_n_in_order(c, "bin_id", "row_order", 50).select("hadm_id", "itemid", "bin_id")


@query("csv_roundtrip", "SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, "
                        "CAST(n_regionkey AS BIGINT) AS n_regionkey FROM nation")
def q_csv_roundtrip(spark, d):
    """gzip CSV with upper-case headers, read back as text from a folder
    catalog, lower-cased and typed."""
    from cohortforge.sources.io import TableSpec, apply_types, read_table_folder
    folder = _scratch(spark, "csv")
    nation = A.table(spark, d, "nation")
    nation.toDF(*[c.upper() for c in nation.columns]).write.option("header", True) \
        .option("compression", "gzip").csv(f"{folder}/NATION.csv.gz")
    tables = read_table_folder(spark, folder)
    spec = TableSpec("nation", {"n_nationkey": "long", "n_regionkey": "long"})
    return apply_types(tables["nation"], spec)


@query("value_share", """
SELECT o_orderstatus, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM orders WHERE o_orderstatus IS NOT NULL GROUP BY o_orderstatus""".strip())
def q_value_share(spark, d):
    """Normalised value counts."""
    return ag.value_share(A.table(spark, d, "orders"), "o_orderstatus")


@query("label_counts", with_ctes(S.LABEL_CTES, "SELECT hcc_cd_135, count(*) AS n FROM label_full "
                                               "WHERE hcc_cd_135 IS NOT NULL GROUP BY hcc_cd_135"))
def q_label_counts(spark, d):
    """Label frequencies, most frequent first."""
    return ag.value_counts(_label(spark, d), "hcc_cd_135").orderBy(F.desc("n"))


# ==================================================================== model dataset
from cohortforge.operators import dataset as ds  # noqa: E402
from cohortforge.operators import selection as sel  # noqa: E402

_MODEL_COLS = ["hadm_id", "hcc_cd_135"] + A.MODEL_FEATURES


def _model(spark, d):
    return A.model_rows(spark, d)


@query("exclude_subgroup", with_ctes([A.SQL_MODEL_ROWS], "SELECT * FROM model_r WHERE ft_admit_type_newborn = 0"))
def q_exclude(spark, d):
    """Drop a subgroup (null drops too)."""
    return ds.exclude_subgroup(_model(spark, d))


@query("undersample", with_ctes([A.SQL_MODEL_ROWS], """
SELECT * FROM model_r WHERE hcc_cd_135 = 1
UNION ALL
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (ORDER BY md5('42' || CAST(hadm_id AS VARCHAR)), hadm_id) AS rn
  FROM model_r WHERE hcc_cd_135 = 0)
WHERE rn <= (SELECT count(*) FROM model_r WHERE hcc_cd_135 = 1)""".lstrip()))
def q_undersample(spark, d):
    """As many hash-chosen negatives as positives (exact count)."""
    return ds.undersample(_model(spark, d))


_SPLIT_SQL = ("CASE WHEN b < 7 THEN 'train' WHEN b IN (7, 8) THEN 'valid' WHEN b = 9 THEN 'test' END")
_BUCKET_SQL = "(('0x' || substr(md5('42' || CAST(hadm_id AS VARCHAR)), 1, 8))::BIGINT % 10)"


@query("sample_rows", with_ctes([A.SQL_MODEL_ROWS], """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (ORDER BY md5('7' || CAST(hadm_id AS VARCHAR)), hadm_id) AS rn FROM model_r)
WHERE rn <= 25""".lstrip()))
def q_sample(spark, d):
    """Random sample of n rows (hash order, reproducible): the limit is the feature."""
    return ds.hash_take(_model(spark, d), 25, seed="7")


@query("split_buckets", with_ctes([A.SQL_MODEL_ROWS], f"""
SELECT hadm_id, {_SPLIT_SQL} AS split FROM (SELECT hadm_id, {_BUCKET_SQL} AS b FROM model_r)""".lstrip()))
def q_split(spark, d):
    """Stable hash split 70 / 20 / 10."""
    return ds.split_buckets(_model(spark, d)).select("hadm_id", "split")


_MEAN_FILL = """mean_f AS (
  SELECT * REPLACE (coalesce(ft_avg_qty, (SELECT avg(ft_avg_qty) FROM model_r)) AS ft_avg_qty,
                    coalesce(ft_avg_discount, (SELECT avg(ft_avg_discount) FROM model_r)) AS ft_avg_discount)
  FROM model_r)"""
_MODE_FILL = """mode_v AS (
  SELECT ft_returned AS v FROM mean_f WHERE ft_returned IS NOT NULL
  GROUP BY ft_returned ORDER BY count(*) DESC, ft_returned LIMIT 1),
mode_f AS (SELECT * REPLACE (coalesce(ft_returned, (SELECT v FROM mode_v)) AS ft_returned) FROM mean_f)"""


@query("impute_mean", with_ctes([A.SQL_MODEL_ROWS, _MEAN_FILL], "SELECT * FROM mean_f"))
def q_impute_mean(spark, d):
    """Mean-fill the float columns picked by name (age / avg / los)."""
    df = _model(spark, d)
    cols = [c for c in df.columns if any(h in c for h in ds.MEAN_HINTS)]
    return df.fillna({k: v for k, v in ag.column_means(df, cols).items() if v is not None})


@query("impute_mode", with_ctes([A.SQL_MODEL_ROWS, _MEAN_FILL, _MODE_FILL], "SELECT * FROM mode_f"))
def q_impute_mode(spark, d):
    """Then mode-fill (smallest on ties) every column still holding nulls."""
    pre = ds.fit_preprocess(_model(spark, d))
    df = _model(spark, d).fillna({k: v for k, v in pre.means.items() if v is not None})
    return df.fillna({k: v for k, v in pre.modes.items() if v is not None})


@query("drop_all_zero", with_ctes([A.SQL_MODEL_ROWS, _MEAN_FILL, _MODE_FILL], "SELECT * EXCLUDE (ft_zero) FROM mode_f"))
def q_drop_zero(spark, d):
    """Then drop the columns whose values are all 0."""
    return ds.preprocess(_model(spark, d))[1]


def _std_sql(src: str) -> str:
    feats = [c for c in A.MODEL_FEATURES if c != "ft_zero"]
    cols = ", ".join(f"round((CAST({c} AS DOUBLE) - (SELECT avg(CAST({c} AS DOUBLE)) FROM {src})) / "
                     f"(SELECT stddev_samp(CAST({c} AS DOUBLE)) FROM {src}), 6) AS {c}" for c in feats)
    return f"SELECT hadm_id, hcc_cd_135, {cols} FROM {src}"


@query("standardize", with_ctes([A.SQL_MODEL_ROWS, _MEAN_FILL, _MODE_FILL], _std_sql("mode_f")))
def q_standardize(spark, d):
    """Full chain fitted on the frame itself; scaled output (z-scores)."""
    return ds.preprocess(_model(spark, d))[0]


_TRAIN = f"""train_r AS (SELECT * FROM model_r WHERE {_BUCKET_SQL} < 7)"""


@query("preprocess", with_ctes([A.SQL_MODEL_ROWS, _TRAIN, _MEAN_FILL.replace("model_r", "train_r"),
                                _MODE_FILL], _std_sql("mode_f")))
def q_preprocess(spark, d):
    """Split, then impute / drop zero columns / standardise the training split."""
    train, _, _ = ds.split_frames(_model(spark, d))
    return ds.preprocess(train)[0]


# ================================================================ selection / metrics
_CORR_COLS = ["hcc_cd_135", "ft_avg_qty", "ft_avg_discount", "ft_returned", "ft_urgent", "ft_total"]


@query("correlation_matrix", with_ctes([A.SQL_MODEL_ROWS], " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS corr "
    f"FROM model_r" for a in _CORR_COLS for b in _CORR_COLS)))
def q_corr(spark, d):
    """Pearson correlation of every pair (long form)."""
    return sel.correlation_matrix(_model(spark, d), _CORR_COLS)


_WIDE_COLS = [f"f{i}" for i in range(42)]


def _wide_expr(i: int) -> str:
    """A column with nulls in every seventh to eleventh row; Spark and DuckDB read it alike."""
    return (f"CASE WHEN (l_partkey + {i}) % {7 + i % 5} = 0 THEN NULL "
            f"ELSE l_quantity * {1 + i % 4} + CAST((l_suppkey * {i + 1} + l_linenumber) % {11 + i} AS DOUBLE) END AS f{i}")


@query("correlation_wide", "WITH w AS (SELECT " + ", ".join(map(_wide_expr, range(42))) + " FROM lineitem) " + " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS corr FROM w" for a in _WIDE_COLS for b in _WIDE_COLS))
def q_corr_wide(spark, d):
    """Pairwise-complete correlation of 42 columns with nulls (over the block width)."""
    wide = A.table(spark, d, "lineitem").selectExpr(*map(_wide_expr, range(42)))
    return sel.correlation_matrix(wide, _WIDE_COLS)


@query("category_long", with_ctes([A.SQL_DIAGNOSES, A.SQL_CROSSWALK, _MERGED], """
SELECT DISTINCT hadm_id, subject_id, 'hcc_cd_' || hcc AS feature, 1 AS value FROM merged WHERE hcc IS NOT NULL"""))
def q_category_long(spark, d):
    """The ones of the category one-hot as rows, for any number of categories."""
    coded = fx.lookup_join(A.diagnoses(spark, d), A.crosswalk(spark, d), "icd9_code", "icd")
    return ag.onehot_long(coded, ["hadm_id", "subject_id"], "hcc", "hcc_cd")


@query("category_sparse", with_ctes([A.SQL_DIAGNOSES, A.SQL_CROSSWALK, _MERGED], """
SELECT hadm_id, subject_id, (SELECT count(*) FROM (SELECT DISTINCT hcc FROM merged WHERE hcc IS NOT NULL)) AS size,
       coalesce(string_agg(DISTINCT place, ',' ORDER BY place) FILTER (place IS NOT NULL), '') AS places
FROM (SELECT m.hadm_id, m.subject_id, lpad(CAST(i.place AS VARCHAR), 4, '0') AS place FROM merged m
      LEFT JOIN (SELECT hcc, row_number() OVER (ORDER BY hcc) - 1 AS place FROM (SELECT DISTINCT hcc FROM merged WHERE hcc IS NOT NULL)) i USING (hcc))
WHERE hadm_id IS NOT NULL AND subject_id IS NOT NULL GROUP BY hadm_id, subject_id"""))
def q_category_sparse(spark, d):
    """One sparse vector per entity over all categories: its places, as text."""
    coded = fx.lookup_join(A.diagnoses(spark, d), A.crosswalk(spark, d), "icd9_code", "icd")
    sparse = ag.onehot_sparse(coded, ["hadm_id", "subject_id"], "hcc")
    places = F.transform("indices", lambda i: F.lpad(i.cast("string"), 4, "0"))
    return sparse.select("hadm_id", "subject_id", "size", F.array_join(places, ",").alias("places"))


_LC_FEATS = _CORR_COLS[1:]


@query("label_correlation", with_ctes([A.SQL_MODEL_ROWS], " UNION ALL ".join(
    f"SELECT '{f}' AS feature, round(corr(CAST({f} AS DOUBLE), CAST(hcc_cd_135 AS DOUBLE)), 6) AS importance "
    f"FROM model_r" for f in _LC_FEATS)))
def q_label_corr(spark, d):
    """Correlation with the label as importance."""
    return sel.label_correlation(_model(spark, d), "hcc_cd_135", _LC_FEATS)


_CHI_FEATS = ["ft_avg_qty", "ft_avg_discount", "ft_returned", "ft_urgent", "ft_admit_type_newborn", "ft_zero", "ft_total"]


def _chi2_sql(k: int | None) -> str:
    long = " UNION ALL ".join(f"SELECT '{c}' AS feature, hcc_cd_135 AS y, CAST({c} AS DOUBLE) AS x FROM mode_f"
                              for c in _CHI_FEATS)
    body = f"""
sc AS (
  SELECT o.feature, sum((o.o - p.p * t.t) * (o.o - p.p * t.t) / nullif(p.p * t.t, 0)) AS importance
  FROM (SELECT feature, y, sum(x) AS o FROM lg GROUP BY feature, y) o
  JOIN (SELECT hcc_cd_135 AS y, count(*) / (SELECT count(*) FROM mode_f) AS p FROM mode_f GROUP BY hcc_cd_135) p
    ON o.y = p.y
  JOIN (SELECT feature, sum(x) AS t FROM lg GROUP BY feature) t ON o.feature = t.feature
  GROUP BY o.feature)"""
    tail = (f"SELECT feature, round(importance, 6) AS importance FROM sc WHERE importance IS NOT NULL "
            f"AND NOT isnan(importance) ORDER BY importance DESC, feature LIMIT {k}") if k else \
        "SELECT feature, round(importance, 6) AS importance FROM sc"
    return with_ctes([A.SQL_MODEL_ROWS, _MEAN_FILL, _MODE_FILL, f"lg AS ({long})", body.strip()], tail)


def _imputed(spark, d):
    pre = ds.fit_preprocess(_model(spark, d))
    df = _model(spark, d).fillna({k: v for k, v in pre.means.items() if v is not None})
    return df.fillna({k: v for k, v in pre.modes.items() if v is not None})


@query("chi2_top_k", _chi2_sql(3))
def q_chi2(spark, d):
    """Chi-square scores of class sums on the imputed rows; top 3."""
    return sel.top_k(sel.chi2_scores(_imputed(spark, d), "hcc_cd_135", _CHI_FEATS), 3)


_SCORE = "(0.02 * floor(coalesce(ft_avg_qty, 25)) + 0.3 * ft_urgent + 0.2 * coalesce(ft_returned, 0))"


def _scored(spark, d):
    m = _model(spark, d)
    score = (F.lit(0.02) * F.floor(F.coalesce(F.col("ft_avg_qty"), F.lit(25.0))).cast("double")
             + F.lit(0.3) * F.col("ft_urgent") + F.lit(0.2) * F.coalesce(F.col("ft_returned"), F.lit(0)))
    return m.select("hadm_id", F.col("hcc_cd_135").alias("label"), score.alias("score"))


_ROC_CTE = f"""g AS (
  SELECT {_SCORE} AS threshold, sum(hcc_cd_135) AS tp, sum(1 - hcc_cd_135) AS fp FROM model_r GROUP BY 1),
roc AS (
  SELECT threshold, tp, fp, sum(tp) OVER (ORDER BY threshold DESC) AS cum_tp,
         sum(fp) OVER (ORDER BY threshold DESC) AS cum_fp FROM g)"""


@query("roc_points", with_ctes([A.SQL_MODEL_ROWS, _ROC_CTE], """
SELECT round(threshold, 6) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(cum_tp AS BIGINT) AS cum_tp,
       CAST(cum_fp AS BIGINT) AS cum_fp, round(cum_tp / (SELECT sum(tp) FROM g), 6) AS tpr,
       round(cum_fp / (SELECT sum(fp) FROM g), 6) AS fpr FROM roc""".lstrip()))
def q_roc(spark, d):
    """ROC points per distinct score of a fixed scoring formula."""
    return sel.roc_points(_scored(spark, d))


@query("auc_precision_recall", with_ctes([A.SQL_MODEL_ROWS, _ROC_CTE], f"""
SELECT 'fixed-score' AS label,
  round((SELECT sum(fp * (2 * cum_tp - tp)) FROM roc) / (2.0 * (SELECT sum(tp) FROM g) * (SELECT sum(fp) FROM g)), 6) AS auc,
  round(sum(CASE WHEN s >= 0.5 THEN hcc_cd_135 ELSE 0 END) / sum(CASE WHEN s >= 0.5 THEN 1 ELSE 0 END), 6) AS precision,
  round(sum(CASE WHEN s >= 0.5 THEN hcc_cd_135 ELSE 0 END) / sum(hcc_cd_135), 6) AS recall
FROM (SELECT hcc_cd_135, {_SCORE} AS s FROM model_r)""".lstrip()))
def q_auc(spark, d):
    """AUC (trapezoid), precision and recall at score >= 0.5."""
    return sel.auc_precision_recall(_scored(spark, d), threshold=0.5, name="fixed-score")


def _usage_sql() -> str:
    corr = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, abs(corr(CAST({f} AS DOUBLE), CAST(hcc_cd_135 AS DOUBLE))) AS s FROM model_r"
        for f in _LC_FEATS)
    chi = _chi2_sql(None)
    chi_ctes = chi[len("WITH "):chi.rindex("\nSELECT feature, round(importance, 6) AS importance FROM sc")]
    return f"""WITH {chi_ctes},
cs AS ({corr}),
m AS (
  SELECT feature, 'all_features' AS method FROM (VALUES {', '.join(f"('{f}')" for f in _CHI_FEATS)}) t(feature)
  UNION ALL SELECT feature, 'label_correlation' FROM (SELECT feature FROM cs ORDER BY s DESC, feature LIMIT 3)
  UNION ALL SELECT feature, 'chi2' FROM (SELECT feature FROM sc WHERE importance IS NOT NULL AND NOT isnan(importance)
                                         ORDER BY importance DESC, feature LIMIT 3))
SELECT feature, max(CAST(method = 'all_features' AS INTEGER)) AS all_features,
       max(CAST(method = 'label_correlation' AS INTEGER)) AS label_correlation,
       max(CAST(method = 'chi2' AS INTEGER)) AS chi2,
       max(CAST(method = 'all_features' AS INTEGER)) + max(CAST(method = 'label_correlation' AS INTEGER))
         + max(CAST(method = 'chi2' AS INTEGER)) AS used
FROM m GROUP BY feature"""


@query("feature_usage", _usage_sql())
def q_usage(spark, d):
    """Feature x selection-method matrix with the number of methods using it."""
    m = _model(spark, d)
    lc = sel.label_correlation(m, "hcc_cd_135", _LC_FEATS).withColumn("importance", F.abs("importance"))
    chi = sel.chi2_scores(_imputed(spark, d), "hcc_cd_135", _CHI_FEATS)
    all_f = spark.createDataFrame([(f,) for f in _CHI_FEATS], "feature string")
    return sel.feature_usage({"all_features": all_f, "label_correlation": sel.top_k(lc, 3),
                              "chi2": sel.top_k(chi, 3)})


# ===================================================== models (rows-only checks)
def _splits(spark, d):
    """Scaled train / valid / test, each preprocessed on itself, restricted to
    the feature columns all three keep. The rows are written once before the
    constants are fitted, and the scaled sets before the models read them many times."""
    from cohortforge.session import materialize
    rows = materialize(ds.split_buckets(_model(spark, d)), "model-splits")
    splits = (rows.where(F.col("split") == n).drop("split") for n in ("train", "valid", "test"))
    tr_s, va_s, te_s = (materialize(ds.preprocess(x)[0], "model-scaled") for x in splits)
    feats = [c for c in tr_s.columns if c.startswith("ft_") and c in va_s.columns and c in te_s.columns]
    return tr_s, va_s, te_s, feats


@query("pca_scores")
def q_pca_scores(spark, d):
    """Centred PCA, 3 components, scores of the training rows."""
    tr, _, _, feats = _splits(spark, d)
    model = sel.pca_fit(tr, feats, 3)
    return sel.pca_scores(model, tr)


@query("pca_variance_sweep")
def q_pca_sweep(spark, d):
    """Explained-variance ratios for 5 to 9 components of the scaled training set (one fit)."""
    from cohortforge.plans import model_sets as ms
    from cohortforge.plans.queries_models import model_sets
    folder = model_sets(spark, d)
    return sel.pca_variance_sweep(ms.read_model_set(spark, folder, "train"), ms.shared_features(spark, folder))


@query("tree_importance")
def q_tree_importance(spark, d):
    """Entropy trees at three leaf-size settings; importances, top 25 each."""
    tr, _, _, feats = _splits(spark, d)
    out = None
    for i, setting in enumerate(TREE_SETTINGS):
        imp = sel.importances(sel.tree_fit(tr, feats, **setting), feats, spark).withColumn("setting", F.lit(i))
        out = imp if out is None else out.unionByName(imp)
    return out


@query("tree_metrics")
def q_tree_metrics(spark, d):
    """Tree fitted on train; AUC / precision / recall on valid and test."""
    tr, va, te, feats = _splits(spark, d)
    m = sel.tree_fit(tr, feats, min_leaf=75)
    return sel.evaluate(m, va, feats, "tree-valid").unionByName(sel.evaluate(m, te, feats, "tree-test"))


@query("logistic_metrics")
def q_logistic(spark, d):
    """L2 logistic regression (C = 1) on train, metrics on valid."""
    tr, va, _, feats = _splits(spark, d)
    return sel.evaluate(sel.logistic_fit(tr, feats), va, feats, "logistic-regression")


@query("logistic_on_pca")
def q_logistic_pca(spark, d):
    """Logistic regression on PCA scores; the fitted PCA is applied to valid."""
    tr, va, _, feats = _splits(spark, d)
    pca = sel.pca_fit(tr, feats, 3)
    pcs = [f"pc_{i}" for i in range(3)]
    trp = sel.pca_scores(pca, tr, keep=("hadm_id", "hcc_cd_135"))
    vap = sel.pca_scores(pca, va, keep=("hadm_id", "hcc_cd_135"))
    return sel.evaluate(sel.logistic_fit(trp, pcs), vap, pcs, "log-reg-pca")


@query("grid_search")
def q_grid(spark, d):
    """Cross-validated penalty x C search (20 C x 2 penalties x 5 folds), best model on valid."""
    tr, va, _, feats = _splits(spark, d)
    best = sel.grid_search(tr, feats)
    return sel.evaluate(best, va, feats, "grid-searched-log-reg")


@query("model_comparison")
def q_model_comparison(spark, d):
    """Comparison table of models, sorted by AUC then precision, with
    externally computed rows appended."""
    tr, va, _, feats = _splits(spark, d)
    rows = [sel.evaluate(sel.tree_fit(tr, feats, min_leaf=75), va, feats, "tree"),
            sel.evaluate(sel.logistic_fit(tr, feats), va, feats, "logistic-regression")]
    return sel.make_table(rows, EXTERNAL_MODELS)


# ================================================================ feature assembly
_ASSEMBLY_GROUPS = _GROUPS


def _assembly_sql() -> str:
    from cohortforge.plans.presets import COMORBIDITIES
    frames = []
    ctes = list(S.LABEL_CTES) + [_MERGED]
    frames.append(("f_base", "SELECT hadm_id, hcc_cd_135 FROM label_g"))
    for name, (c, body) in [("f_demo", _demo_sql(parts=True)), ("f_chart", _chart_features_sql(as_parts=True)),
                            ("f_ov", _OV_PARTS), ("f_kw", _keyword_sql(parts=True))]:
        ctes += c
        frames.append((name, body))
    cats = ", ".join(f"max({fl(f'hcc = {chr(39)}{code}{chr(39)}')}) AS {col}" for code, col in COMORBIDITIES.items())
    frames.append(("f_cat", f"SELECT hadm_id, {cats} FROM merged GROUP BY hadm_id, subject_id"))
    ctes.append(A.SQL_PROCEDURES)
    frames.append(("f_proc", f"""SELECT hadm_id, max({fl(f'cpt_cd IN {_CODE_LIST_SQL}')}) AS ft_contrast_imaging,
  max({fl("cpt_cd = '7'")} * {fl("contains(lower(description), 'ring')")}) AS ft_mechanical_ventilation
  FROM procedures_r WHERE hadm_id IS NOT NULL GROUP BY hadm_id"""))
    ctes += S.LABS_CTES
    sod = f"{cci('label', 'sodium')} AND {BLOOD}"
    pot = f"{cci('label', 'potassium')} AND {BLOOD}"
    iron = f"{IRON} AND {BLOOD}"
    frames.append(("f_lab", f"""SELECT * FROM (SELECT hadm_id,
  max(CASE WHEN {sod} THEN {fl('valuenum < 5')} END) AS ft_low_sodium,
  max(CASE WHEN {pot} THEN {fl('valuenum > 300')} END) AS ft_high_potassium,
  bool_or(CASE WHEN {iron} THEN {tv('valuenum < 20')} END) AS ft_anemic
  FROM labs GROUP BY hadm_id)
  WHERE ft_low_sodium IS NOT NULL OR ft_high_potassium IS NOT NULL OR ft_anemic IS NOT NULL"""))
    ctes += [f"{n} AS ({b})" for n, b in frames]
    ctes.append("fk AS (" + " UNION ".join(f"SELECT hadm_id FROM {n}" for n, _ in frames) + ")")
    joins = " ".join(f"LEFT JOIN {n} ON fk.hadm_id = {n}.hadm_id" for n, _ in frames)
    return with_ctes(ctes, f"SELECT fk.hadm_id, {', '.join(n + '.* EXCLUDE (hadm_id)' for n, _ in frames)} "
                           f"FROM fk {joins}")


@query("feature_assembly", _assembly_sql())
def q_assembly(spark, d):
    """All feature frames merged per admission (label, demographics, chart
    features, categories, other visits, keyword groups, procedures, labs)."""
    t = {"admissions": A.admissions(spark, d), "patients": A.patients(spark, d), "icustays": A.stays(spark, d),
         "diagnoses": A.diagnoses(spark, d), "crosswalk": A.crosswalk(spark, d), "chartevents": A.charts(spark, d),
         "d_items": A.items(spark, d), "prescriptions": A.prescriptions(spark, d),
         "cptevents": A.procedures(spark, d), "labevents": A.lab_events(spark, d), "d_labitems": A.lab_items(spark, d)}
    labs = {"ft_low_sodium": dict(label_contains="sodium", fluid="blood", op="<", cut=5),
            "ft_high_potassium": dict(label_contains="potassium", fluid="blood", op=">", cut=300),
            "ft_anemic": dict(label_equals="iron", fluid="blood", op="<", cut=20, as_bool=True)}
    return pl.assemble_features(t, drug_groups=_ASSEMBLY_GROUPS, drug_hours=_GHOURS, contrast_codes=_CODES,
                                ventilation=("7", "ring"), labs=labs)


@query("feature_assembly_text", _assembly_sql())
def q_assembly_text(spark, d):
    """The same assembly from a folder of text tables: every role is written as
    gzip CSV under its upper-case name, read back as text, kept as Parquet and typed
    on the way; chart events and items both carry ``row_id``."""
    from cohortforge.sources.io import parquet_copies, read_table_folder, write_text_folder
    charts = A.charts(spark, d).repartitionByRange("row_order").sortWithinPartitions("row_order")
    charts = charts.withColumn("row_id", F.monotonically_increasing_id()).drop("row_order")
    roles = {"admissions": A.admissions(spark, d), "patients": A.patients(spark, d), "icustays": A.stays(spark, d),
             "diagnoses": A.diagnoses(spark, d), "crosswalk": A.crosswalk(spark, d), "chartevents": charts,
             "d_items": A.items(spark, d).withColumn("row_id", F.monotonically_increasing_id()),
             "prescriptions": A.prescriptions(spark, d), "cptevents": A.procedures(spark, d),
             "labevents": A.lab_events(spark, d), "d_labitems": A.lab_items(spark, d)}
    folder = _scratch(spark, "text-tables")
    write_text_folder(roles, folder)
    labs = {"ft_low_sodium": dict(label_contains="sodium", fluid="blood", op="<", cut=5),
            "ft_high_potassium": dict(label_contains="potassium", fluid="blood", op=">", cut=300),
            "ft_anemic": dict(label_equals="iron", fluid="blood", op="<", cut=20, as_bool=True)}
    out = pl.assemble_features(parquet_copies(read_table_folder(spark, folder)), drug_groups=_ASSEMBLY_GROUPS, drug_hours=_GHOURS,
                               contrast_codes=_CODES, ventilation=("7", "ring"), labs=labs)
    return out.withColumn("hadm_id", F.col("hadm_id").cast("bigint"))


# ======================================================================= streaming
@query("hash_bins_stream", with_ctes([A.SQL_CHARTS], f"SELECT {_BIN} AS bin_id, count(*) AS n FROM charts_r GROUP BY 1"))
def q_hash_bins_stream(spark, d):
    """The bin split as a stream: chart rows arrive as files (one file per
    micro-batch), are binned and appended per bin exactly once; the result is
    read back as a table."""
    from cohortforge.sources.io import read_bins
    from cohortforge.streaming import start_bin_split
    src, out = _scratch(spark, "stream-src"), _scratch(spark, "stream-out")
    charts = A.charts(spark, d).drop("row_order")
    charts.repartition(4, "hadm_id").write.parquet(src)
    q = start_bin_split(spark, src, charts.schema, out, "hadm_id", fmt="parquet", checkpoint=_scratch(spark, "sckpt"))
    q.awaitTermination()
    return ag.value_counts(read_bins(spark, out), "bin_id")


def batch_files(files: int, batches: int = 4, most: int = 32) -> int:
    """Files of a micro-batch: about ``batches`` of them, none over ``most`` files."""
    return min(most, -(-max(files, 1) // batches))


@query("hash_bins_stream_batches", with_ctes([A.SQL_CHARTS], f"SELECT {_BIN} AS bin_id, count(*) AS n FROM charts_r GROUP BY 1"))
def q_hash_bins_batches(spark, d):
    """The same with a batch writer: each micro-batch is rebalanced by bin and size and
    replaces its own folders, so running all of them again changes nothing. A batch has
    a fixed cost (one folder per bin), so it takes a quarter of the files, 32 at the most."""
    from cohortforge.sources.io import read_bins
    from cohortforge.streaming import start_bin_split
    src, out = _scratch(spark, "stream-src"), _scratch(spark, "stream-out")
    charts = A.charts(spark, d).drop("row_order")
    charts.repartition(F.col("hadm_id")).write.option("maxRecordsPerFile", 1_000_000).parquet(src)
    files = len(spark.read.schema(charts.schema).parquet(src).inputFiles())
    for _ in range(2):  # the second stream has a log of its own and replays every batch
        start_bin_split(spark, src, charts.schema, out, "hadm_id", fmt="parquet", checkpoint=_scratch(spark, "sckpt"),
                        max_files_per_trigger=batch_files(files), per_batch=True).awaitTermination()
    return ag.value_counts(read_bins(spark, out), "bin_id")


@query("external_curve_roundtrip", with_ctes([A.SQL_MODEL_ROWS, _ROC_CTE],
                                             "SELECT round(cum_fp / (SELECT sum(fp) FROM g), 6) AS value FROM roc"))
def q_external_curve(spark, d):
    """An externally written curve file (index column + values) read back by
    column position: here the false-positive rates of the ROC points."""
    path = _scratch(spark, "curve")
    roc = sel.roc_points(_scored(spark, d))
    roc.select(F.monotonically_increasing_id().alias("idx"), F.col("fpr")).write.option("header", True).csv(path)
    return sel.read_external_curve(spark, path, column=1)


# ==================================================================== model sets
from cohortforge.plans import queries_models  # noqa: E402,F401
