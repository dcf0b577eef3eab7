"""SQL building blocks for the DuckDB oracle (independent re-statement of
each operator's semantics over the same roles)."""

from __future__ import annotations

from cohortforge.sources import adapters as A


def fl(cond: str) -> str:
    """Two-valued 0/1 flag."""
    return f"CAST(coalesce({cond}, false) AS INTEGER)"


def tv(cond: str) -> str:
    return f"coalesce({cond}, false)"


def cci(col: str, word: str) -> str:
    return f"coalesce(contains(lower({col}), '{word.lower()}'), false)"


def hours_lt(t: str, anchor: str, h: float) -> str:
    return f"coalesce((epoch({t}) - epoch({anchor})) < {float(h) * 3600}, false)"


def with_ctes(ctes: list[str], body: str) -> str:
    seen, out = set(), []
    for c in ctes:
        if c not in seen:
            seen.add(c)
            out.append(c)
    return "WITH " + ",\n".join(out) + "\n" + body


LABS = f"""labs AS (
  SELECT e.subject_id, e.hadm_id, e.charttime, e.valuenum, lower(i.label) AS label, lower(i.fluid) AS fluid,
         lower(i.category) AS category
  FROM labevents_r e LEFT JOIN labitems_r i ON e.itemid = i.itemid WHERE e.hadm_id IS NOT NULL)"""
LABS_CTES = [A.SQL_LAB_EVENTS, A.SQL_LAB_ITEMS, LABS]

LABEL = f"""label_g AS (
  SELECT d.hadm_id, d.subject_id, max({fl("x.hcc = '135'")}) AS hcc_cd_135
  FROM diagnoses_r d LEFT JOIN crosswalk_r x ON d.icd9_code = x.icd
  WHERE d.hadm_id IS NOT NULL AND d.subject_id IS NOT NULL GROUP BY d.hadm_id, d.subject_id),
label_full AS (
  SELECT l.hadm_id, l.subject_id, l.hcc_cd_135, a.admittime, a.dischtime
  FROM label_g l LEFT JOIN admissions_r a ON l.hadm_id = a.hadm_id AND l.subject_id = a.subject_id)"""
LABEL_CTES = [A.SQL_DIAGNOSES, A.SQL_CROSSWALK, A.SQL_ADMISSIONS, LABEL]

NORM_CATEGORY = ("replace(replace(replace(replace(replace(replace(replace(lower(i.category), '-', ''), '  ', ''), "
                 "' ', '_'), '''s', ''), '/', '_'), '(', ''), ')', '')")

EVENTS = f"""ev AS (
  SELECT c.*, i.label, {NORM_CATEGORY} AS category, i.unitname,
         CASE WHEN i.itemid IS NOT NULL THEN 'both' ELSE 'left_only' END AS _d_items,
         CASE WHEN c.charttime IS NULL THEN c.storetime WHEN c.storetime IS NULL THEN c.charttime
              ELSE least(c.charttime, c.storetime) END AS eventtime
  FROM charts_r c LEFT JOIN items_r i ON c.itemid = i.itemid),
ev2 AS (
  SELECT ev.*, lf.hcc_cd_135, lf.admittime, lf.dischtime
  FROM ev LEFT JOIN label_full lf ON ev.subject_id = lf.subject_id AND ev.hadm_id = lf.hadm_id),
dd AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT ev2.*, row_number() OVER (PARTITION BY hadm_id, itemid, eventtime ORDER BY {A.SQL_ROW_ORDER}) AS rn
    FROM ev2) WHERE rn = 1)"""
EVENTS_CTES = [A.SQL_CHARTS, A.SQL_ITEMS, *LABEL_CTES, EVENTS]

DEMO_GENDER = """demo_gender AS (
  SELECT a.hadm_id, first(CASE p.gender WHEN 'F' THEN 0 WHEN 'M' THEN 1 END ORDER BY 1) AS ft_gender
  FROM admissions_r a LEFT JOIN patients_r p ON a.subject_id = p.subject_id GROUP BY a.hadm_id)"""


def serial_rows(src: str = "dd", match: str = "creatin", max_value: float = 11) -> str:
    return f"""cr AS (
  SELECT hadm_id, eventtime, valuenum, {A.SQL_ROW_ORDER},
         row_number() OVER w AS rn,
         lag(valuenum) OVER w AS pv, lag(eventtime) OVER w AS pt
  FROM {src}
  WHERE {cci('label', match)} AND {tv(f'valuenum <= {max_value}')} AND hadm_id IS NOT NULL
  WINDOW w AS (PARTITION BY hadm_id ORDER BY eventtime ASC NULLS LAST, {A.SQL_ROW_ORDER})),
cr2 AS (
  SELECT *, valuenum - CASE WHEN rn = 1 THEN valuenum ELSE pv END AS delta,
         CASE WHEN rn = 1 THEN eventtime ELSE pt END AS prev_t,
         first_value(valuenum) OVER (PARTITION BY hadm_id ORDER BY eventtime ASC NULLS LAST, {A.SQL_ROW_ORDER}
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS baseline
  FROM cr)"""
