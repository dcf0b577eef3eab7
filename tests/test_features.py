"""Feature operators on hand-made rows, and the pair-free operators against
explicit all-pairs computations on small random fixtures."""

import datetime as dt
import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortforge.operators import features as fx

T0 = dt.datetime(2020, 1, 1)


def h(n):
    return T0 + dt.timedelta(hours=n)


# ----------------------------------------------------------------- threshold flags
def test_threshold_flag_boundary_and_null(spark):
    labs = spark.createDataFrame(
        [(1, "sodium", "blood", 136.0), (1, "sodium", "blood", None), (2, "sodium", "blood", 135.9),
         (3, "sodium", "urine", 100.0), (4, "sodium", "blood", None)],
        "hadm_id int, label string, fluid string, valuenum double")
    got = {r["hadm_id"]: r["f"] for r in fx.threshold_flag(labs, "f", "<", 136, label_contains="sodium").collect()}
    # equal to the cut is not below it; a missing value is 0; other fluids are absent
    assert got == {1: 0, 2: 1, 4: 0}


def test_prepare_labs_drops_missing_entity(spark):
    ev = spark.createDataFrame([(1, 10, "a", "2020-01-01 00:00:00", "7", 7.0), (1, None, "a", "2020-01-01 00:00:00", "x", None)],
                               "subject_id int, hadm_id int, itemid string, charttime string, value string, valuenum double")
    items = spark.createDataFrame([("a", "Sodium", "BLOOD", "Chem")], "itemid string, label string, fluid string, category string")
    rows = fx.prepare_labs(ev, items).collect()
    assert len(rows) == 1 and rows[0]["label"] == "sodium" and rows[0]["fluid"] == "blood"


# ------------------------------------------------------------------- other visits
def brute_other_visits(adm: pd.DataFrame, stays: pd.DataFrame, days=(30, 60, 90, 120), direction="any"):
    out = {}
    for _, a in adm.iterrows():
        others = adm[(adm.subject_id == a.subject_id) & (adm.hadm_id != a.hadm_id)]
        if len(others) == 0:
            continue
        rec = {}
        pairs = []
        for _, b in others.iterrows():
            if direction == "prior":
                ok = not (pd.isna(a.admittime) or pd.isna(b.admittime) or pd.isna(b.dischtime)) \
                    and b.admittime < a.admittime
                d = (a.admittime - b.dischtime).total_seconds() / 86400 if ok else None
            elif pd.isna(b.admittime) or pd.isna(a.dischtime):
                d = None
            else:
                d = math.floor((b.admittime - a.dischtime).total_seconds() / 86400)
            st = stays[stays.hadm_id == b.hadm_id]
            if len(st) == 0:
                pairs.append((d, None, None))
            for _, s in st.iterrows():
                pairs.append((d, s.los, s.last_careunit))
        for n in days:
            rec[f"ft_prior_admission_{n}"] = int(any(d is not None and d < n for d, _, _ in pairs))
        los = [l for d, l, _ in pairs if d is not None and d < 30 and l is not None and not pd.isna(l)]
        rec["ft_avg_icu_los_within_30"] = max(los) if los else None
        for u in ("micu", "ccu"):
            rec[f"ft_{u}_within_30"] = int(any(d is not None and d < 30 and isinstance(c, str) and c.lower() == u
                                              for d, _, c in pairs))
        out[a.hadm_id] = rec
    return out


@pytest.mark.parametrize("seed,hot_rows,direction", [(1, 1_000_000, "any"), (2, 1_000_000, "any"),
                                                     (3, 1_000_000, "any"), (4, 1, "any"),
                                                     (5, 1_000_000, "prior"), (6, 1_000_000, "prior"),
                                                     (7, 1, "prior"), (8, 2, "prior")])
def test_other_visits_matches_all_pairs(spark, seed, hot_rows, direction):
    rnd = random.Random(seed)
    adm, stays, hid = [], [], 0
    for s in range(6):
        for _ in range(rnd.choice([1, 2, 3, 7])):
            hid += 1
            admit = None if rnd.random() < 0.1 else T0 + dt.timedelta(days=rnd.randint(0, 200), hours=rnd.choice([0, 5]))
            disch = None if rnd.random() < 0.1 else (admit or T0) + dt.timedelta(days=rnd.randint(0, 20))
            adm.append((hid, s, admit, disch))
            for _ in range(rnd.choice([0, 1, 2])):
                stays.append((hid, rnd.choice(["MICU", "CCU", "sicu", None]), rnd.choice([None, 1.5, 3.0, 0.2])))
    adm_df = spark.createDataFrame(adm, "hadm_id int, subject_id int, admittime timestamp_ntz, dischtime timestamp_ntz")
    st_df = spark.createDataFrame(stays, "hadm_id int, last_careunit string, los double")
    # hot_rows=1 refines every slot holding two or more rows by the second
    got = {r["hadm_id"]: r.asDict()
           for r in fx.other_visits_within_days(adm_df, st_df, hot_rows=hot_rows, direction=direction).collect()}
    exp = brute_other_visits(pd.DataFrame(adm, columns=["hadm_id", "subject_id", "admittime", "dischtime"]),
                             pd.DataFrame(stays, columns=["hadm_id", "last_careunit", "los"]), direction=direction)
    assert set(got) == set(exp)
    for k, rec in exp.items():
        for c, v in rec.items():
            assert got[k][c] == v, (seed, k, c, got[k][c], v)


@pytest.mark.parametrize("seed", [21, 22])
def test_other_visits_prior_dense_subject(spark, seed):
    # one subject with many close admissions, some discharged before admission
    rnd = random.Random(seed)
    adm, stays = [], []
    for hid in range(1, 20):
        admit = T0 + dt.timedelta(days=rnd.randint(0, 60), hours=rnd.choice([0, 7]))
        disch = admit + dt.timedelta(days=rnd.randint(-2, 25), hours=rnd.choice([0, 3]))
        adm.append((hid, 1 if hid > 2 else 2, admit, disch))
        stays.append((hid, rnd.choice(["MICU", "CCU", "tsicu"]), rnd.choice([None, 0.5, 2.0, 4.0, 9.0])))
    adm_df = spark.createDataFrame(adm, "hadm_id int, subject_id int, admittime timestamp_ntz, dischtime timestamp_ntz")
    st_df = spark.createDataFrame(stays, "hadm_id int, last_careunit string, los double")
    got = {r["hadm_id"]: r.asDict() for r in fx.other_visits_within_days(adm_df, st_df, direction="prior").collect()}
    exp = brute_other_visits(pd.DataFrame(adm, columns=["hadm_id", "subject_id", "admittime", "dischtime"]),
                             pd.DataFrame(stays, columns=["hadm_id", "last_careunit", "los"]), direction="prior")
    assert set(got) == set(exp)
    for k, rec in exp.items():
        for c, v in rec.items():
            assert got[k][c] == v, (seed, k, c, got[k][c], v)


# --------------------------------------------------------------- paired readings
def brute_bands(rows):
    df = pd.DataFrame(rows, columns=["hadm_id", "eventtime", "admittime", "label", "valuenum"])
    sy = df[df.label.str.lower().str.contains("systolic") & ~df.label.str.lower().str.contains("pulmonary")]
    di = df[df.label.str.lower().str.contains("diastolic") & ~df.label.str.lower().str.contains("pulmonary")]
    out = {}
    for _, s in sy.iterrows():
        for _, d in di.iterrows():
            same_t = (pd.isna(s.eventtime) and pd.isna(d.eventtime)) or s.eventtime == d.eventtime
            if s.hadm_id != d.hadm_id or not same_t:
                continue
            sv, dv = s.valuenum, d.valuenum

            def b(x, lo, hi):
                return x is not None and not pd.isna(x) and lo <= x <= hi

            def lt(x, c):
                return x is not None and not pd.isna(x) and x < c

            def gt(x, c):
                return x is not None and not pd.isna(x) and x > c
            stg2 = b(sv, 140, 179) or b(dv, 90, 119)
            delta = None if pd.isna(s.eventtime) or pd.isna(s.admittime) else (s.eventtime - s.admittime)
            rec = {"ft_elevated_bp": int(b(sv, 120, 129) and lt(dv, 80)),
                   "ft_abnormally_low_bp": int(lt(sv, 119) and lt(dv, 79)),
                   "ft_hbp_stg_1": int(b(sv, 130, 139) or b(dv, 80, 89)),
                   "ft_hbp_stg_2": int(stg2), "ft_hbp_crisis": int(gt(sv, 180) or gt(dv, 120))}
            for hh in (6, 12, 24, 36, 48):
                rec[f"ft_hbp_stg_2_within_{hh}_hours"] = int(stg2 and delta is not None and delta < dt.timedelta(hours=hh))
            cur = out.setdefault(s.hadm_id, {k: 0 for k in rec})
            for k, v in rec.items():
                cur[k] = max(cur[k], v)
    return out


@pytest.mark.parametrize("seed", [5, 6])
def test_paired_bands_match_all_pairs(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for hid in range(5):
        adm = T0
        for _ in range(30):
            t = None if rnd.random() < 0.1 else h(rnd.choice([-3, 0, 5, 10, 30, 47, 60]))
            lab = rnd.choice(["Arterial BP [Systolic]", "Arterial BP [Diastolic]", "Pulmonary systolic", "HR"])
            v = None if rnd.random() < 0.1 else float(rnd.choice([60, 78, 79, 80, 85, 95, 118, 119, 120, 125, 135, 150, 181]))
            rows.append((hid, t, adm, lab, v))
    df = spark.createDataFrame(rows, "hadm_id int, eventtime timestamp_ntz, admittime timestamp_ntz, label string, valuenum double")
    got = {r["hadm_id"]: r.asDict() for r in fx.paired_reading_bands(df).collect()}
    exp = brute_bands(rows)
    assert set(got) == set(exp)
    for k, rec in exp.items():
        for c, v in rec.items():
            assert got[k][c] == v, (k, c)


# --------------------------------------------------------------------- serial change
def test_serial_change_previous_and_baseline(spark):
    rows = [  # hadm, eventtime, label, valuenum, row_order
        (1, h(0), "Creatinine", 1.2, 1), (1, h(10), "creatinine", 1.6, 2), (1, h(100), "Creatinine", 2.0, 3),
        (1, None, "Creatinine", 5.0, 4), (1, h(5), "Creatinine", 12.0, 5),
        (2, h(0), "Creatinine", 0.8, 1), (2, h(60), "Creatinine", 1.3, 2)]
    df = spark.createDataFrame(rows, "hadm_id int, eventtime timestamp_ntz, label string, valuenum double, row_order int")
    got = {r["hadm_id"]: r.asDict() for r in fx.serial_change(df).collect()}
    # hadm 1: rise 1.2 -> 1.6 within 10 h; 12.0 is implausible and dropped; baseline 1.2
    assert got[1]["ft_creatinine_increase_within_48"] == 1
    assert got[1]["ft_creatinine_increase_from_baseline"] == 1
    assert got[1]["ft_baseline_creat_gt_1"] == 1 and got[1]["ft_baseline_creatinine"] == 1.2
    assert math.isclose(got[1]["ft_avg_creatinine"], (1.2 + 1.6 + 2.0 + 5.0) / 4)
    # hadm 2: rise of 0.5 but 60 h apart
    assert got[2]["ft_creatinine_increase_within_48"] == 0 and got[2]["ft_baseline_creat_gt_1"] == 0
    audit = fx.serial_change_audit(df).collect()
    assert {r["hadm_id"] for r in audit} == {1}


# ----------------------------------------------------------- reference range / ph
def test_group_reference_range_unknown_uses_other(spark):
    charts = spark.createDataFrame([(1, "Hematocrit", 48.0), (2, "Hematocrit", 48.0), (3, "Hematocrit", 40.0),
                                    (3, "Hematocrit (apache)", 10.0), (4, "Hematocrit", 15.0)],
                                   "hadm_id int, label string, valuenum double")
    groups = spark.createDataFrame([(1, 1), (2, None), (3, 1), (4, 0)], "hadm_id int, ft_gender int")
    got = {r["hadm_id"]: (r["ft_above_normal_hematocrit"], r["ft_below_normal_hematocrit"],
                          r["ft_way_below_normal_hematocrit"]) for r in fx.group_reference_range(charts, groups).collect()}
    assert got == {1: (0, 0, 0), 2: (1, 0, 0), 3: (0, 1, 0), 4: (0, 1, 1)}


def test_low_value_windows_means(spark):
    rows = [(1, h(5), T0, "Arterial pH", 7.2), (1, h(20), T0, "Arterial pH", 7.4), (1, h(1), T0, "Other", 1.0)]
    df = spark.createDataFrame(rows, "hadm_id int, eventtime timestamp_ntz, admittime timestamp_ntz, label string, valuenum double")
    r = fx.low_value_windows(df).first()
    assert r["ft_low_blood_ph"] == 1 and r["ft_low_blood_ph_within_6_hrs"] == 1
    assert math.isclose(r["ft_avg_low_blood_ph_within_6_hrs"], 7.3)  # unmasked: mean of all readings
    m = fx.low_value_windows(df, masked=True).first()
    assert math.isclose(m["ft_avg_low_blood_ph_within_6_hrs"], 7.2)


# ---------------------------------------------------------------- categorical one-hot
def test_categorical_onehot_outer_join_of_sides(spark):
    rows = [(1, "[Urine] Color", "Yellow"), (1, "Urine Color", "RED"), (1, "Urine [Appearance]", "Clear"),
            (2, "Urine Appearance", "Cloudy"), (3, "Urine Color", None)]
    df = spark.createDataFrame(rows, "hadm_id int, label string, value string")
    got = {r["hadm_id"]: r.asDict() for r in fx.categorical_readings_onehot(df).collect()}
    assert got[1]["ft_urine_color_red"] == 1 and got[1]["ft_urine_color_yellow"] == 1
    assert got[1]["ft_urine_appearance_clear"] == 1 and got[1]["ft_urine_appearance_cloudy"] == 0
    assert got[2]["ft_urine_color_red"] is None and got[2]["ft_urine_appearance_cloudy"] == 1
    assert got[3]["ft_urine_color_red"] == 0 and got[3]["ft_urine_appearance_clear"] is None


# ------------------------------------------------------------------------ demographics
def test_demographics_age_rules_and_fold(spark):
    adm = spark.createDataFrame(
        [(1, 10, T0, "EMERGENCY", "WHITE"), (2, 11, T0, "ELECTIVE", "UNKNOWN/NOT SPECIFIED"),
         (3, 12, T0, "NEWBORN", "PATIENT DECLINED TO ANSWER")],
        "hadm_id int, subject_id int, admittime timestamp_ntz, admission_type string, ethnicity string")
    pts = spark.createDataFrame([(10, "M", dt.datetime(1950, 1, 1)), (11, "F", dt.datetime(1700, 1, 1)),
                                 (12, None, dt.datetime(2021, 6, 1))], "subject_id int, gender string, dob timestamp_ntz")
    got = {r["hadm_id"]: r.asDict() for r in fx.demographics(adm, pts).collect()}
    assert got[1]["ft_gender"] == 1 and math.isclose(got[1]["ft_age"], 25567 / 365.25)
    assert got[2]["ft_age"] is None           # implausibly old
    assert got[3]["ft_age"] is None           # born after admission (< -1 year)
    assert got[2]["ft_race_missing_info"] == 1 and got[3]["ft_race_missing_info"] == 1
    assert got[1]["ft_race_white"] == 1 and "ft_race_unknown_not_specified" not in got[1]
    assert got[3]["ft_admit_type_newborn"] == 1


# ------------------------------------------------------------------- keyword groups
def test_keyword_group_windows(spark):
    pres = spark.createDataFrame([(1, 10, "Vancomycin 1g", h(5)), (1, 10, "IBUPROFEN", h(60)), (2, 20, None, h(1))],
                                 "hadm_id int, subject_id int, drug string, startdate timestamp_ntz")
    adm = spark.createDataFrame([(1, 10, T0), (2, 20, T0)], "hadm_id int, subject_id int, admittime timestamp_ntz")
    groups = {"antibiotics": ["vancomycin"], "nsaid": ["ibuprofen"]}
    got = {r["hadm_id"]: r.asDict() for r in fx.keyword_group_windows(pres, adm, groups).collect()}
    r = got[1]
    assert r["ft_any_nephrotoxin_rx"] == 1 and r["ft_any_nephrotoxin_rx_within_24"] == 1
    assert r["ft_nephrotoxin_ibuprofen_rx"] == 1 and r["ft_nephrotoxin_ibuprofen_rx_within_48"] == 0
    assert r["ft_nephrotoxin_ibuprofen_rx_within_72"] == 1 and r["ft_nephrotoxin_nsaid_rx_within_72"] == 1
    assert got[2]["ft_any_nephrotoxin_rx"] == 0


def test_code_flags(spark):
    ev = spark.createDataFrame([(1, "74177", "x"), (1, "94003", "Invasive vent"), (2, "94003", None), (3, None, None)],
                               "hadm_id int, cpt_cd string, description string")
    got = {r["hadm_id"]: (r["ft_contrast_imaging"], r["ft_mechanical_ventilation"]) for r in
           fx.code_flags(ev, {"ft_contrast_imaging": ["74177", "74177"]},
                         {"ft_mechanical_ventilation": ("94003", "invasive")}).collect()}
    assert got == {1: (1, 1), 2: (0, 0), 3: (0, 0)}
    pre = {r["hadm_id"] for r in fx.code_prefix_flag(ev, ["74"], ["74177"]).collect()}
    assert pre == {1}


def brute_serial(rows):
    df = pd.DataFrame(rows, columns=["hadm_id", "eventtime", "label", "valuenum", "row_order"])
    df = df[df.label.str.lower().str.contains("creatin") & (df.valuenum <= 11)]
    df = df.assign(nt=df.eventtime.isna()).sort_values(["hadm_id", "nt", "eventtime", "row_order"])
    out = {}
    for hid, g in df.groupby("hadm_id"):
        vals, times = list(g.valuenum), list(g.eventtime)
        rise = 0
        for i in range(len(vals)):
            pv, pt = (vals[i], times[i]) if i == 0 else (vals[i - 1], times[i - 1])
            dtime = None if (pd.isna(times[i]) or pd.isna(pt)) else times[i] - pt
            if vals[i] - pv >= 0.3 and dtime is not None and dtime <= dt.timedelta(hours=48):
                rise = 1
        base = vals[0]
        out[hid] = {"ft_creatinine_increase_within_48": rise,
                    "ft_creatinine_increase_from_baseline": int(max(vals) >= 1.5 * base),
                    "ft_baseline_creat_gt_1": int(base > 1), "ft_baseline_creatinine": base,
                    "ft_avg_creatinine": sum(vals) / len(vals)}
    return out


@pytest.mark.parametrize("seed,hot_rows", [(11, 1_000_000), (12, 1_000_000), (13, 1_000_000), (14, 2), (15, 3)])
def test_serial_change_matches_sort_and_shift(spark, seed, hot_rows):
    rnd = random.Random(seed)
    rows, rid = [], 0
    for hid in range(6):
        for _ in range(rnd.choice([1, 5, 40])):
            rid += 1
            t = None if rnd.random() < 0.08 else h(rnd.choice([0, 0, 1, 2, 30, 31, 49, 50, 200, 201, 500]) + rnd.random())
            rows.append((hid, t, rnd.choice(["Creatinine", "creatinine (serum)", "HR"]),
                         rnd.choice([0.5, 0.9, 1.0, 1.2, 1.5, 1.8, 2.4, 12.0]), rid))
    df = spark.createDataFrame(rows, "hadm_id int, eventtime timestamp_ntz, label string, valuenum double, row_order int")
    got = {r["hadm_id"]: r.asDict() for r in fx.serial_change(df, hot_rows=hot_rows).collect()}
    exp = brute_serial(rows)
    assert set(got) == set(exp)
    for k, rec in exp.items():
        for c, v in rec.items():
            assert math.isclose(got[k][c], v) if isinstance(v, float) else got[k][c] == v, (seed, k, c)


# ----------------------------------------------------------------- label / categories
def test_category_label_onehot_select_unmapped(spark):
    from cohortforge.operators.joins import MergeValidationError
    diag = spark.createDataFrame([(1, 10, "a"), (1, 10, "b"), (2, 20, "z"), (3, 30, "c"), (None, 40, "a")],
                                 "hadm_id int, subject_id int, icd9_code string")
    xw = spark.createDataFrame([("a", "135"), ("b", "19"), ("c", None)], "icd string, hcc string")
    adm = spark.createDataFrame([(1, 10, T0, h(48)), (2, 20, T0, h(5))],
                                "hadm_id int, subject_id int, admittime timestamp_ntz, dischtime timestamp_ntz")
    lab = {r["hadm_id"]: (r["hcc_cd_135"], r["admittime"]) for r in fx.category_label(diag, xw, adm).collect()}
    # unmapped (2) and null-category (3) codes give 0; admissions without diagnoses are absent
    assert lab == {1: (1, T0), 2: (0, T0), 3: (0, None)}
    onehot = fx.category_onehot(diag, xw)
    got = {r["hadm_id"]: (r["hcc_cd_135"], r["hcc_cd_19"]) for r in onehot.collect()}
    assert got == {1: (1, 1), 2: (0, 0), 3: (0, 0)}
    one = fx.category_select(onehot, "19", "ft_hcc_cd_19_dbtes_wo_comp")
    assert one.columns == ["hadm_id", "ft_hcc_cd_19_dbtes_wo_comp"]
    assert fx.category_select(onehot).columns == ["hadm_id", "hcc_cd_135", "hcc_cd_19"]
    # substring form: "_1" keeps every category containing it; the exact name is renamed
    sub = fx.category_select(onehot, "_1", "ft_one", match="contains")
    assert sub.columns == ["hadm_id", "hcc_cd_135", "hcc_cd_19"]
    sub = fx.category_select(onehot.withColumn("hcc_cd_1", F.lit(0)), "_1", "ft_one", match="contains")
    assert sub.columns == ["hadm_id", "hcc_cd_135", "hcc_cd_19", "ft_one"]
    assert fx.category_select(onehot, "_19", match="contains").columns == ["hadm_id", "hcc_cd_19"]
    titles = spark.createDataFrame([("z", "zoster"), ("a", "acute")], "icd9_code string, short_title string")
    assert [(r["short_title"], r["n"]) for r in fx.unmapped_codes(diag, xw, titles).collect()] == [("zoster", 1)]
    dup = spark.createDataFrame([("a", "135"), ("a", "2")], "icd string, hcc string")
    with pytest.raises(MergeValidationError):
        fx.category_label(diag, dup, adm)


# ------------------------------------------------------------ hot slots, two-level windows
@pytest.mark.parametrize("hot_rows", [1_000_000, 3, 1])
def test_two_level_windows_split_hot_slots(spark, hot_rows):
    from cohortforge.operators.windows import hour_bucket, previous_values, running_aggregates, second_of_slot
    rnd = random.Random(hot_rows)
    rows = []
    for i in range(400):
        k = "hot" if i % 5 else rnd.choice(["a", "b"])
        secs = rnd.choice([0, 1, 1, 2, 59, 3599, 3600, 3601, 7300, 90000])
        t = None if rnd.random() < 0.03 else T0 + dt.timedelta(seconds=secs, microseconds=rnd.choice([0, 500]))
        rows.append((k, t, i, float(rnd.randint(0, 9))))
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, i int, v double")
    order = [F.col("t"), F.col("i")]
    split = second_of_slot(F.col("t"))
    prev = previous_values(df, "k", hour_bucket(F.col("t")), order, ["v"], split=split, hot_rows=hot_rows)
    run = running_aggregates(df, "k", hour_bucket(F.col("t")), order, {"s": F.col("v")}, {"m": F.col("v")},
                             split=split, hot_rows=hot_rows)
    pdf = pd.DataFrame(rows, columns=["k", "t", "i", "v"])
    pdf = pdf.assign(nt=pdf.t.isna()).sort_values(["k", "nt", "t", "i"])
    pdf["prev_v"] = pdf.groupby("k").v.shift(1).fillna(pdf.v)
    pdf["s"] = pdf.groupby("k").v.cumsum()
    pdf["m"] = pdf.groupby("k").v.cummax()
    exp = {r.i: (r.prev_v, r.s, r.m) for r in pdf.itertuples()}
    got_p = {r["i"]: r["prev_v"] for r in prev.collect()}
    got_r = {r["i"]: (r["s"], r["m"]) for r in run.collect()}
    assert len(got_p) == len(got_r) == len(rows)
    for i, (pv, s, m) in exp.items():
        assert got_p[i] == pv and got_r[i] == (s, m), (i, got_p[i], got_r[i], pv, s, m)
