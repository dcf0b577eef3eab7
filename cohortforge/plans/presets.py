"""AKI preset: the parameter values of the acute-kidney-injury feature set.

Fixed values. They must equal the original feature definitions for the same
results, so they are kept verbatim, in their natural order, in one place.
"""

# --- fixed values -----------------------------------------------------------
LABEL_CATEGORY = "135"

COMORBIDITIES = {  # category code -> output column
    "19": "ft_hcc_cd_19_dbtes_wo_comp",
    "136": "ft_hcc_cd_136_ckd_stg_5",
    "137": "ft_hcc_cd_137_ckd_stg_4",
    "85": "ft_hcc_cd_85_chf",
    "108": "ft_hcc_cd_108_vascular",
    "1": "ft_hcc_cd_1_hiv_aids",
    "2": "ft_hcc_cd_2_sepsis",
    "29": "ft_hcc_cd_29_chronic_hepatitis",
}

DRUG_GROUPS = {
    "antibiotics": ["bacitracin", "vancomycin", "amphotericin", "cephalexin", "cefadroxil", "tobramycin",
                    "gentamicin", "neomycin", "ciprofloxacin"],
    "blood_pressure": ["lisinopril", "ramipril", "metoprolol", "candesartan", "valsartan", "warfarin"],
    "diuretic": ["furosemide", "torsemide"],
    "nsaid": ["ibuprofen", "naproxen"],
    "ulcer": ["cimetidine"],
    "other": ["propofol"],
}
DRUG_WINDOW_HOURS = (24, 48, 72)

DRUG_GROUPS_V1 = {  # older list (18 drugs, group 'edema')
    "antibiotics": ["bacitracin", "vancomycin", "amphotericin", "cephalosporin", "aminoglycoloside", "ciprofloxacin"],
    "blood_pressure": ["lisinopril", "ramipril", "metoprolol", "candesartan", "valsartan", "warfarin"],
    "edema": ["furosemide"],
    "nsaid": ["ibuprofen", "naproxen", "ketoprofen"],
    "ulcer": ["cimetidine"],
    "other": ["propofol"],
}

CONTRAST_CODES = ["74177", "74160", "71260", "74177", "73701", "73201", "70460", "70487", "70491", "70481",
                  "72193", "72126", "72132", "72129", "75574", "75572", "70545", "70548"]
CONTRAST_PREFIXES = ["70", "71", "72", "73", "74", "75"]

VENTILATION_CODE = "94003"
VENTILATION_TEXT = "invasive"

OTHER_VISIT_DAYS = (30, 60, 90, 120)
CARE_UNITS = ("micu", "ccu")

LABS = {
    "ft_low_sodium": dict(label_contains="sodium", fluid="blood", op="<", cut=136),
    "ft_high_potassium": dict(label_contains="potassium", fluid="blood", op=">", cut=5),
    "ft_anemic": dict(label_equals="iron", fluid="blood", op="<", cut=50, as_bool=True),
}

BLOOD_PH = dict(label_any=("pH", "PH"), cut=7.30, hours=(6, 12, 24, 36, 48))

PRESSURE_BANDS = {  # name: (systolic rule, diastolic rule, how they combine); a rule is (operator, limit, limit)
    "ft_elevated_bp": (("between", 120, 129), ("<", 80, None), "and"),
    "ft_abnormally_low_bp": (("<", 119, None), ("<", 79, None), "and"),
    "ft_hbp_stg_1": (("between", 130, 139), ("between", 80, 89), "or"),
    "ft_hbp_stg_2": (("between", 140, 179), ("between", 90, 119), "or"),
    "ft_hbp_crisis": ((">", 180, None), (">", 120, None), "or"),
}
PRESSURE_EXCLUDE = ("unloading", "pulmonary", "pap")
PRESSURE_WINDOW_HOURS = (6, 12, 24, 36, 48)

HEMATOCRIT = dict(exclude=("apache",), in_group_range=(42, 50), other_range=(37, 47), very_low=20)

CREATININE = dict(match="creatin", max_value=11, rise=0.3, rise_hours=48, ratio=1.5, baseline_gt=1)

UNKNOWN_ETHNICITY = ("ft_race_patient_declined_to_answer", "ft_race_unable_to_be_obtained",
                     "ft_race_unknown_not_specified")

LITERATURE_FEATURES = ["ft_age", "ft_creatinine_increase_within_48", "ft_avg_hematocrit", "ft_hcc_cd_2_sepsis",
                       "ft_avg_icu_los_within_30", "ft_baseline_creatinine", "ft_gender",
                       "ft_nephrotoxin_diuretic_rx_within_24", "ft_nephrotoxin_ibuprofen_rx_within_24",
                       "ft_low_blood_ph_within_12_hrs", "ft_high_potassium", "ft_hcc_cd_19_dbtes_wo_comp",
                       "ft_hcc_cd_29_chronic_hepatitis", "ft_hcc_cd_85_chf", "ft_hcc_cd_136_ckd_stg_5"]

TREE_SETTINGS = [dict(min_leaf=1), dict(min_leaf=75, min_split=275), dict(min_leaf=50, min_split=500)]
CHI2_EXCLUDE = ("ft_avg_creatinine", "ft_baseline_creatinine")
TOP_K = 25
EXTERNAL_MODELS = [("svm-top-25-features", 0.85690, 0.80227, 0.75233),
                   ("optimized-svm-top-25-features", 0.856475, 0.80246, 0.7514)]
# ---------------------------------------------------------------------------
