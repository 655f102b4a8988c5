"""Fixed values. They must equal the clinic system's codes for right results."""

# Encounter types.
MED_PICKUP_TYPES = [153, 158, 186]
MED_PICKUP_TYPES_OLD = [158, 186]
NON_VISIT_TYPES = [186, 99999]
LAB_ENTRY_TYPES = [111, 99999]
TRANSFER_TYPE = 116
TRANSFER_INTERNAL = 9998
TRANSFER_EXTERNAL = 9999

# Sites whose appointments are scored.
TARGET_SITES = [
    1, 2, 3, 4, 8, 9, 11, 12, 13, 14, 15, 17, 19, 20, 23, 26, 28, 31, 54, 55, 58, 60, 62, 64, 65,
    69, 70, 71, 72, 73, 74, 75, 76, 77, 78, 79, 83, 84, 86, 90, 91, 94, 98, 100, 102, 106, 116,
    130, 134, 135, 140, 144, 147, 148, 153, 176, 186, 192, 195, 196, 197, 198, 199, 201, 203, 206,
    208, 211, 214, 218, 227, 229, 230, 280, 306, 310, 311, 312, 313, 314, 315, 316, 317, 319, 320,
    321, 322, 323, 324, 325, 326, 327, 329, 330, 333, 334, 335, 336, 337, 338, 340, 341, 342, 351,
    352, 353, 393, 394, 396, 397, 398, 399, 400, 404, 406, 411, 414, 416, 418, 420, 421, 422, 423,
    424, 425, 426, 427, 428, 434, 435, 437, 438, 439, 451, 492, 496, 497, 498,
]

# Urban and rural sites.
URBAN_SITES = [
    1, 8, 9, 11, 12, 13, 14, 15, 17, 19, 20, 23, 26, 55, 78, 130, 197, 198, 214, 227, 229, 230,
    306, 310, 312, 313, 315, 319, 321, 341, 342, 420, 421, 422, 423,
]
RURAL_SITES = [
    64, 65, 74, 75, 76, 79, 83, 86, 90, 91, 100, 106, 135, 311, 314, 316, 320, 336,
]

# Encounter class by encounter-type name.
ENCOUNTER_CLASSES = {
    "Initial": ["ADULTINITIAL", "PEDSINITIAL", "YOUTHINITIAL"],
    "Return": ["ADULTRETURN", "PEDSRETURN", "YOUTHRETURN"],
}

# Harmonised groups, label -> raw answers.
TRAVEL_TIME_GROUPS = {
    "LESS THAN ONE HOUR": ["LESS THAN ONE HOUR", "30 TO 60 MINUTES", "LESS THAN 30 MINUTES"],
    "MORE THAN ONE HOUR": ["MORE THAN ONE HOUR", "ONE TO TWO HOURS", "MORE THAN TWO HOURS"],
}
EDUCATION_GROUPS = {
    "SECONDARY SCHOOL": ["FORM 1 TO 2", "FORM 3 TO 4", "SECONDARY SCHOOL"],
    "PRIMARY SCHOOL": ["PRE PRIMARY", "PRE UNIT", "STANDARD 1 TO 3", "STANDARD 4 TO 8"],
    "COLLEGE / UNIVERSITY": ["COLLEGE", "UNIVERSITY"],
}
OCCUPATION_GROUPS = {
    "EMPLOYED": [
        "TEACHER", "POLICE OFFICER", "HEALTH CARE PROVIDER",
        "VOLUNTARY TESTING AND COUNSELING CENTER COUNSELOR", "CLINICIAN", "FORMAL EMPLOYMENT",
        "INDUSTRIAL WORKER", "LABORATORY TECHNOLOGIST", "MECHANIC", "MINER", "NURSE",
        "OTHER HEALTH WORKER", "TRUCK DRIVER", "CASUAL WORKER", "CIVIL SERVANT", "CLEANER",
    ],
    "SELF EMPLOYMENT": ["FARMER", "FISHING", "SELF EMPLOYMENT", "SEX WORKER", "BODA-BODA"],
    "UNEMPLOYED": ["UNEMPLOYED", "OTHER NON-CODED", "NOT APPLICABLE", "HOUSEWIFE", "STUDENT"],
}
ENTRY_POINT_GROUPS = {
    "INPATIENT / OUTPATIENT SERVICE": ["ADULT INPATIENT SERVICE", "OUTPATIENT SERVICES"],
    "OTHER": [
        "HIV COMPREHENSIVE CARE UNIT", "SEXUALLY TRANSMITTED INFECTION", "TUBERCULOSIS",
        "OTHER NON-CODED", "OSCAR PROGRAM", "SELF TEST",
    ],
    "PEDIATRIC SERVICE": ["MATERNAL CHILD HEALTH PROGRAM", "PEDIATRIC INPATIENT SERVICE"],
    "HOME BASED TESTING": [
        "HOME BASED TESTING PROGRAM", "PERPETUAL HOME-BASED COUNSELING AND TESTING",
    ],
    "VOLUNTARY COUNSELING AND TESTING CENTER": [
        "HIV TESTING SERVICES STRATEGY", "VOLUNTARY COUNSELING AND TESTING CENTER",
    ],
}

# Regimens by treatment line, and the line labels.
REGIMENS_BY_LINE = {
    1: [
        "3TC + AZT + ABC", "3TC + EFV + ABC", "3TC + EFV + AZT", "3TC + EFV + TDF",
        "3TC + NVP + ABC", "3TC + NVP + AZT", "3TC + NVP + TDF", "3TC + RTV + AZT + ATV",
        "3TC + RTV + AZT + LOP", "3TC + RTV + TDF + ATV", "3TC + RTV + TDF + LOP",
        "3TC + TDF + DTG", "d4T + 3TC + EFV", "d4T + 3TC + NVP",
    ],
    2: [
        "3TC + ABC + DTG", "3TC + ABC + ETR", "3TC + AZT + DTG", "3TC + RTV + ABC + ATV",
        "3TC + RTV + ABC + LOP",
    ],
    3: ["3TC + RTV + TDF + LOP + DTG"],
}
OTHER_LINE = 5
LINE_LABELS = {
    1: ["FIRST LINE HIV ANTIRETROVIRAL DRUG TREATMENT"],
    2: ["SECOND LINE HIV ANTIRETROVIRAL DRUG TREATMENT"],
    3: ["THIRD LINE HIV ANTIRETROVIRAL DRUG TREATMENT"],
}

# Drug names by code, for the test views; a deployment passes its own table.
DRUG_NAMES = {
    "628": "3TC", "630": "AZT", "631": "NVP", "632": "TDF", "633": "EFV", "1400": "DTG",
}

# Care status by concept code.
CARE_STATUS = {
    6101: "Continue", 6102: "Discontinue", 6103: "Re-enroll", 1267: "Completed",
    1187: "Not Done", 5488: "Adherence Counselling", 7272: "Urgent Referrals",
    7278: "Non-urgent Referrals",
}
DISENGAGED_STATUS = [6102]
ENGAGED_STATUS = [6101, 6103, 1267, 1187, 7272, 5488, 7278]

# Answer scales.
LIKERT = {
    "Strongly Disagree": 1, "Disagree": 2, "Neutral": 3, "Agree": 4, "Strongly Agree": 5,
}

# Person attributes kept as observations, by concept.
PERSON_CONCEPTS = {
    "marital_status": [1054], "entry_point": [2051], "occupation": [1972, 1973],
    "education": [1605], "distance": [1710], "travel_time": [5605], "hiv_progression": [8365],
}

# Plausible ranges of the deployed model; others pass as parameters.
PLAUSIBLE_RANGES = {
    "duration_in_care": (0, 100), "bmi": (10, 35), "cd4": (0, 1500),
    "viral_load_log10": (-10, 10), "bmi_baseline": (10, 35), "cd4_baseline": (0, 1500),
    "viral_load_log10_baseline": (-10, 10),
}
DEFAULT_DAYS_RANGE = (-31, 365)
LAB_AGE_RANGE = (0, 1000)

# Outcome horizons in days, at least this late ...
HORIZONS = {"1day": 1, "7days": 7, "2wks": 14, "1month": 28, "3month": 90}
# ... and of the first model generation, later than this.
HORIZONS_OLD = {"1day": 1, "7days": 7, "2wks": 14, "1month": 30, "3month": 90}

DISENGAGED = "Disengaged"
ACTIVE = "Active In Care"

# Cut-off positions of the risk bands, and the batch size below which
# cut-offs on record are used.
HIGH_SHARE = 0.9
MEDIUM_SHARE = 0.8
SMALL_BATCH = 50
HIGH_RISK = "High Risk"
MEDIUM_RISK = "Medium Risk"

ADULT_AGE = 18
FOLDS = 11

# Predictors of the deployed 7-day models, in their order. The 1-day models
# leave out the 7-day count.
PREDICTORS = [
    "age", "age_NA", "gender", "num_1day_defaults_last_3visits", "num_7days_defaults_last_3visits",
    "clinic_county", "log_days_defaulted", "log_days_defaulted_NA", "size_enrollments_log10",
    "volume_visits_log10", "care_programme", "days_since_vl", "days_since_vl_NA", "visit_number",
    "disclosure", "program_name", "days_since_cd4", "days_since_cd4_NA", "month",
    "tb_test_result", "viral_load_log10", "viral_load_log10_NA", "bmi", "bmi_NA", "cd4", "cd4_NA",
    "facility_type",
]
CATEGORIES = [
    "gender", "clinic_county", "care_programme", "disclosure", "program_name", "month",
    "tb_test_result", "facility_type",
]
# Columns with a missing indicator, and the fill values of all predictors.
MEASURED = [
    "age", "log_days_defaulted", "days_since_vl", "days_since_cd4", "viral_load_log10", "bmi", "cd4",
]
FILLS = {
    "age": 0, "log_days_defaulted": 0.0, "days_since_vl": 0, "days_since_cd4": 0,
    "viral_load_log10": 0.0, "bmi": 0.0, "cd4": 0, "size_enrollments_log10": 0.0,
    "volume_visits_log10": 0.0, "gender": "Unknown", "clinic_county": "Other",
    "care_programme": "Other", "disclosure": "Not Done", "program_name": "Unknown",
    "month": "Unknown", "tb_test_result": "Unknown", "facility_type": "Other",
}
