"""Fixed values that results depend on: labels, lookup tables, formats and published texts.

Everything here is data, stated as the publisher states it. Functions take these as defaults,
so another publisher's labels can be passed instead.
"""

from __future__ import annotations

# ---- fixed values: enumerations -------------------------------------------------------------
LIST_TYPES = ("ipdc", "op")
POPULATIONS = ("Adult", "Child")

HOSPITAL = "hospital"
HOSPITAL_SPECIALTY = "hospital_specialty"
NATIONAL_SPECIALTY = "national_specialty"
SPECIALTY_GRANULARITIES = (HOSPITAL_SPECIALTY, NATIONAL_SPECIALTY)

# ---- fixed values: duration bands -----------------------------------------------------------
WIDE_BANDS = ("0-6 Months", "6-12 Months", "12-18 Months", "18 Months +")
UNDER_6, SIX_TO_12, TWELVE_PLUS = "Under 6 Months", "6-12 Months", "12+ Months"
BUCKETS = (UNDER_6, SIX_TO_12, TWELVE_PLUS)
UNKNOWN_BUCKET = "Unknown"
BUCKET_COLUMNS = ("under_6", "six_to_12", "twelve_plus")

# ---- fixed values: suppression --------------------------------------------------------------
SUPPRESSED_HOSPITAL_LABEL = "Small Volume Hospitals"
SUPPRESSED_SPECIALTY_LABELS = ("Small Volume Specialities", "Small Volume Specialties")
SUPPRESSION_MARKERS = ("small volume", "<5", "n/a")
MINIMUM_CELL = 5

# ---- fixed values: earlier name -> current name ---------------------------------------------
HOSPITAL_ALIASES = {
    "Galway University Hospital": "Galway University Hospitals",
    "Connolly Hospital": "Connolly Hospital Blanchardstown",
    "Kerry General Hospital": "University Hospital Kerry",
    "Letterkenny General Hospital": "Letterkenny University Hospital",
    "St. Michael's Hospital": "St. Michael's Hospital Dun Laoghaire",
    "Tallaght Hospital": "Tallaght University Hospital",
    "Tallaght Children's Hospital": "Children's Health Ireland",
    "Temple Street Children's University Hospital": "Children's Health Ireland",
    "Childrens University Hospital Temple Street": "Children's Health Ireland",
    "National Childrens Hospital at Tallaght University Hospital": "Children's Health Ireland",
    "Our Lady's Children's Hospital Crumlin": "Children's Health Ireland",
    "Cork University Maternity Hospital ": "Cork University Maternity Hospital",
    "National Orthopaedic Hospital Cappagh": "Cappagh National Orthopaedic Hospital",
    "Lourdes Orthopaedic Hospital Kilcreene": "Kilcreene Regional Orthopaedic Hospital",
    "Mayo General Hospital": "Mayo University Hospital",
    "Portiuncula Hospital": "Portiuncula University Hospital",
    "Roscommon Hospital": "Roscommon University Hospital",
    "Sligo Regional Hospital": "Sligo University Hospital",
}

# Words too common in institution names to tell two of them apart.
GENERIC_NAME_WORDS = ("general", "hospital", "regional", "the", "university")

# ---- fixed values: cells read as missing (the defaults of pandas.read_csv) --------------------
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# ---- fixed values: datasets and the years each shape family covers --------------------------
IPDC_HOSPITAL, OP_HOSPITAL = "ipdc_hospital", "op_hospital"
IPDC_SPECIALTY, OP_SPECIALTY = "ipdc_specialty", "op_specialty"
DATASET_LIST_TYPE = {
    IPDC_HOSPITAL: "ipdc",
    IPDC_SPECIALTY: "ipdc",
    OP_HOSPITAL: "op",
    OP_SPECIALTY: "op",
}

WIDE, LONG, LONG_EARLY, WIDE_SPECIALTY = "wide", "long", "long_early", "wide_specialty"
YEARS_OF_FAMILY = {
    WIDE: ("2021_apr_dec", "2022", "2023", "2024", "2025", "2026"),
    LONG: ("2018", "2019", "2020", "2021_jan_mar"),
    LONG_EARLY: ("2014", "2015", "2016", "2017"),
}

# Raw table name prefix -> dataset.
TABLE_PREFIXES = {
    "ntpf_ipdc_speciality_": IPDC_SPECIALTY,
    "ntpf_ipdc_historical_": IPDC_HOSPITAL,
    "ntpf_op_speciality_": OP_SPECIALTY,
    "ntpf_op_historical_": OP_HOSPITAL,
}

# ---- fixed values: where the publisher keeps each year's file -------------------------------
UPLOADS = "https://www.ntpf.ie/app/uploads/"
PUBLISHED_FILES = {
    IPDC_HOSPITAL: {
        "2026": "2026/07/OpenData_IPDCNational01.csv",
        "2025": "2026/01/OpenData_IPDCNational01_2025.csv",
        "2024": "2025/01/OpenData_IPDCNational01_2024-1.csv",
        "2023": "2024/10/OpenData_IPDCNational01_2023.csv",
        "2022": "2024/10/OpenData_IPDCNational01_2022.csv",
        "2021_apr_dec": "2024/10/OpenData_IPDCNational01_2021.csv",
        "2021_jan_mar": "2024/10/IPDC-Waiting-List-By-Group-Hospital-2021.csv",
        "2020": "2024/10/IPDC-Waiting-List-By-Group-Hospital-2020.csv",
        "2019": "2025/02/IPDC-Waiting-List-by-Group-Hospital-2019.csv",
        "2018": "2025/02/IPDC-Waiting-List-by-Group-Hospital-2018.csv",
        "2017": "2025/02/IPDC-Waiting-List-By-Group-Hospital-2017.csv",
        "2016": "2025/02/IPDC-Waiting-List-By-Group-Hospital-2016.csv",
        "2015": "2025/02/IPDC-Waiting-List-By-Group-Hospital-2015.csv",
        "2014": "2025/02/IPDC-Waiting-List-By-Group-Hospital-2014.csv",
    },
    OP_HOSPITAL: {
        "2026": "2026/07/OpenData_OPNational01.csv",
        "2025": "2026/01/OpenData_OPNational01_2025.csv",
        "2024": "2025/01/OpenData_OPNational01_2024-1.csv",
        "2023": "2024/10/OpenData_OPNational01_2023-2.csv",
        "2022": "2024/10/OpenData_OPNational01_2022.csv",
        "2021_apr_dec": "2024/10/OpenData_OPNational01_2021-1.csv",
        "2021_jan_mar": "2024/10/OP-Waiting-List-By-Group-Hospital-2021-1.csv",
        "2020": "2024/10/OP-Waiting-List-by-Group-Hospital-2020.csv",
        "2019": "2025/02/OP-Waiting-List-by-Group-Hospital-2019.csv",
        "2018": "2025/02/OP-Waiting-List-by-Group-Hospital-2018.csv",
    },
    IPDC_SPECIALTY: {
        "2026": "2026/07/OpenData_IPDCNational02.csv",
        "2025": "2026/01/OpenData_IPDCNational02_2025.csv",
        "2024": "2025/01/OpenData_IPDCNational02_2024-1.csv",
        "2023": "2024/10/OpenData_IPDCNational02_2023-1.csv",
        "2022": "2024/10/OpenData_IPDCNational02_2022-1.csv",
        "2021_apr_dec": "2024/10/OpenData_IPDCNational02_2021.csv",
    },
    OP_SPECIALTY: {
        "2026": "2026/07/OpenData_OPNational02.csv",
        "2025": "2026/01/OpenData_OPNational02_2025.csv",
        "2024": "2025/01/OpenData_OPNational02_2024-1.csv",
        "2023": "2024/10/OpenData_OPNational02_2023-1.csv",
        "2022": "2024/10/OpenData_OPNational02_2022-1.csv",
        "2021_apr_dec": "2024/10/OpenData_OPNational02_2021-1.csv",
    },
}

# ---- fixed values: column names in published files -> canonical names -----------------------
# Several published spellings may feed one canonical column.
HEADER_NAMES = {
    "archive_date": ("ArchiveDate", "Archive_Date", "Archive Date"),
    "hospital_group": ("Hospital_Group", "Group"),
    "hospital_hipe": ("Hospital_HIPE", "Hospital HIPE"),
    "hospital_name": ("HospitalName", "Hospital_Name", "Hospital"),
    "specialty_hipe": ("Specialty_HIPE", "Specialty_HIPE1", "Specialty HIPE"),
    "specialty_name": ("Specialty_Name", "Specialty", "Speciality"),
    "case_type": ("Case_Type", "Case Type"),
    "adult_child": ("Adult_Child", "Adult/Child"),
    "time_band": ("Time_Bands", "Time Bands"),
    "count": ("Count", "Total"),
}

# Column names of the single-file wide table.
WIDE_TABLE_NAMES = {
    "ArchiveDate": "archive_date",
    "Adult_Child": "adult_child",
    "HospitalName": "hospital_name",
    "0-6 Months": "months_0_6",
    "6-12 Months": "months_6_12",
    "12-18 Months": "months_12_18",
    "18 Months +": "months_18_plus",
    "Total": "total",
}
WIDE_TABLE_COUNTS = ("months_0_6", "months_6_12", "months_12_18", "months_18_plus", "total")

# ---- fixed values: ranking and lookup defaults ----------------------------------------------
TOP_SPECIALTIES = 15
DEFAULT_SLUG = "beaumont-hospital"
NATIONAL_NAME, NATIONAL_SLUG = "National", "national"

# ---- fixed values: published texts ----------------------------------------------------------
SOURCE = "National Treatment Purchase Fund (NTPF), Open Data — Waiting List Data"
BAND_NOTE = (
    "Time bands grouped into Under 6 / 6-12 / 12+ months by starting wait length, since NTPF's own "
    "band boundaries changed at the same point (2022+ files use 0-6/6-12/12-18/18+ months; pre-2021 "
    "files use 0-3/3-6/6-9/9-12/12+ months) and are not directly comparable band-for-band."
)
METHODOLOGY_NOTES = {
    "ipdc": "Pre-2021 figures summed across Inpatient + Day Case and all specialties for "
    "comparability with the combined post-2021 reporting format. " + BAND_NOTE,
    "op": "Outpatient appointments have no Inpatient/Day Case split to sum across (a single "
    "appointment type), unlike IPDC. " + BAND_NOTE + " Outpatient data is only available from 2018 "
    "onward — NTPF has not published OP data for 2014-2017, unlike IPDC which covers the full range.",
}
NATIONAL_NOTE = (
    " National total is summed across every hospital (excluding NTPF's separate by-Speciality "
    "file, which would double-count)."
)
SERIES_LIMITATIONS = (
    "Adult and Child are NTPF's own classification (no further age breakdown is published). A "
    "hospital with no patients in a population shows an empty chart for that toggle rather than "
    "being hidden."
)
SPECIALTY_NOTE = (
    "National total per specialty at the most recent date for that population, broken down into "
    "Under 6 / 6-12 / 12+ months by starting wait length (same bucket rule as the other charts on "
    "this page). Pre-2021: summed across all hospitals from the by-Hospital file's specialty "
    "breakdown. 2021+: NTPF's separate by-Speciality file (national totals only, no hospital "
    "breakdown)."
)
SPECIALTY_NOTES = {
    "ipdc": SPECIALTY_NOTE,
    "op": SPECIALTY_NOTE + " The OP by-Speciality source file has two NTPF-published rows per "
    "specialty/date/population that aren't individually labelled (likely New vs. Review "
    "appointments — an inference, not confirmed by NTPF); both are summed into the single total "
    "shown here, verified to reconcile exactly against the OP-by-Hospital national total.",
}
RANKING_NOTE = (
    "Showing the %d largest specialties by current waiting list volume, out of %d specialties "
    "tracked for this combination."
)
EMPTY_RANKING_NOTE = "No specialty-level data available for this combination."

# ---- fixed values: rules for a dataset's metadata record ------------------------------------
METADATA_REQUIRED = (
    "dataset_id", "title", "owner", "source_name", "source_url", "licence", "attribution_required",
    "redistribution_allowed", "variables", "geography_level", "update_frequency", "download_date",
    "processing_date", "citation", "small_cell_suppression_applied",
)
METADATA_OPTIONAL = ("quality_notes", "known_limitations")
DATASET_ID_PATTERN = "^[a-z0-9-]+$"
GEOGRAPHY_LEVELS = ("national", "hse-region", "county", "hospital", "hospital-group")
METADATA_BOOLEANS = ("redistribution_allowed", "small_cell_suppression_applied")
METADATA_DATES = ("download_date", "processing_date")
METADATA_ADDRESSES = ("source_url",)
METADATA_LISTS = ("variables",)

REGISTER_COLUMNS = (
    "dataset_id", "source", "licence", "attribution_required", "redistribution_allowed", "added",
)
