"""Fixed values that decide results. They are business constants, kept together as plain text."""

# Customers reported every day.
REPORT_CUSTOMERS = (68, 110)

# Internal part numbers that belong to the reported customers start with this prefix.
PART_PREFIX = "AS"

# Parts carrying this character are dropped when supplier and MPN are both blank.
BLANK_PART_MARK = "$"

# Shown instead of a blank or missing supplier or MPN.
UNKNOWN = "Unknown"

# Where a consumed position was found.
EQUIPMENT_SETUP = "EquipmentSetup"
ROUTE_STEP_SETUP = "RouteStepSetup"
REPLACEMENT = "Replacement"

# Test results, defect flag, confirmed analysis.
PASS, FAIL, ABORT = "P", "F", "A"
DEFECT_FLAG = "F"
CORRECT_ANALYSIS = "C"

# Language in which test status letters are stored.
STATUS_LANGUAGE = 0

# A daily run covers at most this many days; report rows are kept this many years.
MAX_RUN_DAYS = 1
RETENTION_YEARS = 2

# Parts per million. The published formula text multiplies by ten million instead;
# pass that as ``scale`` to reproduce it.
DPPM_SCALE = 1_000_000
FORMULA_TEXT_SCALE = 10_000_000

# Column lengths of the consumed detail (data-quality report).
DETAIL_LENGTHS = {
    "crd": 27,
    "internal_part": 18,
    "descr": 50,
    "grn": 16,
    "supplier": 35,
    "mpn": 50,
    "serial_number": 50,
    "branch": 50,
}
