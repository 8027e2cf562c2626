"""Table schemas, naming schemes and the fixed texts of the source reports."""

from pyspark.sql import types as T

# Texts that appear in the reports and decide how a row is read.
NONE_TEXT = "없음"
UNDETERMINED_TEXT = "미확정"
RESERVED_TEXT = "계약중"
MANUAL_TEXT = "수동"
NO_RESULTS_TEXT = "검색 조건에 맞는 차량이 없습니다"
PRICE_MISSING_TEXT = "가격 없음"
NOT_AVAILABLE = "N/A"

# Thresholds.
MIN_PRICE = 200
OUTLIER_Z = 3.0
ROW_CAP = 25_600
COLLECT_TARGET = 10_000
SATURATION_SCALE = 100_000.0
DAYS_PER_YEAR = 365.25

# Column roles in the feature tables.
YES_NO_COLUMNS = ["tuning_history", "special_history", "usage_change", "accident", "little_accident"]
NUMBER_COLUMNS = ["license_changed", "owner_changed", "total_loss", "flood", "theft"]
LOG_COLUMNS = ["owner_changed", "damaged_count", "damaged_total", "mileage", "car_age"]
NOT_FEATURES = ["model", "fuel", "cc", "price", "owner_changed"]


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


_S, _I, _L = T.StringType(), T.IntegerType(), T.LongType()

VEHICLES_PRICE = _table(id=_L, price=_I)

HISTORY_RAW = _table(
    id=_L, license=_S, model=_S, fuel=_S, cc=_S, registration_date=_S,
    license_changed=_S, owner_changed=_S, total_loss=_S, flood=_S, theft=_S, cm=_S, co=_S,
)

VEHICLES_HISTORY = _table(
    id=_L, license=_S, model=_S, fuel=_S, cc=_S, registration_date=_S,
    license_changed=_I, owner_changed=_I, total_loss=_I, flood=_I, theft=_I,
    damaged_count=_I, damaged_total=_L, damaged_by_other_count=_I, damaged_by_other_total=_L,
)

VEHICLES_STATUS = _table(
    id=_L, transmission=_S, warranty=_S, mileage=_S, tuning_history=_S,
    special_history=_S, usage_change=_S, accident=_S, little_accident=_S,
)

ERROR_IDS = _table(id=_L)

COLLECTED = _table(
    id=_L, price=_S, car_number=_S, registration_date=_S, transmission=_S, fuel_type=_S,
    mileage=_S, mileage_condition=_S, chassis_number=_S, tuning=_S, special_history=_S,
    usage_change=_S, emission_gas=_S, recall=_S, car_name=_S, year=_S,
)

PAGES = _table(page_id=_L, url=_S, html=_S)

# The three header styles seen for the same insurance columns.
INSURANCE_NAMES = {
    "current": ["id", "license", "license_changed", "owner_changed", "total_loss", "flood", "theft", "cm", "co"],
    "merge": ["ID", "N", "NC", "OC", "TL", "FD", "TF", "CM", "CO"],
    "report": [
        "Vehicle ID", "Car Number", "Number Change History", "Owner Change History",
        "Total Loss History", "Flood Damage History", "Theft History",
        "Insurance Claim (My Car)", "Insurance Claim (Other Car)",
    ],
}


def insurance_schema(scheme: str) -> T.StructType:
    """All-text schema of an insurance file whose headers follow ``scheme``."""
    return T.StructType([T.StructField(name, _S, True) for name in INSURANCE_NAMES[scheme]])
