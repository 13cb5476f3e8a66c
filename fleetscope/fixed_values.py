"""Fixed values of the telemetry domain.

Results only come out right with exactly these labels, lookup tables and
parameters, so they are stated here as plain data and nowhere else.
"""

from decimal import Decimal

# --- fixed values: labels -------------------------------------------------
SHIFTS = ("morning", "afternoon", "night")
MORNING_HOURS = (6, 14)  # [from, to)
AFTERNOON_HOURS = (14, 22)  # [from, to); every other hour is night

ONLINE = "online"
OFFLINE = "offline"
STATUSES = (OFFLINE, ONLINE)

ACTIVE = "active_work"
IDLE = "idle_waiting"
UNAUTHORIZED = "unauthorized_operation"
PARKED = "parked_or_charging_candidate"
AVAILABLE = "available"
SIGNAL_LOSS = "signal_loss_or_offline"
UNKNOWN = "unknown"

VEHICLE_PREFIX = "FL_"
DEFAULT_VIEW = "forklift_data"
SUMMARY_TYPE = "mongodb_summary"

# --- fixed values: anchors and zones --------------------------------------
ANCHOR_ZONES = (
    ("A1", "Production"),
    ("A2", "Storage"),
    ("A3", "WIP"),
    ("A4", "Packing"),
    ("A5", "Production"),
    ("A6", "Charging"),
    ("A7", "Maintenance"),
    ("A8", "WIP"),
)
PARKING_ZONES = ("Charging", "Maintenance")

# zone -> weakest and strongest signal of a visible reading
RSSI_RANGES = (
    ("Production", -75, -50),
    ("WIP", -75, -50),
    ("Storage", -85, -55),
    ("Packing", -85, -55),
    ("Charging", -90, -60),
    ("Maintenance", -90, -60),
)
RSSI_RANGE_ELSEWHERE = (-90, -50)
RSSI_NO_SIGNAL = 0

# --- fixed values: vehicle profiles ---------------------------------------
# vehicle, usage level, risk level, preferred zones
PROFILES = (
    ("FL_01", "high", "high", ("Production", "WIP")),
    ("FL_02", "high", "high", ("Production", "Storage")),
    ("FL_03", "high", "medium", ("WIP", "Packing")),
    ("FL_04", "medium", "medium", ("Storage", "Packing")),
    ("FL_05", "medium", "low", ("Storage", "Charging")),
    ("FL_06", "medium", "low", ("Production", "WIP")),
    ("FL_07", "medium", "low", ("Packing", "Storage")),
    ("FL_08", "low", "low", ("Charging", "Maintenance")),
    ("FL_09", "low", "low", ("Maintenance", "Storage")),
    ("FL_10", "low", "low", ("Charging", "Maintenance")),
)

# (mov, occ) -> zones a vehicle may be in while in that state
STATE_ZONES = (
    ((1, 1), ("Production", "WIP", "Storage", "Packing")),
    ((0, 1), ("WIP", "Packing", "Storage")),
    ((0, 0), ("Charging", "Maintenance", "Storage")),
    ((1, 0), ("Storage", "Packing", "WIP", "Maintenance")),
)

# --- fixed values: expected state mix -------------------------------------
# state name -> (mov, occ)
STATES = (
    ("active", (1, 1)),
    ("idle", (0, 1)),
    ("available", (0, 0)),
    ("abnormal", (1, 0)),
)
# shift -> weights of active, idle, available, abnormal; offline probability
SHIFT_MIX = (
    ("morning", (0.50, 0.25, 0.20, 0.05), 0.02),
    ("afternoon", (0.40, 0.30, 0.25, 0.05), 0.03),
    ("night", (0.15, 0.15, 0.62, 0.08), 0.06),
)
# level -> what is added to active, idle, available, abnormal; to offline
USAGE_ADJUSTMENT = (
    ("high", (0.10, 0.03, -0.10, 0.03), 0.0),
    ("low", (-0.08, -0.02, 0.08, -0.02), 0.0),
)
RISK_ADJUSTMENT = (
    ("high", (0.0, 0.0, -0.02, 0.03), 0.005),
    ("medium", (0.0, 0.0, 0.0, 0.01), 0.0),
)
# zone -> extra chance that an online vehicle drops out; below zero has no effect
ZONE_OFFLINE_BONUS = (
    ("Charging", Decimal("0.010")),
    ("Maintenance", Decimal("0.015")),
    ("Storage", Decimal("0.003")),
    ("Packing", Decimal("0.002")),
    ("Production", Decimal("-0.003")),
    ("WIP", Decimal("-0.002")),
)

# --- fixed values: sampling ------------------------------------------------
READING_SECONDS = 3
READINGS_PER_DAY = 24 * 60 * 60 // READING_SECONDS

# --- fixed values: published result tables --------------------------------
# result name -> collection name
RESULT_COLLECTIONS = (
    ("category_counts", "analysis_category_counts"),
    ("shift_counts", "analysis_shift_counts"),
    ("zone_counts", "analysis_zone_counts"),
    ("status_counts", "analysis_status_counts"),
    ("avg_rssi_by_zone", "analysis_avg_rssi"),
    ("active_work_by_forklift", "analysis_active_work"),
    ("unauthorized_by_forklift", "analysis_unauthorized"),
    ("spark_sql_zone_shift_summary", "analysis_zone_shift"),
    ("spark_sql_offline_summary", "analysis_offline"),
    ("predict_downtime_by_forklift", "predict_downtime"),
    ("predict_offline_risk", "predict_offline"),
    ("predict_unauthorized_risk", "predict_unauthorized"),
    ("predict_composite_risk_zone_shift", "predict_composite"),
    ("predict_zone_risk", "predict_zone"),
    ("predict_shift_risk", "predict_shift"),
)
