"""Twelve hand-made readings of two vehicles (and an intruder) on two days.

Every value the tests expect of them was worked out by hand. ``rows`` builds a
DataFrame of these or of any other literal readings.
"""

from datetime import datetime

from fleetscope.schema import TELEMETRY

ACTIVE, UNAUTH, LOSS = "active_work", "unauthorized_operation", "signal_loss_or_offline"


def reading(ts, vehicle, anchor, zone, shift, rssi, visible, mov, occ, status, category):
    at = datetime.fromisoformat(ts)
    start = datetime(2026, 4, 1)
    return (
        at, at.date(), (at.date() - start.date()).days + 1,
        vehicle, anchor, zone, shift, rssi, visible, mov, occ, status, category,
    )


READINGS = [
    # offline yet visible, category left unauthorized: composite risk counts it twice
    reading("2026-04-01 06:00:00", "FL_01", "A3", "WIP", "morning", -60, 1, 1, 0, "offline", UNAUTH),
    # hidden, but with a signal
    reading("2026-04-01 05:59:59", "FL_01", "A3", "WIP", "night", -60, 0, 1, 1, "offline", LOSS),
    # offline, moving unoccupied: flagged as unauthorized, not categorised so
    reading("2026-04-01 22:00:00", "FL_01", "A2", "Storage", "night", 0, 0, 1, 0, "offline", LOSS),
    # no category
    reading("2026-04-01 13:59:59", "FL_01", "A2", "Storage", "morning", -70, 1, 0, 0, "online", None),
    # shift, status and vehicle outside their domains
    reading("2026-04-01 14:00:00", "TRK_1", "A4", "Packing", "evening", -70, 1, 1, 1, "unknown", ACTIVE),
    # the same vehicle and second, apart by microseconds only
    reading("2026-04-02 21:59:59.000001", "FL_02", "A1", "Production", "afternoon", -55, 1, 1, 1, "online", ACTIVE),
    reading("2026-04-02 21:59:59.000002", "FL_02", "A1", "Production", "afternoon", -57, 1, 1, 1, "online", ACTIVE),
    # exact copies
    reading("2026-04-02 15:00:00", "FL_02", "A6", "Charging", "afternoon", -65, 1, 0, 0, "online", "parked_or_charging_candidate"),
    reading("2026-04-02 15:00:00", "FL_02", "A6", "Charging", "afternoon", -65, 1, 0, 0, "online", "parked_or_charging_candidate"),
    # signal out of the zone's range, and an anchor of another zone
    reading("2026-04-02 16:00:00", "FL_01", "A7", "WIP", "afternoon", -95, 1, 0, 1, "online", "idle_waiting"),
    # both vehicles tie in unauthorized readings
    reading("2026-04-02 07:00:00", "FL_02", "A3", "WIP", "morning", -60, 1, 1, 0, "online", UNAUTH),
    reading("2026-04-02 08:00:00", "FL_02", "A4", "Packing", "morning", -60, 1, 0, 0, "online", "available"),
]


def rows(spark, readings=READINGS):
    return spark.createDataFrame(readings, TELEMETRY)


def listed(df):
    """Rows in order, as plain tuples."""
    return [tuple(row) for row in df.collect()]


def explained(df, capsys, mode="formatted"):
    """The printed plan of ``df``."""
    capsys.readouterr()
    df.explain(mode)
    return capsys.readouterr().out
