"""The row conditions shared by the queries.

``flagged_unauthorized`` and ``unauthorized`` differ on purpose: an offline
vehicle that moves unoccupied is flagged, but categorised as signal loss.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetscope import fixed_values as fixed


def visible() -> Column:
    return F.col("visible") == 1


def offline() -> Column:
    return F.col("status") == fixed.OFFLINE


def active() -> Column:
    return F.col("downtime_category") == fixed.ACTIVE


def not_active() -> Column:
    return F.col("downtime_category") != fixed.ACTIVE


def unauthorized() -> Column:
    return F.col("downtime_category") == fixed.UNAUTHORIZED


def flagged_unauthorized() -> Column:
    return (F.col("mov") == 1) & (F.col("occ") == 0)


def offline_but_visible() -> Column:
    return offline() & visible()


def hidden_with_signal() -> Column:
    return (F.col("visible") == 0) & (F.col("rssi") != fixed.RSSI_NO_SIGNAL)
