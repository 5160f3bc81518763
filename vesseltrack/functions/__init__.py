"""Column functions (JVM-side built-ins only; no Python UDFs)."""

from vesseltrack.functions.geo import EARTH_RADIUS_NM, haversine_nm
from vesseltrack.functions.timefn import elapsed_hours, whole_hours, whole_seconds
from vesseltrack.functions.names import normalise_name, valid_mmsi
from vesseltrack.functions.fmt import fmt_float, fmt_int
from vesseltrack.functions.filenames import date_from_filename

__all__ = [
    "EARTH_RADIUS_NM", "haversine_nm", "elapsed_hours", "whole_hours", "whole_seconds",
    "normalise_name", "valid_mmsi", "fmt_float", "fmt_int", "date_from_filename",
]
