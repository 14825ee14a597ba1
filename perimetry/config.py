"""Everything a user may change without touching the jobs: sources, aliases, bounds, priorities."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field


@dataclass(frozen=True)
class SourceSpec:
    """One dataset: its key, the glob its folders (or archives) match, and its display name."""

    key: str
    pattern: str
    name: str


# Dataset keys, folder patterns and display names, in read order.
SOURCES: tuple[SourceSpec, ...] = (
    SourceSpec("historic_geomac", "Historic_Geomac_*", "Historic GeoMAC (2000-2018)"),
    SourceSpec(
        "interagency_history", "InterAgencyFirePerimeterHistory_*", "Interagency Fire Perimeter History"
    ),
    SourceSpec(
        "wfigs_recent", "WFIGS_Interagency_Perimeters_-8845918407708086874*", "WFIGS Recent (2016-2025)"
    ),
    SourceSpec("wfigs_ytd", "WFIGS_Interagency_Perimeters_YearToDate_*", "WFIGS Year to Date"),
    SourceSpec("wfigs_current", "WFIGS_Interagency_Perimeters_Current_*", "WFIGS Current"),
)

# Duplicate priority by display name, lowest wins. It differs from the read order.
PRIORITIES: dict[str, int] = {
    "Interagency Fire Perimeter History": 1,
    "Historic GeoMAC (2000-2018)": 2,
    "WFIGS Recent (2016-2025)": 3,
    "WFIGS Year to Date": 4,
    "WFIGS Current": 5,
}
DEFAULT_PRIORITY = 99

# Source field names accepted for each normalized column, best first.
# Names are compared after `plain_name`, so case variants need no entry of their own.
ALIASES: dict[str, tuple[str, ...]] = {
    "incident_id_raw": (
        "uniquefireidentifier", "unqe_fire_", "uniquefire", "uniquefir",
        "attr_uniquefireidentifier", "attr_unqe_fire_", "unique_fir",
    ),
    "irwin_id_raw": ("irwinid", "irwin_id", "attr_irwinid", "attr_irwin_id"),
    "local_incident_id": ("localincid", "local_num", "attr_local", "localinci"),
    "for_id": ("forid", "attr_forid", "poly_forid"),
    "geo_id": ("geo_id", "geoid"),
    "global_id": ("globalid", "global_id"),
    "incident_name": (
        "incidentname", "incident", "incidentna", "incidentn",
        "attr_incidentname", "poly_incidentname", "poly_incid", "incident_n",
    ),
    "fire_year": ("fire_year", "fireyear", "year"),
    "unit_id": ("unit_id", "unitid", "poo_resp_i", "poo_respon", "attr_unit_id"),
    "state": ("state", "attr_poost", "attr_poo_st", "poostate"),
    "perimeter_date_raw": ("perimeterdatetime", "poly_polygondatetime", "poly_polyg", "date_cur"),
}

# Fields of the year-to-date file that feed the roster, best first.
ROSTER_ALIASES: dict[str, tuple[str, ...]] = {
    "incident_id": ("attr_Uniqu", "attr_Irwin"),
    "fire_name": ("attr_Inc_2", "attr_Inc_1"),
    "fire_start_raw": ("attr_Fir_7",),
    "acres": ("poly_Acres",),
}


@dataclass(frozen=True)
class Settings:
    """Arguments of the jobs. ``max_year=None`` means the year after the current one."""

    sources: Sequence[SourceSpec] = SOURCES
    aliases: Mapping[str, Sequence[str]] = field(default_factory=lambda: dict(ALIASES))
    priorities: Mapping[str, int] = field(default_factory=lambda: dict(PRIORITIES))
    default_priority: int = DEFAULT_PRIORITY
    min_year: int = 1900
    max_year: int | None = None
    required_fields: Sequence[str] = ("incident_name", "fire_year", "geometry")
    max_gap_days: int = 6
    # Round the centroid in the duplicate key to this many decimals; None compares exactly.
    key_decimals: int | None = None
    # "joins" finds every invalid geometry by joins of edges; "in_place" shuffles nothing, but misses interiors
    # cut off by a cycle of touching rings.
    validity: str = "joins"
    # Read NAD83 coordinates as WGS84, which differ by about a metre; else such files are refused.
    nad83_as_wgs84: bool = True
    # Shapefiles are read in pieces of about this size; larger archives are staged first so that they can be.
    split_bytes: int = 128 << 20
