"""Fixed values and parameter sets.

The tables below are fixed values: results depend on them literally.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values: port vocabulary -------------------------------------------------
PORT_CODE_ALLOWLIST = ("RUKGD", "RUBLT", "RUULU", "RUUST")
PORT_NAME_ALIASES = (
    "UST LUGA", "UST-LUGA", "USTLUGA", "ST PETERSBURG", "SAINT PETERSBURG",
    "KALININGRAD", "BALTIYSK", "BALTISK", "PRIMORSK", "VYSOTSK", "VYBORG",
    "MURMANSK", "ARKHANGELSK", "NOVOROSSIYSK", "NOVOROSSIISK", "TUAPSE",
    "TAMAN", "KAVKAZ", "ROSTOV", "ROSTOV ON DON", "AZOV", "TAGANROG",
    "MAKHACHKALA", "VLADIVOSTOK", "NAKHODKA", "KOZMINO", "VANINO",
    "DE KASTRI", "KORSAKOV", "SEVASTOPOL", "KERCH", "FEODOSIA",
)
PORT_CODE_DENYLIST = ("PLGDN", "PLGDY")
PORT_NAME_DENYLIST = ("GDANSK", "GDYNIA")

# --- fixed values: tanker context zones (id, label, min_lat, max_lat, min_lon, max_lon)
TANKER_ZONES = (
    ("kaliningrad_baltiysk_approaches", "Kaliningrad / Baltiysk approaches", 54.15, 56.20, 18.20, 22.90),
    ("gulf_of_gdansk", "Gulf of Gdansk", 53.95, 55.85, 17.35, 20.80),
    ("gulf_of_finland_ru_approaches", "Gulf of Finland / Ust-Luga-Primorsk approaches", 58.40, 60.85, 23.40, 30.70),
    ("danish_straits_kattegat", "Danish Straits / Kattegat", 54.30, 58.50, 8.00, 13.10),
    ("skagen_waiting_area", "Skagen / northern Kattegat", 56.80, 58.50, 8.10, 12.30),
    ("german_bight", "German Bight", 53.00, 56.25, 4.70, 9.40),
    ("dover_channel_gateway", "Dover Strait / Channel gateway", 50.70, 51.75, -0.60, 2.30),
    ("gibraltar_west_med_gateway", "Gibraltar / W. Mediterranean gateway", 35.10, 37.30, -6.20, -2.50),
)

# --- fixed values: gateway boxes (min_lat, max_lat, min_lon, max_lon)
GATEWAY_BOXES = (
    (48.0, 61.8, -13.5, 10.8),
    (53.0, 66.5, 8.0, 31.8),
    (35.0, 38.8, -6.5, 16.5),
    (41.0, 47.5, 26.0, 42.5),
)

# --- fixed values: MMSI country prefix to flag state
MID_FLAGS = {
    "306": "Curacao", "307": "Aruba", "312": "Belize", "314": "Barbados",
    "341": "Saint Kitts and Nevis",
    "351": "Panama", "352": "Panama", "353": "Panama", "354": "Panama",
    "355": "Panama", "356": "Panama", "357": "Panama",
    "370": "Panama", "371": "Panama", "372": "Panama", "373": "Panama",
    "511": "Palau", "518": "Cook Islands", "538": "Marshall Islands", "570": "Tonga",
    "607": "Gambia", "613": "Cameroon", "616": "Comoros", "621": "Djibouti",
    "626": "Gabon", "632": "Guinea", "636": "Liberia", "647": "Madagascar",
    "650": "Malawi", "660": "Mali", "667": "Sierra Leone",
    "668": "Sao Tome and Principe", "669": "Eswatini", "671": "Togo",
    "676": "Democratic Republic of the Congo", "677": "Tanzania",
    "679": "Zimbabwe", "750": "Guyana",
}
HARD_REGISTRY_STATUSES = ("no_intl_registry", "fraudulent_registry", "fraud_notice", "false_flag_confirmed")
CONTEXT_REGISTRY_STATUSES = ("open_registry_psc_grey", "open_registry_watch", "psc_context")
FLAG_RISK_SCORES = {"A": 90, "B": 70, "C": 45}
FLAG_RISK_DEFAULT_SCORE = 50

# --- fixed values: categories, rank (map generator) and viewer order
CATEGORY_RANK = {
    "sanctions_shadowfleet": 100,
    "false_flag_watch": 90,
    "russian_mmsi": 80,
    "behavioral_voi": 75,
    "recent_russian_portcall_10d": 70,
    "falseflag_interest": 65,
    "watchlist": 60,
    "neutral_tanker_context": 15,
}
VIEWER_CATEGORY_ORDER = (
    "falseflag_interest", "false_flag_watch", "sanctions_shadowfleet", "watchlist",
    "russian_mmsi", "recent_russian_portcall_10d", "behavioral_voi", "neutral_tanker_context",
)
KNOWN_CATEGORIES = (
    "watchlist", "sanctions_shadowfleet", "russian_mmsi", "falseflag_interest",
    "false_flag_watch", "behavioral_voi", "recent_russian_portcall_10d",
)
DISPLAY_VOI_CATEGORIES = KNOWN_CATEGORIES + ("shadowfleet",)
PRIORITY_FLAGS = ("sanctioned", "shadow_fleet", "false_flag", "false_flag_candidate",
                  "behavioral_voi", "from_russia_confirmed")
TRACK_CONTEXT_CATEGORIES = ("watchlist", "sanctions_shadowfleet", "falseflag_interest",
                            "russian_mmsi", "recent_russian_portcall_10d")

# --- fixed values: wording tests
TANKER_PATTERN = (r"\b(TANKER|OIL\s*TANKER|PRODUCT\s*TANKER|CHEMICAL\s*TANKER|CRUDE\s*TANKER"
                  r"|LNG\s*CARRIER|LPG\s*CARRIER|VLCC|SUEZMAX|AFRAMAX)\b")
FOR_ORDER_PATTERN = (r"\b(FOR\s*ORDER|TO\s*BE\s*ORDERED|BALTIC\s+FOR\s+ORDER"
                     r"|BALTIC\s+SEA\s+FOR\s+ORDER)\b")
UNKNOWN_WORDS = ("UNKNOWN", "UNKNOWN VALUE", "N/A", "NA", "NULL", "NONE", "0")
TRUE_WORDS = ("1", "true", "yes", "y", "on")
FALSE_WORDS = ("0", "false", "no", "n")
TEST_WORDS = ("test_only", "example", "dummy", "sample")
SCORED_FIELDS = ("imo", "callsign", "name", "ship_type_label", "cargo_type", "width_m", "length_m",
                 "draught_m", "destination", "eta_raw", "navigational_status", "sog", "cog", "true_heading")
PROPERTY_HINTS = (
    "name", "title", "label", "status", "state", "type", "category", "class",
    "operator", "owner", "country", "nation", "code", "identifier", "id",
    "source", "provider", "url", "link", "year", "date", "capacity", "voltage",
    "product", "diameter", "length", "route", "project", "site", "location",
)
NAME_KEYS = ("name", "Name", "NAME", "title", "Title", "code", "Code", "id")
MATCH_STATES = ("MATCHED", "POSSIBLE_MATCH", "AMBIGUOUS", "UNMATCHED_IN_AVAILABLE_AIS", "NO_AIS_COVERAGE")

# --- fixed values: earth radii
EARTH_RADIUS_NM = 3440.065
EARTH_RADIUS_M = 6371008.8

# --- fixed values: the daily archive's columns, in file order
ARCHIVE_COLUMNS = (
    "timestamp", "type_of_mobile", "mmsi", "latitude", "longitude", "navigational_status", "rot",
    "sog", "cog", "heading", "imo", "callsign", "name", "ship_type", "cargo_type", "width", "length",
    "position_fixing_device", "draught", "destination", "eta", "data_source_type",
    "size_a", "size_b", "size_c", "size_d",
)
VESSEL_MOBILE_TYPES = ("class a", "class b")


# --- fixed values: thresholds, weights and limits of each rule ---------------------
@dataclass(frozen=True)
class ProviderTtl:
    """Soft and hard time to live per provider, in hours."""

    soft: dict = field(default_factory=lambda: {"aisstream": 40.0, "fintraffic": 30.0, "barentswatch": 30.0})
    hard: dict = field(default_factory=lambda: {"aisstream": 96.0, "fintraffic": 72.0, "barentswatch": 72.0})


@dataclass(frozen=True)
class SnapshotParams:
    """Common-watermark snapshot."""

    mandatory: tuple = ("global_fishing_watch", "ais_dk_historical", "fintraffic", "barentswatch")
    slow_source: str = "global_fishing_watch"
    max_age_hours: dict = field(default_factory=lambda: {
        "global_fishing_watch": 24.0, "ais_dk_historical": 24.0, "fintraffic": 16.0, "barentswatch": 16.0})
    future_tolerance_hours: dict = field(default_factory=lambda: {
        "global_fishing_watch": 0.0, "ais_dk_historical": 24.0, "fintraffic": 0.0, "barentswatch": 0.0})
    default_max_age_hours: float = 12.0
    provider_rank: dict = field(default_factory=lambda: {
        "barentswatch": 1, "fintraffic": 2, "ais_dk_historical": 3, "global_fishing_watch": 4})
    default_rank: int = 99
    retention_days: int = 21
    max_bytes: int = 23068672
    expected_refresh_hours: float = 30.0
    hard_stale_hours: float = 72.0


@dataclass(frozen=True)
class HistoryPolicy:
    retention_days: int = 14
    future_tolerance_hours: int = 24
    source_max_bytes: int = 47185920
    shard_max_bytes: int = 20971520
    public_max_bytes: int = 23068672


@dataclass(frozen=True)
class ProximityParams:
    immediate_nm: float = 0.25
    close_nm: float = 0.75
    contextual_nm: float = 2.0
    low_speed_knots: float = 3.0
    minimum_dwell_minutes: float = 30.0
    minimum_near_points: int = 2
    repeated_entries: int = 2
    maximum_gap_minutes: float = 180.0
    window_hours: int = 120
    max_events_per_vessel: int | None = None
    # Work is split by time chunk so one busy track never lands in a single task.
    chunk_seconds: int = 86400
    cell_degrees: float = 0.1


@dataclass(frozen=True)
class CfarProfile:
    id: str
    training: int
    guard: int
    probability: float


@dataclass(frozen=True)
class CfarParams:
    profiles: tuple = (
        CfarProfile("strict_wide", 17, 4, 1e-7),
        CfarProfile("balanced", 15, 3, 1e-6),
        CfarProfile("exploratory_local", 11, 2, 1e-5),
    )
    vh_profile: CfarProfile = CfarProfile("vh_corroboration_only", 15, 3, 1e-5)
    minimum_fraction: float = 0.8
    link_radius: int = 1
    max_seeds: int | None = None
    max_candidates: int | None = None


@dataclass(frozen=True)
class MatchParams:
    window_minutes: int = 30
    unknown_speed_knots: float = 40.0
    maximum_sog_knots: float = 102.1
    per_side: int = 4
    high_gap_seconds: int = 300
    medium_gap_seconds: int = 900
    local_padding_nm: float = 10.0
    bin_minutes: int = 10
    minimum_bins: int = 5
    minimum_mmsi: int = 3
    minimum_messages: int = 30
    minimum_radius_m: float = 500.0
    maximum_distance_m: float = 2000.0
    movement_fraction: float = 0.1
    movement_cap_m: float = 750.0
    single_sided_penalty_m: float = 250.0
    no_motion_penalty_m: float = 500.0
    extent_cap_m: float = 100.0
    evidence_limit: int | None = None
    cell_degrees: float = 0.05


@dataclass(frozen=True)
class ReviewParams:
    minimum_length_fraction: float = 0.5
    maximum_length_fraction: float = 1.25
    maximum_alignment_degrees: float = 15.0
    maximum_representative_m: float = 50.0
    high_profiles: int = 3
    medium_profiles: int = 2
    high_gap_seconds: int = 60
    hard_maximum_m: float = 2000.0
    minimum_size_ratio: float = 0.5
    maximum_size_ratio: float = 2.0


@dataclass(frozen=True)
class TankerCap:
    per_zone: int | None = None
    total: int | None = None
    slow_knots: float = 3.0
