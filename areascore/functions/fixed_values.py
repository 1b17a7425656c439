"""They must equal the published ones for results to match."""

# Ordered pattern lists for incident categories, first match wins.
INCIDENT_PATTERNS = {
    "Violent": [
        "%asslt%", "%assault%", "%robbery%", "%kidnap%", "%homicide%", "%murder%", "%rape%",
        "%sexual assault%", "%weapon offense%", "%aggrav asslt%",
    ],
    "Property": [
        "%theft%", "%larceny%", "%larc%", "%burglary%", "%burgl%", "%vandal%", "%damage prop%",
        "%shoplifting%", "%fraud%",
    ],
    "Drug": ["%drug%", "%marijuana%", "%controlled substance%", "%cocaine%", "%narcotic%"],
    "Administrative": [
        "%police inquiry%", "%lost property%", "%found property%", "%recovery, stolen%",
        "%transport%", "%death natural%", "%death unnatural%", "%accidental injury%",
        "%civil case%", "%suicide%", "%overdose%", "%test only%",
    ],
}
DEFAULT_CATEGORY = "Other"
ADMINISTRATIVE = "Administrative"

# Missing-value marks of the feeds.
MARKET_MISSING = "NA"
CENSUS_MISSING = "-666666666"
RATE_MISSING = "."

# State, area-code range and years covered by the census feed.
STATE_CODE = "TN"
STATE_FIPS = "47"
AREA_CODE_RANGE = (37000, 38599)
SCORING_VINTAGE = 2023

# Home-value metrics and the rate series.
VALUE_METRICS = ["ZHVI", "ZORI", "ZHVF"]
RATE_SERIES = "MORTGAGE30US"

# Local zone of the permit feed.
PERMIT_ZONE = "America/Chicago"

# Days re-read before the stored high-water mark, and the first bound per feed.
LOOKBACK = {
    "crime": (30, "2010-01-01T00:00:00"),
    "permits": (7, "2020-01-01T00:00:00"),
    "property": (30, "2000-01-01"),
    "rates": (0, "2000-01-01"),
}

# County code -> (county name, default region).
COUNTIES = {
    "47037": ("Davidson", "Urban Core"),
    "47187": ("Williamson", "Williamson County"),
    "47149": ("Rutherford", "Rutherford County"),
    "47189": ("Wilson", "Wilson County"),
    "47165": ("Sumner", "Sumner County"),
}

# The one county that is split into regions, its regions, and the rest of it.
SPLIT_COUNTY = "47037"
SPLIT_REGIONS = {
    "Urban Core": [
        "37201", "37203", "37204", "37206", "37208", "37210", "37212", "37213", "37219",
        "37228", "37232", "37238", "37240", "37243", "37246",
    ],
    "West Nashville": ["37205", "37209", "37215", "37220", "37221"],
    "North Nashville": ["37072", "37080", "37115", "37189", "37207", "37216", "37218"],
    "Southeast Nashville": ["37013", "37076", "37138", "37211", "37214", "37217"],
}
SPLIT_DEFAULT = "Davidson Other"

# Signal name -> score column of the score table.
SIGNALS = {
    "affordability": "affordability_score",
    "market_speed": "market_speed_score",
    "activity": "activity_score",
    "income": "income_score",
    "poverty": "poverty_score",
    "safety": "safety_score",
    "permits": "permit_score",
}
NEUTRAL_SCORE = 50

# Colour ramp ends (red, green, blue) and opacity.
RAMP_LOW = (214, 39, 40)
RAMP_HIGH = (0, 168, 132)
RAMP_ALPHA = 190

# Completeness badges and freshness icons.
BADGES = {"High": "\U0001F7E2", "Partial": "\U0001F7E1", "Low": "\U0001F534"}
BADGE_DEFAULT = "⚪"
STATUS_ICONS = {"pass": "✅", "warn": "⚠️"}
STATUS_ICON_DEFAULT = "❓"

# Age limits in days per source, (warn, error).
FRESHNESS_LIMITS = {
    "home_values": (35, 40),
    "market": (8, 10),
    "census_zip": (400, 400),
    "census_county": (400, 400),
    "crime": (2, 3),
    "rates": (8, 10),
    "permits": (2, 3),
}
