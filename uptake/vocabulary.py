"""Labels and codes that results must carry literally."""

# states, in the order of the ladder
GRACE = "Grace Period"
CHURN = "Churn Signal"
LAPSED = "Lapsed"
SHELFWARE = "Shelfware Risk"
STALL = "Onboarding Stall"

# score bands, best first; also the last four states
REALIZED = "Value Realized"
DEVELOPING = "Developing"
AT_RISK = "At Risk"
CRITICAL = "Critical"
BANDS = (REALIZED, DEVELOPING, AT_RISK, CRITICAL)

# feature adoption levels
LEVELS = ("not_enabled", "enabled_idle", "active", "deep")

# platform code -> display label
PLATFORM_LABELS = {
    "hardware_ngfw": "Hardware NGFW",
    "software_ngfw": "Software NGFW",
    "sase": "SASE",
    "cloud_ngfw": "Cloud NGFW",
}

# order of the platform cards
CARD_ORDER = ("sase", "hardware_ngfw", "cloud_ngfw", "software_ngfw")

# platform code -> entitlement unit
PLATFORM_UNITS = {
    "hardware_ngfw": "device_license",
    "software_ngfw": "credits",
    "sase": "seats",
    "cloud_ngfw": "usage_units",
}

# plays: play, owner, trigger type, trigger, kind, anomaly it addresses
PLAYS = (
    ("Activate", "Customer Success", "state", "Shelfware Risk", "at risk", "Shelfware"),
    ("Win back", "Account teams", "state", "Churn Signal, Lapsed", "at risk", "Spike & drop"),
    ("Upsell", "Sales", "flag", "flag_expansion", "upside", "Consistent overage"),
)
NO_PLAY = "— monitor"

# account anomaly labels, most urgent first
ANOMALIES = ("Shelfware", "Spike & drop", "Overage (upsell)", "Single Feature Flag")
NO_ANOMALY = "—"
