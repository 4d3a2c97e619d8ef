"""Fixed domain values: index parameters, class boundaries, rule limits.

These numbers must equal the published standard the index and the rule
set are defined on; they are stated once here, in natural order, and every
operator (and every oracle query) is generated from them.  Small fixed
dimensions (13 parameters, 5 classes, 15 rules) are safe to broadcast:
their size does not grow with the data.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# FIXED VALUES: index parameters (code, canonical column, standard limit S,
# ideal value V0, unit), in the order the index sums them.
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class IndexParameter:
    code: str
    column: str
    limit: float      # S_i, the permissible limit
    ideal: float      # V_0, the ideal value
    unit: str
    full_name: str    # long header used by raw feeds


INDEX_PARAMETERS: tuple[IndexParameter, ...] = (
    IndexParameter("pH", "ph", 8.5, 7.0, "pH scale", "Potential of Hydrogen (pH)"),
    IndexParameter("DO", "do_mgl", 5.0, 14.6, "mg/L", "Dissolved oxygen (mg/L)"),
    IndexParameter("BOD", "bod_mgl", 3.0, 0.0, "mg/L", "Biochemical Oxygen Demand (mg/L)"),
    IndexParameter("COD", "cod_mgl", 10.0, 0.0, "mg/L", "Chemical Oxygen Demand (mg/L)"),
    IndexParameter("EC", "ec", 750.0, 0.0, "uS/cm", "Electric Conductivity (uS/cm)"),
    IndexParameter("TDS", "tds", 500.0, 0.0, "mg/L", "Total Dissolved Solids (mg/L)"),
    IndexParameter("Turbidity", "turbidity", 5.0, 0.0, "NTU", "Turbidity (NTU)"),
    IndexParameter("TC", "tc", 500.0, 0.0, "MPN/100mL", "Total Coliform (MPN/100mL)"),
    IndexParameter("FC", "fc", 250.0, 0.0, "MPN/100mL", "Fecal Coliform (MPN/100mL)"),
    IndexParameter("Nitrate", "nitrate_n", 45.0, 0.0, "mgN/L", "Nitrate N (mgN/L)"),
    IndexParameter("Hardness", "hardness", 200.0, 0.0, "mgCaCO3/L", "Total Hardness (mgCaCO3/L)"),
    IndexParameter("Chloride", "chloride", 250.0, 0.0, "mg/L", "Chloride (mg/L)"),
    IndexParameter("Sulfate", "sulfate", 200.0, 0.0, "mg/L", "Sulphate (mg/L)"),
)

PARAMETER_BY_CODE = {p.code: p for p in INDEX_PARAMETERS}
PARAMETER_BY_COLUMN = {p.column: p for p in INDEX_PARAMETERS}

# FIXED VALUES: special sub-index rules.  pH rates distance from 7.0 with a
# span of 1.5 above and 0.5 below; DO rates distance from 14.6 over 9.6.
PH_NEUTRAL = 7.0
PH_SPAN_ABOVE = 1.5
PH_SPAN_BELOW = 0.5
DO_SATURATION = 14.6
DO_SPAN = 9.6

# Records with fewer usable parameters than this are quarantined.
MIN_PARAMETERS = 3

# ---------------------------------------------------------------------------
# FIXED VALUES: classes.  Upper edge inclusive; the first class also takes
# 0 and any negative score.  Scores above the last edge are Unsuitable.
# (label, upper edge, category, range text, potable flag, order)
# ---------------------------------------------------------------------------
CLASSES: tuple[tuple[str, float | None, str, str, int], ...] = (
    ("Excellent", 25.0, "Class A", "0 - 25", 1),
    ("Good", 50.0, "Class B", "26 - 50", 1),
    ("Poor", 75.0, "Class C", "51 - 75", 0),
    ("Very Poor", 100.0, "Class D", "76 - 100", 0),
    ("Unsuitable", None, "Class E", "> 100", 0),
)
CLASS_ORDER: tuple[str, ...] = tuple(c[0] for c in CLASSES)
POOR_CLASSES: tuple[str, ...] = ("Poor", "Very Poor", "Unsuitable")
POTABLE_MAX_SCORE = 50.0
SEVERE_IMBALANCE_PCT = 90.0

# ---------------------------------------------------------------------------
# FIXED VALUES: threshold rules, one row per (parameter, rule kind).
# (parameter code, canonical column, kind, direction, limit, critical,
#  base priority, critical priority, unit)
# direction "below": value < limit is abnormal, value < critical is critical.
# direction "above": value > limit is abnormal, value > critical is critical.
# A missing critical defaults to twice the limit for "above" rules; the DO
# supersaturation rule has no critical level and always uses its base.
# ---------------------------------------------------------------------------
RULES: tuple[tuple, ...] = (
    ("pH", "ph", "low", "below", 6.5, 4.0, "Medium", "High", "pH scale"),
    ("pH", "ph", "high", "above", 8.5, 9.5, "Medium", "High", "pH scale"),
    ("DO", "do_mgl", "low", "below", 5.0, 4.0, "Medium", "High", "mg/L"),
    ("DO", "do_mgl", "supersaturated", "above", 14.6, None, "Low", "Low", "mg/L"),
    ("BOD", "bod_mgl", "high", "above", 3.0, 6.0, "Medium", "High", "mg/L"),
    ("FC", "fc", "high", "above", 250.0, 2500.0, "High", "High", "MPN/100mL"),
    ("Log10_FC", "log10_fc", "high", "above", 2.398, 3.398, "High", "High", "log10 MPN/100mL"),
    ("Turbidity", "turbidity", "high", "above", 5.0, 10.0, "Low", "Medium", "NTU"),
    ("EC", "ec", "high", "above", 750.0, 2250.0, "Low", "Medium", "uS/cm"),
    ("TDS", "tds", "high", "above", 500.0, 2000.0, "Low", "Medium", "mg/L"),
    ("COD", "cod_mgl", "high", "above", 10.0, 25.0, "Medium", "High", "mg/L"),
    ("TC", "tc", "high", "above", 500.0, 5000.0, "Medium", "High", "MPN/100mL"),
    ("Nitrate", "nitrate_n", "high", "above", 10.0, 20.0, "High", "High", "mg/L"),
    ("Ammonia", "ammonia_n", "high", "above", 1.2, 5.0, "Medium", "High", "mg/L"),
    ("Temperature", "temperature", "high", "above", 32.0, 40.0, "Low", "Medium", "degC"),
)
RULE_COLUMNS = ("parameter", "column", "kind", "direction", "limit", "critical",
                "base_priority", "critical_priority", "unit")
PRIORITY_ORDER: tuple[str, ...] = ("High", "Medium", "Low")

# FIXED VALUES: names of each parameter in raw files and submissions, besides its
# code, its column and its long header (all matched trimmed, in any case).
# Unknown names pass through unchanged.
OTHER_NAMES: dict[str, tuple[str, ...]] = {
    "pH": ("potential of hydrogen",),
    "DO": ("dissolved oxygen", "dissolved_oxygen"),
    "BOD": ("biochemical oxygen demand",),
    "FC": ("fecal coliform", "faecal coliform", "faecal coliform (mpn/100ml)", "fecal_coliform"),
    "Log10_FC": ("log10_fc", "log_fc", "log10 fecal coliform", "log10_fecal_coliform"),
    "Turbidity": (),
    "EC": ("conductivity", "electrical conductivity", "electric conductivity (μs/cm)"),
    "TDS": ("solids", "total dissolved solids"),
    "COD": ("chemical oxygen demand",),
    "TC": ("total coliform",),
    "Nitrate": ("nitrate n", "nitrate (mg/l)"),
    "Ammonia": ("ammonia_n", "ammonia n", "ammonia n (mg/l)", "amonia n (mgn/l)"),
    "Temperature": ("temp", "temperature (ºc)", "temperature (°c)", "temperature (degc)"),
}
ALIASES: dict[str, str] = {
    **{name.lower(): p.code for p in INDEX_PARAMETERS for name in (p.code, p.column, p.full_name)},
    **{name: code for code, names in OTHER_NAMES.items() for name in (code.lower(), *names)},
}
# canonical column of each code
CODE_COLUMNS: dict[str, str] = {**{p.code: p.column for p in INDEX_PARAMETERS},
                                "Log10_FC": "log10_fc", "Ammonia": "ammonia_n", "Temperature": "temperature"}

# FIXED VALUES: the standard each rule parameter's limits come from.
STANDARD_SOURCES: dict[str, str] = {
    "pH": "CPCB Class A/B/C Criteria / BIS IS 10500:2012",
    "DO": "CPCB Class B (Bathing) / Class C (Drinking Source)",
    "BOD": "CPCB Class B Water Quality Criteria (2008 & 2017)",
    "FC": "CPCB Guidelines for Water Quality Management (2017)",
    "Log10_FC": "Derived from CPCB FC <= 250 MPN/100mL via monotonic log10 transformation (M4.1)",
    "Turbidity": "BIS IS 10500:2012 Table 1, Item 3",
    "EC": "CPCB Guidelines (2008) Class B",
    "TDS": "BIS IS 10500:2012 Table 1, Item 4",
    "COD": "CPCB Guidelines (2008) / WHO Guidelines (2011)",
    "TC": "CPCB Class B Bathing Standard (<= 500 MPN/100mL)",
    "Nitrate": "BIS IS 10500:2012 Table 2, Item 6 (45 mg/L as NO3-)",
    "Ammonia": "CPCB Class C Criteria (1.2 mg/L free ammonia) / BIS IS 10500:2012",
    "Temperature": "CPCB Environmental Standards for Thermal Discharge",
}

# ---------------------------------------------------------------------------
# FIXED VALUES: bounds.
# Physical plausibility for cleaning (inclusive): pH 0-14, DO 0-30,
# BOD 0-500, FC 0-1e8.  Scoring-input gate: the same except BOD 0-200.
# ---------------------------------------------------------------------------
MODEL_FEATURES: tuple[str, ...] = ("ph", "do_mgl", "bod_mgl", "fc")
ENGINEERED_FEATURE = "log10_fc"
CLEANING_BOUNDS: dict[str, tuple[float, float]] = {
    "ph": (0.0, 14.0), "do_mgl": (0.0, 30.0), "bod_mgl": (0.0, 500.0), "fc": (0.0, 1e8),
}
INPUT_BOUNDS: dict[str, tuple[float, float]] = {
    "ph": (0.0, 14.0), "do_mgl": (0.0, 30.0), "bod_mgl": (0.0, 200.0), "fc": (0.0, 1e8),
}

# Uncertain prediction: top class probability below this.
UNCERTAIN_BELOW = 0.60
# Dead band for the sign of an attribution.
DIRECTION_EPS = 1e-7
