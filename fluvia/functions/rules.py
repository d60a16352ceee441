"""Labels and priorities of sites."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fluvia.functions.spectral import clip

#: Hazard weights by class, exposure weights and saturations, thresholds of the urgency rules.
HAZARD_WEIGHTS = {
    "Bank erosion (land to water)": 1.0,
    "Very high": 0.9,
    "Likely bank erosion (AI prediction)": 0.8,
    "Vegetation loss": 0.6,
    "New bare soil": 0.6,
    "High": 0.5,
    "Char or sandbar lost": 0.4,
    "Accretion (water to land)": 0.3,
}
EXPOSURE = {"population": (0.35, 2000.0), "built_ha": (0.15, 10.0), "crop_ha": (0.15, 40.0), "road_km": (0.1, 3.0), "embankment_km": (0.1, 1.0), "facilities": (0.15, 2.0)}
PEOPLE_HIGH, RETREAT_FAST, EXPOSURE_HIGH, STEEP = 500, 50, 0.4, 8
QUOTAS = {"change": 30, "ai": 15, "risk": 5}


def number(x: Column) -> Column:
    """NULL, NaN, infinity and text count as 0."""
    v = x.try_cast("double")
    return F.coalesce(F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v), F.lit(0.0))


def hazard_weight(cls: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in HAZARD_WEIGHTS.items() for x in kv])[cls]


def evidence(source: Column, confidence: Column, probability: Column, skill: Column | float = 1.0) -> Column:
    """A change's confidence, a prediction's probability (up to one half) times the model's skill; 1 where there is none."""
    skill = skill if isinstance(skill, Column) else F.lit(skill)
    scaled = clip(probability / 0.5, 0.0, 1.0) * F.coalesce(skill, F.lit(0.0))
    return F.coalesce(F.when(source == "change", confidence).when(source == "ai", scaled), F.lit(1.0))


def hazard(cls: Column, area_ha: Column, weight_of_evidence: Column) -> Column:
    return hazard_weight(cls) * F.log1p(area_ha) * weight_of_evidence


def exposure_index(columns: dict[str, Column], available: set[str] | None = None) -> Column:
    """Weighted share of saturation over the layers that there are."""
    names = [k for k in EXPOSURE if k in columns and (available is None or k in available)]
    total = sum(EXPOSURE[k][0] for k in names)
    if not names:
        return F.lit(None).cast("double")
    parts = [EXPOSURE[k][0] * clip(F.coalesce(columns[k], F.lit(0.0)) / EXPOSURE[k][1], 0.0, 1.0) for k in names]
    out = parts[0]
    for p in parts[1:]:
        out = out + p
    return out / total


def priority(hazard_score: Column, exposure: Column, floor: float = 0.3, layers: bool = True) -> Column:
    """Hazard scaled by exposure; without any exposure layer the hazard itself."""
    return hazard_score * (floor + (1 - floor) * F.coalesce(exposure, F.lit(0.0))) if layers else hazard_score


def model_skill(auc: Column) -> Column:
    return clip((auc - 0.5) / 0.4, 0.0, 1.0)


def confidence_label(source: Column, score: Column, agreement: Column, probability: Column) -> Column:
    change = F.when(score.isNull(), "Not assessed").when(score >= 0.9, "High").when(score >= 0.75, "Medium").otherwise("Low")
    ai = F.when((agreement >= 0.9) & (F.coalesce(probability, F.lit(0.0)) >= 0.5), "High").when(agreement >= 0.8, "Medium").otherwise("Low")
    return F.when(source == "change", change).when((source == "ai") & agreement.isNotNull(), ai).when(source == "risk", "Not validated").otherwise("Unknown")


def urgency(cls: Column, people: Column, road: Column, embankment: Column, facilities: Column, retreat: Column, exposure: Column, confidence: Column) -> Column:
    people, road, embankment, facilities, retreat, exposure = (number(x) for x in (people, road, embankment, facilities, retreat, exposure))
    assets = (road > 0.2) | (embankment > 0.1) | (facilities > 0)
    urgent = (people >= PEOPLE_HIGH) | (embankment > 0.1) | (retreat >= RETREAT_FAST)
    bank = F.when(urgent & F.coalesce(confidence.isin("High", "Medium"), F.lit(False)), "Immediate").when(urgent | assets | (exposure >= EXPOSURE_HIGH), "Before monsoon").otherwise("Routine")
    return (
        F.when(cls.startswith("Bank erosion"), bank)
        .when(cls.startswith("Char") | cls.startswith("Accretion"), "Monitor")
        .when(cls.startswith("Likely bank erosion"), F.when((people >= PEOPLE_HIGH) | assets, "Before monsoon").otherwise("Routine"))
        .when(cls.startswith("New inland water") | cls.startswith("Vegetation loss") | cls.startswith("New bare soil") | (cls == "High"), "Routine")
        .when(cls == "Very high", "Before monsoon")
        .otherwise("Monitor")
    )


def lead_agency(cls: Column, urgency_label: Column) -> Column:
    water = "Water Resources Dept"
    return (
        F.when(cls.startswith("Bank erosion") & (urgency_label != "Routine") | cls.startswith("Char"), water)
        .when(cls.startswith("Accretion"), "Revenue / Soil Conservation Dept")
        .when(cls.startswith("New inland water"), "Water Resources / Agriculture Dept")
        .otherwise("Soil Conservation Dept")
    )


#: Recommended measures.
ACTIONS = {
    "bank_urgent": "Inform the Water Resources Department for emergency bank protection (geobags, RCC or bamboo porcupines) before the monsoon, followed by a permanent revetment or spurs. Alert the circle office and the district disaster management authority; prepare relocation if retreat continues.",
    "bank_assets": "Plan bank protection with the Water Resources Department (porcupines or geobags, then revetment). Plant bamboo and vetiver along the bank behind the eroding edge.",
    "bank_low": "Stabilise the bank with vegetation (bamboo, vetiver, native grasses) and keep a setback for new construction. Monitor the bank line each month.",
    "char": "Char or sandbar loss inside the river channel. No structural work; monitor. If the char is inhabited, inform residents and the circle office.",
    "ai": "Predicted by the AI model, not yet observed. Field check before the monsoon; if bank cutting is seen, treat as active bank erosion.",
    "accretion": "New land from river deposition. Monitor; avoid permanent settlement. Grass or tree planting can stabilise older deposits.",
    "inland_water": "New water away from the river: check for waterlogging, drainage congestion or new ponds. Clear or restore drainage where needed.",
    "veg_loss": "Field check the cause (harvest, tea pruning, clearing, earth cutting). If land was cleared on a slope or bank, restore cover with grasses, cover crops or agroforestry.",
    "bare_soil": "Check for earth cutting, brick kilns or construction. Apply mulching or cover crops; control runoff with bunds or silt traps.",
    "risk_steep": "Hillslope erosion risk. Contour trenches and staggered trenches, vegetative barriers, and check dams or gully plugs in drainage lines.",
    "risk_gentle": "Sheet erosion risk. Contour bunds or field bunds, cover crops and mulching; in tea gardens maintain drains and shade trees.",
    "other": "Field check.",
}


def action_key(cls: Column, urgency_label: Column, slope: Column) -> Column:
    """Which of the measures a site gets."""
    starts = [("Char", "char"), ("Likely bank erosion", "ai"), ("Accretion", "accretion"), ("New inland water", "inland_water"), ("Vegetation loss", "veg_loss"), ("New bare soil", "bare_soil")]
    bank = F.when(urgency_label == "Immediate", "bank_urgent").when(urgency_label == "Before monsoon", "bank_assets").otherwise("bank_low")
    out = F.when(cls.startswith("Bank erosion"), bank)
    for prefix, key in starts:
        out = out.when(cls.startswith(prefix), key)
    return out.when(cls.isin("High", "Very high"), F.when(number(slope) >= STEEP, "risk_steep").otherwise("risk_gentle")).otherwise("other")


def recommended_action(cls: Column, urgency_label: Column, slope: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in ACTIONS.items() for x in kv])[action_key(cls, urgency_label, slope)]


#: The answers that confirm a class.
EXPECTED = {"Bank erosion": ["erosion_mainland"], "Char or sandbar lost": ["erosion_char", "erosion_mainland"], "Accretion": ["accretion"], "New inland water": ["new_inland_water"]}


def verdict(site_class: Column, reference_class: Column, erosion_present: Column) -> Column:
    """Confirmed, Not confirmed or Unsure, by the reference class where one is expected and given, else by the plain question."""
    ref, seen = F.lower(F.coalesce(reference_class, F.lit(""))), F.lower(F.coalesce(erosion_present, F.lit("")))
    expected = F.create_map(*[x for k, v in EXPECTED.items() for x in (F.lit(k), F.array(*[F.lit(a) for a in v]))])[site_class]
    plain = F.when(seen == "yes", "Confirmed").when(seen == "no", "Not confirmed").otherwise("Unsure")
    return F.when(expected.isNotNull() & ~ref.isin("", "unsure", "nan"), F.when(F.array_contains(expected, ref), "Confirmed").otherwise("Not confirmed")).otherwise(plain)


def site_id(window_end: Column, rank: Column, prefix: str = "") -> Column:
    return F.concat(F.lit(prefix), F.date_format(window_end, "yyMM"), F.lit("-"), F.format_string("%02d", rank))


def short_class(cls: Column) -> Column:
    return F.substring_index(cls, " (", 1)


def slug(label: Column) -> Column:
    """A class label as a column name."""
    return F.regexp_replace(F.regexp_replace(F.lower(short_class(label)), "[^a-z0-9]+", "_"), "^_|_$", "")


def signed(x: Column) -> Column:
    """Grouped digits with a plus before what is above 0."""
    return F.concat(F.when(x > 0, "+").otherwise(""), indian_grouping(x))


def day_first(day: Column) -> Column:
    return F.date_format(day, "dd-MM-yyyy")


def years_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start) / 365.25


def tile_place(name: Column) -> tuple[Column, Column]:
    """Longitude and latitude in a tile's name, dw_<lon>_<lat>-..., p for the decimal point."""
    part = lambda k: F.replace(F.regexp_extract(name, r"dw_(-?[0-9p]+)_(-?[0-9p]+)-", k), F.lit("p"), F.lit(".")).try_cast("double")
    return part(1), part(2)


def scene_key(index: Column, millis: Column) -> tuple[Column, Column]:
    """Tile (last part of a scene's index, without its T) and day."""
    return F.regexp_replace(F.element_at(F.split(index, "_"), -1), "^T+", ""), F.to_date(F.timestamp_millis(millis))


def cut_text(text: Column, n: int = 254) -> Column:
    return F.substring(text, 1, n)


def indian_grouping(x: Column) -> Column:
    """Digits in groups of three, then of two: 12,34,567."""
    digits = F.abs(x).cast("string")
    return F.concat(F.when(x < 0, "-").otherwise(""), F.regexp_replace(digits, r"(\d)(?=(\d\d)*\d\d\d$)", "$1,"))


def baseline_date(current: Column, baseline_year: int) -> Column:
    """The same day in the baseline year that the current date's year is moved to; 29 February becomes 28."""
    return F.add_months(current, -12 * (F.year(current) - baseline_year))
