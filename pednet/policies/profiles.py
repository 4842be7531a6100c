"""Accessibility profiles as data: what grades.py compiles into columns.

The numbers, tag values and names here are fixed values: grades must come out equal to those of the policy that users have today.
A factor is (field, weight, unknown grade, how). Bands are (upper limit, grade) in order; None is the open last one.
"""

from __future__ import annotations

from dataclasses import dataclass, field

CROSSING = ("crossing",)


@dataclass(frozen=True)
class Factor:
    field: str
    weight: float
    unknown: float
    values: dict[str, float] | None = None
    bands: tuple | None = None
    ascending: tuple | None = None
    descending: tuple | None = None
    absolute: bool = False
    aggregation: str = "minimum"
    applies_to: tuple[str, ...] = ()


@dataclass(frozen=True)
class Condition:
    """A test of a field: equals, in, contains, lt, lte, gt, gte, abs_gt, range, abs_range, negative_range or transition_pair."""

    field: str
    operator: str
    value: object = None
    reason: str = ""
    applies_to: tuple[str, ...] = ()
    most: float | None = None
    low: float | None = None
    high: float | None = None


@dataclass(frozen=True)
class Profile:
    name: str
    speed_kmh: float
    factors: dict[str, Factor] = field(default_factory=dict)
    barriers: tuple[Condition, ...] = ()
    caps: tuple[Condition, ...] = ()
    multipliers: tuple[tuple[float, float], ...] = ()
    penalties: dict[str, float | None] = field(default_factory=dict)
    mode: str = "accessibility_grade"


_RESTRICTED = (
    Condition("access", "in", ("no", "private"), "access_restricted"),
    Condition("foot", "in", ("no", "private"), "foot_access_restricted"),
)
_IMPASSABLE = Condition("smoothness", "equals", "impassable", "impassable_surface")

DISTANCE = Profile("distance", 5.0, mode="distance")

WHEELCHAIR = Profile(
    "wheelchair",
    3.5,
    {
        "surface": Factor("surface", 3.0, 35, {
            "asphalt": 100, "concrete": 100, "metal": 75, "paving_stones": 82, "paver": 82, "concrete:plates": 72, "ceramic:tiles": 70,
            "compacted": 60, "fine_gravel": 45, "sett": 35, "cobblestone": 30, "unhewn_cobblestone": 20, "gravel": 25, "wood": 45,
            "ground": 25, "earth": 20, "dirt": 20, "grass": 15, "sand": 5, "unpaved": 20, "paved": 65,
        }),
        "smoothness": Factor("smoothness", 5.0, 35, {"excellent": 100, "good": 90, "intermediate": 70, "bad": 45, "very_bad": 30, "horrible": 15, "very_horrible": 5, "impassable": 0}),
        "width": Factor("width_m", 5.0, 35, bands=((0.60, 0), (0.90, 20), (1.20, 60), (1.50, 85), (None, 100))),
        "incline": Factor("incline_percent", 5.0, 40, ascending=((2.0, 100), (5.0, 82), (8.33, 52), (12.5, 20), (None, 0)), descending=((2.0, 100), (5.0, 88), (8.33, 62), (12.5, 30), (None, 0))),
        "cross_slope": Factor("cross_slope_percent", 4.0, 40, bands=((2.0, 100), (3.0, 70), (5.0, 35), (None, 5)), absolute=True),
        "wheelchair_tag": Factor("wheelchair", 2.0, 50, {"yes": 100, "designated": 100, "limited": 60, "no": 0}),
        "crossing": Factor("crossing", 3.0, 45, {"traffic_signals": 90, "zebra": 85, "marked": 80, "uncontrolled": 60, "unmarked": 30, "no": 0}, applies_to=CROSSING),
        "kerb": Factor("associated_kerbs", 5.0, 30, {"flush": 100, "lowered": 95, "no": 75, "rolled": 35, "yes": 20, "raised": 0}, applies_to=CROSSING),
        "tactile_paving": Factor("associated_tactile_paving", 1.0, 50, {"yes": 100, "contrasted": 100, "no": 45}, applies_to=CROSSING),
    },
    (Condition("highway", "equals", "steps", "steps"), _IMPASSABLE, Condition("wheelchair", "equals", "no", "wheelchair_no"), *_RESTRICTED),
    (Condition("associated_kerbs", "contains", "raised", "raised_kerb", CROSSING, most=15),),
    ((90, 1.00), (75, 1.20), (60, 1.60), (40, 2.50), (20, 5.00), (1, 10.00)),
    {"sidewalk": 0, "footway": 0, "crossing": 15, "stairs": None},
)

BLIND = Profile(
    "blind",
    4.0,
    {
        "surface": Factor("surface", 2.0, 45, {
            "asphalt": 95, "concrete": 100, "paving_stones": 80, "concrete:plates": 75, "ceramic:tiles": 65, "compacted": 65, "sett": 55,
            "cobblestone": 50, "unhewn_cobblestone": 35, "fine_gravel": 45, "gravel": 35, "wood": 55, "ground": 40, "earth": 35, "dirt": 35,
            "grass": 30, "sand": 20, "unpaved": 35, "paved": 70,
        }),
        "smoothness": Factor("smoothness", 3.0, 45, {"excellent": 100, "good": 92, "intermediate": 75, "bad": 55, "very_bad": 40, "horrible": 25, "very_horrible": 10, "impassable": 0}),
        "width": Factor("width_m", 1.5, 50, bands=((0.60, 20), (0.90, 45), (1.20, 75), (None, 100))),
        "incline": Factor("incline_percent", 1.0, 50, ascending=((5.0, 100), (8.33, 80), (12.5, 55), (None, 25)), descending=((5.0, 100), (8.33, 75), (12.5, 45), (None, 20))),
        "tactile_paving": Factor("associated_tactile_paving", 6.0, 15, {"yes": 100, "contrasted": 100, "no": 0}, applies_to=CROSSING),
        "kerb_detectability": Factor("associated_kerbs", 4.0, 30, {"raised": 65, "yes": 65, "rolled": 55, "lowered": 50, "flush": 25, "no": 20}, applies_to=CROSSING),
        "crossing": Factor("crossing", 6.0, 30, {"traffic_signals": 90, "zebra": 78, "marked": 72, "uncontrolled": 45, "unmarked": 20, "no": 0}, applies_to=CROSSING),
        "lighting": Factor("lit", 2.0, 50, {"yes": 100, "automatic": 100, "24/7": 100, "no": 35, "disused": 25}),
    },
    (_IMPASSABLE, *_RESTRICTED),
    (Condition("highway", "equals", "steps", "steps", most=40), Condition("associated_kerbs", "contains", "raised", "raised_crossing_kerb", CROSSING, most=35)),
    ((90, 1.00), (75, 1.15), (60, 1.45), (40, 2.20), (20, 4.50), (1, 8.00)),
    {"sidewalk": 0, "footway": 0, "crossing": 25, "stairs": 10},
)

ELDERLY = Profile(
    "elderly",
    3.2,
    {
        "surface": Factor("surface", 4.0, 40, {
            "asphalt": 100, "concrete": 100, "metal": 65, "paving_stones": 82, "paver": 82, "concrete:plates": 72, "ceramic:tiles": 65,
            "compacted": 65, "fine_gravel": 45, "sett": 40, "cobblestone": 35, "unhewn_cobblestone": 20, "gravel": 30, "wood": 45,
            "ground": 30, "earth": 25, "dirt": 25, "grass": 20, "sand": 10, "unpaved": 25, "paved": 65,
        }),
        "smoothness": Factor("smoothness", 5.0, 40, {"excellent": 100, "good": 92, "intermediate": 70, "bad": 42, "very_bad": 25, "horrible": 12, "very_horrible": 5, "impassable": 0}),
        "width": Factor("width_m", 3.0, 40, bands=((0.60, 5), (0.90, 30), (1.20, 65), (1.50, 85), (None, 100))),
        "incline": Factor("incline_percent", 5.0, 40, ascending=((2.0, 100), (5.0, 78), (8.33, 45), (12.5, 15), (None, 0)), descending=((2.0, 100), (5.0, 82), (8.33, 52), (12.5, 20), (None, 0))),
        "cross_slope": Factor("cross_slope_percent", 3.0, 45, bands=((2.0, 100), (3.0, 75), (5.0, 40), (None, 10)), absolute=True),
        "crossing": Factor("crossing", 5.0, 35, {"traffic_signals": 95, "zebra": 82, "marked": 78, "uncontrolled": 48, "unmarked": 22, "no": 0}, applies_to=CROSSING),
        "kerb": Factor("associated_kerbs", 4.0, 35, {"flush": 100, "lowered": 92, "no": 75, "rolled": 42, "yes": 25, "raised": 5}, applies_to=CROSSING),
        "lighting": Factor("lit", 1.5, 50, {"yes": 100, "automatic": 100, "24/7": 100, "no": 40, "disused": 25}),
    },
    (_IMPASSABLE, *_RESTRICTED),
    (Condition("highway", "equals", "steps", "steps", most=12), Condition("associated_kerbs", "contains", "raised", "raised_kerb", CROSSING, most=15)),
    ((90, 1.00), (75, 1.20), (60, 1.65), (40, 2.60), (20, 5.50), (1, 11.00)),
    {"sidewalk": 0, "footway": 0, "crossing": 22, "stairs": 45},
)

PROFILES = (DISTANCE, WHEELCHAIR, BLIND, ELDERLY)
