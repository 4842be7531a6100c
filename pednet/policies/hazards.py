"""The hazard policy as data: what hazards.py compiles into columns.

Names, limits, severities and texts are fixed values: assessments must come out equal to those of the policy that users have today.
A rule is (id, category, confidence, condition, effects); an effect is (severity, impact[, traversability]) for a profile.
"""

from __future__ import annotations

from dataclasses import dataclass

from pednet.policies.profiles import CROSSING, Condition

CATEGORIES = ("longitudinal_slope", "cross_slope", "kerb", "tactile_orientation", "surface", "barrier")
PROFILES = ("pedestrian", "wheelchair", "blind", "elderly")
SEVERITIES = {0: "No detected hazard", 1: "Uncomfortable", 2: "Unfavorable", 3: "Dangerous", 4: "Critical"}
TRAVERSABILITY = ("passable", "passable_with_extreme_risk", "impassable")
RISK, BLOCKED = TRAVERSABILITY[1:]


@dataclass(frozen=True)
class Rule:
    id: str
    category: str
    confidence: int
    condition: Condition
    effects: dict[str, tuple]
    applies_to: tuple[str, ...] = ()
    directional: bool = False


def _all(*effects):
    return {p: e for p, e in zip(PROFILES, effects, strict=True) if e}


_IMPASSABLE = (4, "Passage explicitly impassable", BLOCKED)
_SLOPE = "directional_incline_percent"

RULES = (
    Rule("barrier_steps", "barrier", 95, Condition("highway", "equals", "steps"), _all((1, "Additional effort"), (4, "Step-free passage blocked", BLOCKED), (2, "Level change requires care"), (3, "High effort and fall risk"))),
    Rule("barrier_wheelchair_no", "barrier", 95, Condition("wheelchair", "equals", "no"), {"wheelchair": (4, "Wheelchair access explicitly blocked", BLOCKED)}),
    Rule("surface_impassable", "barrier", 95, Condition("smoothness", "equals", "impassable"), _all(_IMPASSABLE, _IMPASSABLE, _IMPASSABLE, _IMPASSABLE)),
    Rule("kerb_raised", "kerb", 90, Condition("associated_kerbs", "contains", "raised"), _all((1, "Abrupt level change"), (4, "Kerb blocks independent passage", BLOCKED), None, (3, "Trip and fall hazard")), CROSSING),
    Rule("kerb_ambiguous_yes", "kerb", 70, Condition("associated_kerbs", "contains", "yes"), {"wheelchair": (3, "Kerb traversability uncertain"), "elderly": (2, "Potential abrupt level change")}, CROSSING),
    Rule("kerb_rolled", "kerb", 85, Condition("associated_kerbs", "contains", "rolled"), {"wheelchair": (2, "Difficult rolling transition"), "blind": (1, "Weakly defined transition"), "elderly": (2, "Unstable transition")}, CROSSING),
    Rule("flush_without_tactile", "tactile_orientation", 95, Condition("associated_transition_states", "transition_pair", ("flush", "no")), {"blind": (4, "Street boundary may be undetectable", RISK), "elderly": (1, "Transition lacks tactile cue")}, CROSSING),
    Rule("lowered_without_tactile", "tactile_orientation", 90, Condition("associated_transition_states", "transition_pair", ("lowered", "no")), {"blind": (3, "Street boundary has weak tactile detection")}, CROSSING),
    Rule("crossing_tactile_no", "tactile_orientation", 90, Condition("associated_tactile_paving", "contains", "no"), {"blind": (3, "No mapped tactile warning at street transition")}, CROSSING),
    Rule("uniform_transition_surface", "tactile_orientation", 45, Condition("uniform_transition_surface", "equals", True), {"blind": (3, "Material transition may be difficult to detect")}, CROSSING),
    Rule("smoothness_very_horrible", "surface", 90, Condition("smoothness", "equals", "very_horrible"), _all((3, "Extreme unevenness"), (4, "Independent rolling may be impossible", BLOCKED), (3, "Severe trip and orientation hazard"), (4, "Extreme fall risk", RISK))),
    Rule("smoothness_horrible", "surface", 90, Condition("smoothness", "equals", "horrible"), _all((2, "Severe unevenness"), (4, "Rolling may be effectively blocked", BLOCKED), (3, "Severe trip hazard"), (3, "High fall risk"))),
    Rule("smoothness_very_bad", "surface", 90, Condition("smoothness", "equals", "very_bad"), _all((2, "Substantial unevenness"), (3, "Very difficult rolling surface"), (2, "Substantial trip hazard"), (3, "High instability"))),
    Rule("smoothness_bad", "surface", 90, Condition("smoothness", "equals", "bad"), _all((1, "Uneven walking surface"), (2, "Difficult rolling surface"), (2, "Trip hazard"), (2, "Instability and fall risk"))),
    Rule("surface_sand", "surface", 55, Condition("surface", "equals", "sand"), _all((2, "Loose surface"), (4, "Wheels may become immobilized", BLOCKED), (2, "Unstable surface"), (3, "High instability"))),
    Rule("surface_grass", "surface", 55, Condition("surface", "equals", "grass"), _all((1, "Variable natural surface"), (3, "High rolling resistance"), (1, "Variable surface"), (2, "Unstable footing"))),
    Rule("surface_ground_earth_dirt", "surface", 55, Condition("surface", "in", ("ground", "earth", "dirt", "unpaved")), _all((1, "Weather-sensitive surface"), (3, "High or variable rolling resistance"), (1, "Irregular surface"), (2, "Unstable footing"))),
    Rule("surface_gravel", "surface", 55, Condition("surface", "equals", "gravel"), _all((1, "Loose aggregate"), (3, "Difficult rolling surface"), (1, "Loose aggregate"), (2, "Unstable footing"))),
    Rule("surface_cobble_sett", "surface", 55, Condition("surface", "in", ("cobblestone", "unhewn_cobblestone", "sett")), _all((1, "Uneven joints"), (3, "Difficult vibration-heavy rolling"), (2, "Irregular trip-prone surface"), (2, "Trip and instability hazard"))),
    Rule("surface_compacted_fine_gravel", "surface", 50, Condition("surface", "in", ("compacted", "fine_gravel")), {"wheelchair": (2, "Increased rolling resistance"), "elderly": (1, "Potentially loose footing")}),
    Rule("cross_slope_over_5", "cross_slope", 95, Condition("cross_slope_percent", "abs_gt", 5), _all((2, "Strong lateral imbalance"), (4, "High tip or drift risk", RISK), (2, "Strong lateral imbalance"), (3, "High fall risk"))),
    Rule("cross_slope_3_to_5", "cross_slope", 95, Condition("cross_slope_percent", "abs_range", low=3, high=5), _all((1, "Lateral imbalance"), (3, "Substantial drift or tip risk"), (1, "Lateral imbalance"), (2, "Instability"))),
    Rule("cross_slope_2_to_3", "cross_slope", 95, Condition("cross_slope_percent", "abs_range", low=2, high=3), {"wheelchair": (2, "Noticeable lateral effort"), "elderly": (1, "Mild lateral instability")}),
    Rule("uphill_over_12_5", "longitudinal_slope", 80, Condition(_SLOPE, "gt", 12.5), _all((3, "Extreme climbing effort"), (4, "Independent ascent may be impossible", BLOCKED), (2, "Extreme climbing effort"), (4, "Extreme exertion and fall risk", RISK)), directional=True),
    Rule("uphill_8_33_to_12_5", "longitudinal_slope", 80, Condition(_SLOPE, "range", low=8.33, high=12.5), _all((2, "High climbing effort"), (3, "Very difficult ascent"), (1, "High climbing effort"), (3, "High exertion")), directional=True),
    Rule("uphill_5_to_8_33", "longitudinal_slope", 80, Condition(_SLOPE, "range", low=5, high=8.33), _all((1, "Increased climbing effort"), (2, "Difficult ascent"), None, (2, "Increased exertion")), directional=True),
    Rule("downhill_over_12_5", "longitudinal_slope", 80, Condition(_SLOPE, "lt", -12.5), _all((3, "Extreme braking and fall risk"), (4, "Loss-of-control risk", RISK), (3, "Extreme descent hazard"), (4, "Extreme fall risk", RISK)), directional=True),
    Rule("downhill_8_33_to_12_5", "longitudinal_slope", 80, Condition(_SLOPE, "negative_range", low=8.33, high=12.5), _all((2, "High braking effort"), (3, "Substantial loss-of-control risk"), (2, "Steep descent hazard"), (3, "High fall risk")), directional=True),
    Rule("downhill_5_to_8_33", "longitudinal_slope", 80, Condition(_SLOPE, "negative_range", low=5, high=8.33), _all((1, "Increased braking effort"), (2, "Difficult controlled descent"), (1, "Increased descent care"), (2, "Increased fall risk")), directional=True),
)
