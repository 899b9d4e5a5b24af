"""The whole set of text hints per article."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from cairnbook.constants import GAZETTEER
from cairnbook.functions import extract as X
from cairnbook.functions.strings import strip

LISTS = {
    "pre_dates": X.pre_dates, "people_pre": X.people, "rescue_teams_pre": X.rescue_teams,
    "route_difficulty_pre": X.route_difficulty, "route_types_pre": X.route_types, "equipment_pre": X.equipment,
}
VALUES = {
    "num_fatalities_pre": X.fatalities, "num_injured_pre": X.injured, "area_pre": X.area,
    "lead_sentences": X.lead_sentences, "fall_height_feet_pre": X.fall_feet,
    "fall_height_meters_pre": X.fall_meters, "slope_angle_deg_pre": X.slope_degrees, "aspect_cardinal_pre": X.aspect,
}
ORDER = ("pre_dates", "people_pre", "num_fatalities_pre", "num_injured_pre", "rescue_teams_pre", "area_pre",
         "gazetteer_matches", "lead_sentences", "route_difficulty_pre", "route_types_pre", "equipment_pre",
         "fall_height_feet_pre", "fall_height_meters_pre", "slope_angle_deg_pre", "aspect_cardinal_pre")


def pre_extract(texts: DataFrame, column: str = "text", names: Sequence[str] = GAZETTEER) -> DataFrame:
    """Replace the text by its hints; rules without a hit and blank texts give null.

    Two projections: the rules are evaluated once in the first, empty lists become null in the second."""
    text = F.nullif(strip(F.col(column)), F.lit(""))
    whole = F.when(text.isNotNull(), F.col(column))
    rules = {**{k: f(F.col("_text")) for k, f in {**LISTS, **VALUES}.items()},
             "gazetteer_matches": X.gazetteer_hits(F.col("_text"), names)}
    others = [c for c in texts.columns if c != column]
    found = texts.withColumn("_text", whole).select(*others, *[rules[k].alias(k) for k in ORDER])
    lists = (*LISTS, "gazetteer_matches")
    return found.select(*others, *[(F.when(F.size(k) > 0, F.col(k)) if k in lists else F.col(k)).alias(k) for k in ORDER])
