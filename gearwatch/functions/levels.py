"""Risk levels, actions, alert texts and labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gearwatch.functions.display import fixed_decimals
from gearwatch.schema import Thresholds

# Texts stored in the results.
SCORE_ACTIONS = {
    "CRITICAL": "Stop machine and inspect before operation.",
    "HIGH": "Schedule urgent inspection during the nearest safe stop.",
    "MEDIUM": "Monitor during the next prediction window.",
    "LOW": "Continue normal operation.",
}
PROBABILITY_ACTIONS = {
    "HIGH": "Schedule urgent inspection during the nearest safe stop.",
    "MEDIUM": "Monitor this engine closely in the next prediction run.",
    "LOW": "Continue normal operation.",
}
FAILURE_CYCLES = 15


def score_level(score: Column, cuts: Thresholds = Thresholds()) -> Column:
    return (F.when(score >= cuts.critical, "CRITICAL").when(score >= cuts.high, "HIGH")
            .when(score >= cuts.medium, "MEDIUM").otherwise("LOW"))


def probability_level(probability: Column, cuts: Thresholds = Thresholds()) -> Column:
    return (F.when(probability >= cuts.high_probability, "HIGH")
            .when(probability >= cuts.medium_probability, "MEDIUM").otherwise("LOW"))


def action_for(level: Column, actions: dict[str, str]) -> Column:
    pairs = [F.lit(text) for item in actions.items() for text in item]
    return F.create_map(*pairs)[level]


# The wording of the two alert messages below is stored and searched for.
def score_message(level: Column, engine: Column, cycle: Column, score: Column) -> Column:
    return F.concat(level, F.lit(" risk for engine "), engine.cast("string"),
                    F.lit(" at cycle "), cycle.cast("string"), F.lit(": score="), score.cast("string"))


def probability_message(engine: Column, cycle: Column, probability: Column) -> Column:
    return F.concat(F.lit("HIGH failure probability for engine "), engine.cast("string"), F.lit(" at cycle "),
                    cycle.cast("string"), F.lit(": probability="), fixed_decimals(probability, 4))


def failure_label(remaining: Column, within: int = FAILURE_CYCLES) -> Column:
    return (remaining <= within).cast("int")
