"""Green-time ladder and status texts, shared by batch plans and request scoring."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from speedloom import fixed_values as fv

# Ladder steps by number: 0 is an unknown probability, then from the highest step down.
_PCTS = [fv.LADDER_UNKNOWN[0], *[pct for _, pct, _ in fv.LADDER], fv.LADDER_FLOOR[0]]
_LEVELS = [fv.LADDER_UNKNOWN[1], *[level for *_, level in fv.LADDER], fv.LADDER_FLOOR[1]]


def _texts(shorten: str) -> list[str]:
    return [fv.TEXT_EXTEND.format(pct) if pct > 0 else shorten.format(-pct) if pct < 0 else fv.TEXT_UNKNOWN
            for pct in _PCTS]


def ladder_step(prob: Column) -> Column:
    step = F.when(prob.isNull() | F.isnan(prob), 0)
    for i, (least, *_) in enumerate(fv.LADDER, 1):
        step = step.when(prob >= least, i)
    return step.otherwise(len(fv.LADDER) + 1)


def _pick(choices: list, step: Column) -> Column:
    """Constant of a ladder step: one look-up in a literal array, however long the texts."""
    return F.get(F.array(*choices), step)


def green_extension_pct(prob: Column) -> Column:
    return _pick([F.lit(p) for p in _PCTS], ladder_step(prob))


def signal_level(prob: Column) -> Column:
    return _pick([F.lit(v) for v in _LEVELS], ladder_step(prob))


def strategy_text(prob: Column, shorten: str = fv.TEXT_SHORTEN) -> Column:
    """Strategy sentence; an unknown probability keeps the cycle."""
    return _pick([F.lit(t) for t in _texts(shorten)], ladder_step(prob))


def serving_strategy(prob: Column) -> Column:
    """Level, percentage and sentence of the answer to a request."""
    answers = [
        F.struct(F.lit(level).alias("level"), F.lit(pct).alias("green_extension_pct"),
                 F.lit(text).alias("strategy"))
        for level, pct, text in zip(_LEVELS, _PCTS, _texts(fv.TEXT_SHORTEN_SERVING))
    ]
    return _pick(answers, ladder_step(prob))


def status_text(prediction: Column) -> Column:
    return F.when(prediction == 1, F.lit(fv.STATUS_RISK)).otherwise(F.lit(fv.STATUS_CLEAR))
