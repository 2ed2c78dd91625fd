"""Column functions for scores (inventory R1, R2, R3).

Scores are integers; a composite score is a struct, which Spark orders
lexicographically, so ``max_by(row, struct(...))`` is the tuple comparison.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _any_substring(host: Column, needles) -> Column:
    cond = F.lit(False)
    for n in needles:
        cond = cond | (F.instr(host, n) > 0)
    return cond


def domain_score(domain, rules=K.DOMAIN_RULES) -> Column:
    """Sum over rule groups of the group's points when any of its
    substrings occurs in the host (each group counts once)."""
    host = _c(domain)
    total = F.lit(0)
    for needles, points in rules:
        total = total + F.when(_any_substring(host, needles), F.lit(points)).otherwise(F.lit(0))
    return total.cast("int")


def official_bonus(domain, hosts=K.OFFICIAL_HOSTS, bonus: int = K.OFFICIAL_BONUS) -> Column:
    """R2: bonus when the host contains any official host."""
    return F.when(_any_substring(_c(domain), hosts), F.lit(bonus)).otherwise(F.lit(0)).cast("int")
