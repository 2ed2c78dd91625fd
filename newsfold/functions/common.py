"""Shared column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a lambda variable.

    Spark inlines column aliases when it pushes a filter through a projection,
    so an expensive expression referenced several times inside another one
    (or inside a pushed-down filter) would be copied and evaluated repeatedly.
    Binding it through a one-element ``transform`` keeps a single evaluation
    and a compact plan; the work stays JVM-side."""
    return F.transform(F.array(value), body).getItem(0)
