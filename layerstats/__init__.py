"""Layered per-entity, per-event statistics on Spark."""

from layerstats import functions, operators, plans, sources
from layerstats.functions import *  # noqa: F403
from layerstats.operators import *  # noqa: F403
from layerstats.plans import *  # noqa: F403
from layerstats.sources import *  # noqa: F403

__all__ = [
    *functions.__all__,
    *operators.__all__,
    *plans.__all__,
    *sources.__all__,
]
