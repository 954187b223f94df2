from layerstats.plans.football import football_plan
from layerstats.plans.layers import (
    LayerPlan,
    build_bronze,
    build_gold,
    build_silver,
    run_layers,
    run_reports,
)

__all__ = [
    "LayerPlan",
    "build_bronze",
    "build_gold",
    "build_silver",
    "football_plan",
    "run_layers",
    "run_reports",
]
