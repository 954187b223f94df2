from layerstats.operators.aggregate import (
    Summary,
    profile,
    rounded_mean,
    shared_summaries,
    summarise,
    summarise_together,
    totals,
)
from layerstats.operators.conform import ConformSpec, Measure, conform
from layerstats.operators.report import Report, latest, run_report, top_n
from layerstats.operators.verify import LayerCheck, verify_layer

__all__ = [
    "ConformSpec",
    "LayerCheck",
    "Measure",
    "Report",
    "Summary",
    "conform",
    "latest",
    "profile",
    "rounded_mean",
    "run_report",
    "shared_summaries",
    "summarise",
    "summarise_together",
    "top_n",
    "totals",
    "verify_layer",
]
