from clickstrata.plans.lakehouse import (
    run_bronze,
    run_gold,
    run_lakehouse,
    run_marts,
    run_sessions,
    run_silver,
)
from clickstrata.plans.modelling import evaluate, model_report, run_modelling

__all__ = [
    "evaluate",
    "model_report",
    "run_bronze",
    "run_gold",
    "run_lakehouse",
    "run_marts",
    "run_modelling",
    "run_sessions",
    "run_silver",
]
