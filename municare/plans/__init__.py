"""The 34 models: staging views, intermediate views and marts."""

from municare.plans import intermediate, marts, staging  # noqa: F401  (register the models)
from municare.plans.checks import CHECKS
from municare.plans.registry import MODELS, Workspace, build_order
from municare.plans.run import build_marts, check_marts, open_marts, run_checks

__all__ = [
    "CHECKS",
    "MODELS",
    "Workspace",
    "build_marts",
    "build_order",
    "check_marts",
    "open_marts",
    "run_checks",
]
