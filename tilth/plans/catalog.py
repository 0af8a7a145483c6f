"""All registered queries."""

from __future__ import annotations

from tilth.plans import queries_fit, queries_models, queries_readings, queries_scenes  # noqa: F401
from tilth.plans.queries_models import flagship  # noqa: F401
from tilth.plans.registry import ORACLES, QUERIES  # noqa: F401
