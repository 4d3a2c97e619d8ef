"""Import every query module so the registry is complete."""

from __future__ import annotations

from riverlens.plans import (cleaning, contracts, evaluation, files, history, ingest, labelling, literal, models, profile,  # noqa: F401
                             regression, review, rules, scoring, streams, training)
from riverlens.plans.registry import ORACLES, QUERIES, SURVEY_IDS

__all__ = ["QUERIES", "ORACLES", "SURVEY_IDS"]
