"""Registered queries, each with its SQL twin where SQL can say the same."""

from __future__ import annotations

from tidesift.plans.catalog import evaluation, exploration, features, labelling, learning, serving, texts
from tidesift.plans.catalog.base import REGISTRY

__all__ = ["REGISTRY", "evaluation", "exploration", "features", "labelling", "learning", "serving", "texts"]
