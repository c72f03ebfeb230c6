"""Imports every module that registers queries."""

from paperloom.plans import answers, collect, corpus, forms, references  # noqa: F401
from paperloom.plans.registry import ORACLES, QUERIES  # noqa: F401
