"""Imports every module of this subpackage that registers queries."""

from paperloom.llm import p1, p2, p3, p4, p6, p7, p8  # noqa: F401
from paperloom.llm.registry import ORACLES, QUERIES  # noqa: F401
