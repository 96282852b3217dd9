"""Flat-file intake and validation, written as Spark DataFrame expressions."""

from rawgate.plans.ingest import IntakeOptions, IntakeResult, ingest
from rawgate.session import build_session
from rawgate.sources.control import ControlTables

__all__ = ["ControlTables", "IntakeOptions", "IntakeResult", "build_session", "ingest"]
