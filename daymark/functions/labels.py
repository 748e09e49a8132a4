"""Provenance labels as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daymark import constants as C


def finished_label(flag: str = "finished_window_flag") -> Column:
    """A summed window that is over holds actuals; any other flag, NULL included, is still a forecast."""
    return F.when(F.col(flag) == C.FLAG_FINISHED, C.LABEL_ACTUAL).otherwise(C.LABEL_POSTLAUNCH)


def phase_label(phase: str = "phase") -> Column:
    """Label of a forecast made before launch."""
    return F.when(F.col(phase) == C.PHASE_PRE_LAUNCH, C.LABEL_PRELAUNCH).otherwise(C.LABEL_POSTGREENLIGHT)
