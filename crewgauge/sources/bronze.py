"""The bronze layer as one object."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Bronze:
    """Raw frames of one build.

    ``spells`` are the absence rows; their AbsenceID may be missing from sources that do not
    carry one, in which case ``with_absence_id`` adds it. ``terminations`` holds recorded leaving
    dates (EmployeeNumber, termination_date); without it they are derived. ``hire_dates`` is any
    frame whose HireDate column has the same minimum as the recruitment rows', for a source where
    that is cheaper to read.
    """

    employees: DataFrame
    recruitment: DataFrame
    spells: DataFrame
    terminations: DataFrame | None = None
    with_absence_id: Callable[[DataFrame], DataFrame] | None = None
    hire_dates: DataFrame | None = None

    @property
    def hires(self) -> DataFrame:
        return self.recruitment if self.hire_dates is None else self.hire_dates

    @property
    def absence(self) -> DataFrame:
        return self.with_absence_id(self.spells) if self.with_absence_id else self.spells
