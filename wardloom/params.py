"""Settings shared by every job."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime


@dataclass(frozen=True)
class Params:
    """Study window, provenance and registry settings.

    ``cutoff`` is midnight of the last day: an event later on that day is
    outside the study.  ``as_of`` stands in for "now" so that a run can be
    repeated; left empty it is the time at which Spark runs the query, on a
    clock in ``time_zone``, where the sources' times were taken.
    """

    study_start: datetime = datetime(2020, 1, 1)
    cutoff: datetime = datetime(2021, 6, 30)
    as_of: datetime | None = None
    time_zone: str = "Europe/London"

    #: constant last column of every export, and the first two of every legacy view
    provenance: str = "Research Centre"
    organisation: str = "RWE"

    #: whether text patterns ignore case (the collation of the source is not known)
    ignore_case: bool = True

    #: pseudonym registry
    id_prefix: str = "HCVPt"
    id_digits: int = 16
    salt: str | None = None
