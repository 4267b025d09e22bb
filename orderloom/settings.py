"""Options shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from orderloom.constants import TAT_CUTOFF


@dataclass(frozen=True)
class Settings:
    """How to compute, not what to read.

    compat         True gives the results analysts see today, odd ones included
                   (README, "Compatibility"); False gives the evident intent.
    ignore_case    match states, modes and type names without regard to case, as a
                   case-insensitive database collation does.
    tat_cutoff     turnaround times only cover orders and shipments created after this.
    fetched_at     load time stamped on every wide row; None means the query's own time.
    """

    compat: bool = True
    ignore_case: bool = False
    tat_cutoff: datetime = TAT_CUTOFF
    fetched_at: datetime | None = None
