"""Run parameters of a funnel refresh (never hard-coded in the operators)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class FunnelConfig:
    # first tracked week, compared in local (shifted) time
    appt_start: dt.date
    # cushion for order / invoice / answer / encounter scans, compared in raw UTC
    sub_start: dt.date
    # location ids that make a screening call "online"
    online_locations: tuple
    # consultation id of the therapy product
    therapy_id: object
    # local time = stored UTC time + this shift
    shift_hours: int = 5
    shift_minutes: int = 30
