"""An issue of the digest: one run, identified by its report date."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pressloom.constants import ISSUE_PREFIX, REPORT_UTC_OFFSET_HOURS, SEARCH_DAYS


@dataclass(frozen=True)
class Issue:
    """``as_of`` is the one clock reading of a run; a value without zone is UTC.

    The search window counts UTC dates, the issue itself is named by the report date. Two
    runs on the same report date make the same issue.
    """

    as_of: datetime
    days: int = SEARCH_DAYS

    @property
    def _utc(self) -> datetime:
        if self.as_of.tzinfo is None:
            return self.as_of.replace(tzinfo=timezone.utc)
        return self.as_of.astimezone(timezone.utc)

    @property
    def window_end(self) -> date:
        return self._utc.date()

    @property
    def window_start(self) -> date:
        return self.window_end - timedelta(days=self.days)

    @property
    def issue_date(self) -> date:
        return (self._utc + timedelta(hours=REPORT_UTC_OFFSET_HOURS)).date()

    @property
    def name(self) -> str:
        return f"{ISSUE_PREFIX}{self.issue_date.isoformat()}"
