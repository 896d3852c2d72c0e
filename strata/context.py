"""One run context passed to every step (run id, logical clock, principal)."""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass, field


@dataclass(frozen=True)
class RunContext:
    """Everything a step stamps on its output.

    `as_of` is the logical processing time: it is bound once per run so that every
    stamp in every table agrees, and a re-run with the same context is reproducible.
    """

    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    as_of: _dt.datetime = field(default_factory=lambda: _dt.datetime.now(_dt.timezone.utc)
                                .replace(tzinfo=None, microsecond=0))
    principal: str = "system"

    @property
    def as_of_date(self) -> _dt.date:
        return self.as_of.date()
