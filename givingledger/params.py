"""Parameters of one export run."""

from __future__ import annotations

from dataclasses import dataclass, fields
from datetime import datetime
from typing import Any

from givingledger.functions.fiscal import FiscalCalendar
from givingledger.names import NIL_GUID


def normalise_id(value: Any) -> Any:
    """Ids compare without regard to case; ids of other types are left alone."""
    return value.strip().lower() if isinstance(value, str) else value


@dataclass(frozen=True)
class ExportParams:
    """Everything a caller chooses. ``as_of`` stands for the clock, so that reruns agree.

    ``ignore_case`` is about titles and organization types; ids never depend on case.
    """

    fiscal_start: datetime
    as_of: datetime
    school_name: str | None = None
    school_address: str | None = None
    school_phone: str | None = None
    school_email: str | None = None
    campaign_id: Any = None
    average_campaign_id: Any = None
    top_percent: int | None = None
    base_url: str | None = None
    giving_template_id: Any = None
    daf_class_id: int | None = None
    daf_organization_type: str | None = None
    include_top_average_sentence: bool = False
    ignore_case: bool = False

    def __post_init__(self) -> None:
        for field in fields(self):
            value = getattr(self, field.name)
            if field.name.endswith("_id"):
                object.__setattr__(self, field.name, normalise_id(value))
        if self.average_campaign_id == NIL_GUID:
            object.__setattr__(self, "average_campaign_id", None)

    @property
    def calendar(self) -> FiscalCalendar:
        return FiscalCalendar.starting(self.fiscal_start, self.as_of)
