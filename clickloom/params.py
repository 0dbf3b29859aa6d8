"""The parameters one analysis run is started with."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class TaskParams:
    """Filters of a run. An empty string or ``None`` means "no filter"; lists are
    comma separated."""

    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: str | None = None
    cities: str | None = None
    sex: str | None = None
    keywords: str | None = None
    category_ids: str | None = None
    target_page_flow: str = "1,2,3,4,5,6,7"

    @classmethod
    def from_json(cls, text: str) -> TaskParams:
        """Read the camel-case JSON form (``{"startAge": 20, ...}``)."""
        raw = json.loads(text)
        camel = {_camel(f.name): f.name for f in fields(cls)}
        return cls(**{camel[k]: (None if v == "" else v) for k, v in raw.items() if k in camel})

    def __post_init__(self) -> None:
        for name in ("start_age", "end_age"):
            value = getattr(self, name)
            object.__setattr__(self, name, None if value in (None, "") else int(value))


def _camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(part.capitalize() for part in rest)


def split_list(text: str | None) -> list[str]:
    """A comma list as Python values; empty when there is no filter."""
    return text.split(",") if text else []
