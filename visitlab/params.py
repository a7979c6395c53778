"""Task parameters of the session analyses.

The properties-file JSON of the original application becomes a dataclass.
An empty string or ``None`` means "no restriction", as in the original,
where an empty value could not be read back and every check passed.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, fields


def _split_list(value) -> tuple[str, ...] | None:
    """Comma text or sequence -> tuple of trimmed, non-empty parts; None if empty."""
    if value is None:
        return None
    if isinstance(value, str):
        parts = [p.strip() for p in value.split(",")]
    else:
        parts = [str(p).strip() for p in value]
    parts = tuple(p for p in parts if p)
    return parts or None


def _opt_int(value) -> int | None:
    if value is None or (isinstance(value, str) and not value.strip()):
        return None
    return int(value)


def _opt_str(value) -> str | None:
    if value is None:
        return None
    value = str(value).strip()
    return value or None


@dataclass(frozen=True)
class TaskParams:
    start_date: str = "2024-01-01"
    end_date: str = "2024-01-31"
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] | None = None
    cities: tuple[str, ...] | None = None
    sex: str | None = None
    keywords: tuple[str, ...] | None = None
    category_ids: tuple[int, ...] | None = None
    target_page_flow: tuple[int, ...] | None = None
    task_id: str = field(default_factory=lambda: str(uuid.uuid4()))

    def __post_init__(self):
        set_ = object.__setattr__
        set_(self, "start_age", _opt_int(self.start_age))
        set_(self, "end_age", _opt_int(self.end_age))
        set_(self, "professionals", _split_list(self.professionals))
        set_(self, "cities", _split_list(self.cities))
        set_(self, "sex", _opt_str(self.sex))
        set_(self, "keywords", _split_list(self.keywords))
        ids = _split_list(self.category_ids)
        set_(self, "category_ids", tuple(int(x) for x in ids) if ids else None)
        flow = _split_list(self.target_page_flow)
        set_(self, "target_page_flow", tuple(int(x) for x in flow) if flow else None)
        if not self.start_date or not self.end_date:
            raise ValueError("start_date and end_date are required")

    @property
    def age_restricted(self) -> bool:
        # Both bounds are needed; one missing bound means no age restriction.
        return self.start_age is not None and self.end_age is not None

    # Parameter names of the original properties file, mapped to ours.
    _KEYS = {
        "startDate": "start_date", "endDate": "end_date",
        "startAge": "start_age", "endAge": "end_age",
        "professionals": "professionals", "cities": "cities", "sex": "sex",
        "keywords": "keywords", "categoryIds": "category_ids",
        "targetPageFlow": "target_page_flow", "taskId": "task_id",
    }

    @classmethod
    def from_dict(cls, d: dict) -> "TaskParams":
        names = {f.name for f in fields(cls)}
        kwargs = {}
        for k, v in d.items():
            k = cls._KEYS.get(k, k)
            if k not in names:
                raise KeyError(f"unknown task parameter {k!r}")
            kwargs[k] = v
        return cls(**kwargs)

    def replace(self, **changes) -> "TaskParams":
        d = {f.name: getattr(self, f.name) for f in fields(self)}
        d.update(changes)
        return TaskParams(**d)
