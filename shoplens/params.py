"""Job parameters: the JSON document with startDate / endDate / targetPageFlow."""

from __future__ import annotations

import json
from dataclasses import dataclass


def is_not_blank(s: str | None) -> bool:
    """A value counts only when it is non-null and not all blanks."""
    return s is not None and s.strip() != ""


@dataclass(frozen=True)
class JobParams:
    start_date: str | None = None
    end_date: str | None = None
    target_page_flow: tuple[int, ...] = ()

    @classmethod
    def from_json(cls, text: str) -> "JobParams":
        doc = json.loads(text) if is_not_blank(text) else {}
        return cls.from_dict(doc)

    @classmethod
    def from_dict(cls, doc: dict) -> "JobParams":
        flow = doc.get("targetPageFlow")
        return cls(
            start_date=doc.get("startDate") if is_not_blank(doc.get("startDate")) else None,
            end_date=doc.get("endDate") if is_not_blank(doc.get("endDate")) else None,
            target_page_flow=parse_flow(flow) if is_not_blank(flow) else (),
        )


def parse_flow(flow) -> tuple[int, ...]:
    """``"1,2,3"`` or ``[1, 2, 3]`` -> ``(1, 2, 3)``."""
    if isinstance(flow, str):
        return tuple(int(p) for p in flow.split(",") if p.strip() != "")
    return tuple(int(p) for p in flow)
