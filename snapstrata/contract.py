"""The dataset contract: what one kind of snapshot file must look like.

A contract is plain data.  Operators read it and build Columns from it, so the
same operators serve any dataset that can describe itself this way.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from typing import TYPE_CHECKING

from pyspark.sql import Column
from pyspark.sql.types import StructType

if TYPE_CHECKING:
    from snapstrata.functions.rules import Rule

DUPLICATE_REASON = "duplicate_business_key"
VALID, REJECTED = "valid", "rejected"


@dataclass(frozen=True)
class LeadTimeBands:
    """Ordered upper bounds with names; everything above the last is the open band."""

    steps: tuple[tuple[str, int], ...]
    open_ended: str
    start: int = 0

    def rows(self) -> list[tuple[str, int, int, int | None]]:
        """(label, ordinal, first day, last day or None) per band, nearest first."""
        out: list[tuple[str, int, int, int | None]] = []
        low = self.start
        for ordinal, (name, high) in enumerate(self.steps, start=1):
            out.append((f"{low}-{high} days ({name})", ordinal, low, high))
            low = high + 1
        out.append((f"{low}+ days ({self.open_ended})", len(self.steps) + 1, low, None))
        return out


@dataclass(frozen=True)
class SnapshotContract:
    """Everything the operators need to know about one dataset.

    ``tiebreak`` orders rows that share a business key (first row wins); entries
    are (column, "asc" | "desc").
    """

    name: str
    source_schema: StructType
    row_number: str
    trims: tuple[str, ...]
    casing: Mapping[str, str]
    rules: tuple["Rule", ...]
    business_key: tuple[str, ...]
    group_key: tuple[str, ...]
    key_column: str
    group_column: str
    tiebreak: tuple[tuple[str, str], ...]
    output: tuple[str, ...]
    bands: LeadTimeBands
    derive: Callable[[], dict[str, Column]] = field(default=dict)
    snapshot: str = "as_of_date"
    #: rank valid rows before invalid ones when picking the surviving row
    prefer_valid: bool = False
    #: keep a losing duplicate's own failed rules beside the duplicate reason
    keep_duplicate_reasons: bool = False
    #: token that stands for NULL inside surrogate keys; None skips NULLs
    null_token: str | None = None

    def with_options(self, **changes: object) -> "SnapshotContract":
        return replace(self, **changes)  # type: ignore[arg-type]
