"""What a run reports back."""

from __future__ import annotations

from dataclasses import dataclass

DONE = "DONE"
EMPTY = "EMPTY"


@dataclass(frozen=True)
class RunResult:
    """``moved`` counts tables whose status changed; ``rows`` is set where it is known."""

    outcome: str
    tables: tuple[str, ...]
    moved: int = 0
    rows: int | None = None
    next_mark: str | None = None
