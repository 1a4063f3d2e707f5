"""Where the layers live and where the source tables come from."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any


def _folder(root: str) -> str:
    return root.rstrip("/")


@dataclass(frozen=True)
class LakeConfig:
    """Roots of the three layers and of the control table, plus the table source.

    ``silver_catalog`` (for example ``"lake.sales"``) puts Silver into tables of a Spark catalog
    with row-level writes instead of plain Parquet folders, created with ``table_properties`` (for example
    ``{"format-version": "2"}``). With ``silver_buckets`` they are Parquet tables of the session's own
    catalog instead, bucketed by their keys; see :mod:`tidemark.sinks.bucketed`.
    """

    bronze_root: str
    silver_root: str
    gold_root: str
    state_root: str
    source: Any = field(default=None, repr=False)
    silver_catalog: str | None = None
    table_properties: Mapping[str, str] = field(default_factory=dict)
    silver_buckets: int | None = None

    @classmethod
    def under(cls, root: str, source: Any = None) -> LakeConfig:
        """All layers as folders of one root."""
        root = _folder(root)
        return cls(
            f"{root}/bronze", f"{root}/silver", f"{root}/gold", f"{root}/state", source
        )

    def bronze_path(self, table: str) -> str:
        return f"{_folder(self.bronze_root)}/{table}"

    def silver_path(self, table: str) -> str:
        return f"{_folder(self.silver_root)}/{table}"

    def gold_path(self, table: str) -> str:
        return f"{_folder(self.gold_root)}/{table}"

    @property
    def state_path(self) -> str:
        return f"{_folder(self.state_root)}/control"

    @property
    def staging_root(self) -> str:
        """Where changes to Silver are written before they are applied."""
        return f"{_folder(self.silver_root)}/_staged"
