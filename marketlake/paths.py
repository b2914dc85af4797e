"""One place for the layer locations (Bronze / Silver / Gold / quarantine)."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Paths:
    root: str

    def _join(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def bronze(self) -> str:
        return self._join("bronze")

    @property
    def bronze_compact(self) -> str:
        return self._join("bronze_compact")

    @property
    def silver(self) -> str:
        return self._join("silver")

    @property
    def gold(self) -> str:
        return self._join("gold")

    @property
    def quarantine(self) -> str:
        return self._join("quarantine")

    def silver_table(self, table: str) -> str:
        return self._join("silver", table)

    def gold_table(self, table: str) -> str:
        return self._join("gold", table)
