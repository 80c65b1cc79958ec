"""Settings of a run: plain values, hashable, part of every manifest entry."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass

#: Version of the written datasets; a change makes older ones unusable for reuse.
OUTPUT_SCHEMA_VERSION = 1
FLOWS = ("X", "M")
LEVELS = ("HS2", "HS4", "HS6", "ALL")
REVISIONS = ("H0", "H1", "H2", "H3", "H4", "H5", "H6")
DEFAULT_UPLIFT = 0.10
PHASES = ("retrieval", "aggregate", "match", "residual")


@dataclass(frozen=True)
class Config:
    years: tuple[str, ...] = ("2021",)
    hs_level: str = "HS6"
    prefixes: tuple[str, ...] = ()
    reporters: tuple[int, ...] | None = None
    canonical_revision: str = "H4"
    default_uplift: float = DEFAULT_UPLIFT
    null_keys_match: bool = True

    def __post_init__(self):
        if self.hs_level not in LEVELS:
            raise ValueError(f"unknown level {self.hs_level}")
        if bad := [y for y in self.years if not (len(y) == 4 and y.isdigit())]:
            raise ValueError(f"no years: {bad}")
        if self.canonical_revision not in REVISIONS:
            raise ValueError(f"unknown revision {self.canonical_revision}")

    def digest(self) -> str:
        return hashlib.sha256(json.dumps({**asdict(self), "schema": OUTPUT_SCHEMA_VERSION}, sort_keys=True).encode()).hexdigest()[:16]
