"""Settings of a comparison run: defaults, a YAML file over them, and overrides over both."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace
from pathlib import Path
from typing import Any

#: Sections of a report, in order (fixed values).
SECTIONS = (
    "queries", "chunk_distance", "raw_distance", "distilled_distance", "vector_improvement", "word_improvement",
    "aggregate", "projected", "raw_gain_percent", "distilled_gain_percent",
)


@dataclass(frozen=True)
class Settings:
    title: str = "Comparison"
    chunk_size: int = 2000
    overlap: int = 200
    queries: int = 1000
    results: int = 5
    dollars_per_million: float = 0.72
    duplication: int = 15
    sections: dict[str, bool] = field(default_factory=lambda: dict.fromkeys(SECTIONS, True))

    def shown(self) -> tuple[str, ...]:
        return tuple(s for s in SECTIONS if self.sections.get(s, True))


def settings(path: str | None = None, **overrides: Any) -> Settings:
    """Unknown keys are an error; overrides that are None count as not given; sections are merged."""
    given: dict[str, Any] = {}
    if path:
        import yaml

        given |= yaml.safe_load(Path(path).read_text()) or {}
    given |= {k: v for k, v in overrides.items() if v is not None}
    known = {f.name for f in fields(Settings)}
    if bad := set(given) - known:
        raise ValueError(f"unknown settings: {sorted(bad)}")
    base = Settings()
    if "sections" in given:
        given["sections"] = base.sections | given["sections"]
    return replace(base, **given)
