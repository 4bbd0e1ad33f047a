"""Configurations of the two branches: frozen, validated, closed to unknown keys, with a digest of what changes results."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, fields

from lamina.functions.keys import config_digest


@dataclass(frozen=True)
class Config:
    #: Keys that don't change results.
    NEUTRAL = ()

    @classmethod
    def of(cls, given: dict):
        known = {f.name for f in fields(cls)}
        if unknown := sorted(set(given) - known):
            raise ValueError(f"unknown keys: {unknown}")
        return cls(**given)

    @classmethod
    def from_json(cls, text: str):
        """From a configuration's own JSON, or from a manifest that holds one."""
        told = json.loads(text)
        return cls.of(told["config"] if "config" in told and isinstance(told["config"], dict) else told)

    def digest(self) -> str:
        return config_digest(asdict(self), self.NEUTRAL)

    def _positive(self, *names: str) -> None:
        for name in names:
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive")


@dataclass(frozen=True)
class LongConfig(Config):
    """Tall pages: windows of detection, cuts and packs."""

    window_height: int = 2048
    window_stride: int = 1792
    target_height: int = 3200
    max_height: int = 3900
    min_height: int = 2200
    search_radius: int = 600
    fallback_overlap: int = 160
    nms_iou: float = 0.50
    center_max_width: float = 0.60
    pack_gap: int = 10

    def __post_init__(self):
        self._positive("window_height", "window_stride", "target_height", "max_height", "min_height", "search_radius")
        if not self.min_height <= self.target_height <= self.max_height or self.window_stride > self.window_height:
            raise ValueError("min_height <= target_height <= max_height and window_stride <= window_height are needed")
        if not 0 < self.nms_iou <= 1:
            raise ValueError("nms_iou must lie in (0, 1]")


@dataclass(frozen=True)
class TableConfig(Config):
    """Table images: tiles and line detection."""

    NEUTRAL = ("single_tile_min_scale",)

    max_side: int = 3900
    overlap: int = 160
    max_cells: int = 140
    preferred_cells: int = 80
    max_aspect: float = 8.0
    row_coverage: float = 0.90
    column_coverage: float = 0.95
    column_contrast: int = 30
    coverage_bypass: float = 0.98
    grid_min_cell_size: int = 18
    single_tile_min_scale: float = 0.0

    def __post_init__(self):
        self._positive("max_side", "max_cells", "preferred_cells", "max_aspect", "grid_min_cell_size")
        if not 0 <= self.overlap < self.max_side or self.preferred_cells > self.max_cells:
            raise ValueError("overlap < max_side and preferred_cells <= max_cells are needed")
