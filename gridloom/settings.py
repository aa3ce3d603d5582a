"""Run modes: `deep` takes settings as given, `dev` holds them to small ones."""

from __future__ import annotations

from dataclasses import dataclass, replace

#: The most that a dev run takes, and its resolution in metres.
DEV_LIMITS = {"max_items": 400, "anchors": 24, "window_days": 21, "max_cloud": 20.0, "scenes_per_period": 20, "downloads": 300}
DEV_RESOLUTION = 20


@dataclass(frozen=True)
class RunSettings:
    max_items: int = 5000
    anchors: int = 24
    window_days: int = 21
    max_cloud: float = 20.0
    scenes_per_period: int | None = None
    downloads: int | None = None
    resolution: int = 10


def effective(settings: RunSettings, mode: str) -> RunSettings:
    if mode == "deep":
        return settings
    if mode != "dev":
        raise ValueError(f"unknown mode: {mode}")
    held = {k: most if (given := getattr(settings, k)) is None else min(given, most) for k, most in DEV_LIMITS.items()}
    return replace(settings, **held, resolution=DEV_RESOLUTION)
