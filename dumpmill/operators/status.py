"""Settings from the environment and a snapshot of a run for monitoring."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields
from pathlib import Path
from typing import Any

from dumpmill.operators.state import DONE, FAILED, RUNNING, Marker

IDLE, WAITING = "idle", "waiting"


@dataclass(frozen=True)
class Config:
    """Each setting is read from PREFIX_NAME, texts also from the file that PREFIX_NAME_FILE names; what does not
    parse is the default, numbers are 1 at least. A rate of 0 is no bound; a negative or infinite one is the
    default. A file may hold ``fault_budget`` malformed records. ``run_version`` takes the settings: ``workers`` is the number of files side by side."""

    batch_size: int = 100
    checkpoint_every: int = 5000
    workers: int = 4
    rate: float = 1500.0
    stall_seconds: int = 120
    period_days: int = 15
    fault_budget: int = 100
    prefix: str = "catalog"
    provider: str = "catalog"

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None, prefix: str = "DUMPMILL") -> Config:
        env, own = os.environ if env is None else env, {}
        for f in fields(cls):
            key = f"{prefix}_{f.name.upper()}"
            raw = env.get(key)
            if raw is None and isinstance(f.default, str) and (secret := env.get(f"{key}_FILE")):
                raw = Path(secret).read_text("utf-8").strip()
            if raw is None:
                continue
            if not isinstance(f.default, str):
                try:
                    value = type(f.default)(raw)
                except ValueError:
                    continue
                if isinstance(value, int):
                    own[f.name] = max(1, value)
                elif 0 <= value < float("inf"):
                    own[f.name] = value
            else:
                own[f.name] = raw
        return cls(**own)


def snapshot(marker: Marker | None, error: str | None = None) -> dict[str, Any]:
    """Status (idle, waiting, in_progress, completed, failed), phases and counts by data type."""
    if marker is None:
        return {"status": FAILED if error else IDLE, "error": error, "progress": {}}
    progress: dict[str, int] = {}
    for name, f in marker.files.items():
        kind = name.rsplit("_", 1)[-1].split(".")[0]
        progress[kind] = progress.get(kind, 0) + f.records
    open_ = any(f.status == RUNNING for f in marker.files.values())
    status = FAILED if error or any(p.status == FAILED for p in marker.phases.values()) else DONE if marker.status == DONE else RUNNING if open_ else WAITING
    return {"status": status, "error": error, "version": marker.version, "phases": {k: p.status for k, p in marker.phases.items()},
            "progress": progress | {"total": sum(progress.values())}}
