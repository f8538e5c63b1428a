"""Driver-side holder of the model currently used for scoring."""

from __future__ import annotations

import time
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Serving:
    """What is being served: replaced as a whole in one assignment, so a reader in
    another thread never sees one version's model under another's number."""

    model: object = None
    version: str | None = None
    uri: str | None = None
    polled_at: float = 0.0    # last successful registry poll


class ModelHolder:
    def __init__(self):
        self.serving = Serving()

    def get(self) -> tuple:
        now = self.serving
        return now.model, now.version, now.uri

    def set(self, model, version, uri, polled_at: float | None = None) -> None:
        """Swap the model in; the one before is closed."""
        before = self.serving
        self.serving = Serving(model, version, uri, time.time() if polled_at is None else polled_at)
        if before.model is not model and hasattr(before.model, "close"):
            before.model.close()

    def mark_checked(self, when: float | None = None) -> None:
        self.serving = replace(self.serving, polled_at=time.time() if when is None else when)

    def due(self, interval_seconds: float, now: float | None = None) -> bool:
        """A poll is due when nothing is loaded or the interval has passed."""
        serving = self.serving
        return serving.model is None or (time.time() if now is None else now) - serving.polled_at >= interval_seconds
