"""How often something is tried, and how long the waits in between are."""

from __future__ import annotations

import random
import time
from collections.abc import Callable
from dataclasses import dataclass


@dataclass(frozen=True)
class Retry:
    """Waits double from ``base_delay`` up to ``max_delay``; ``jitter`` adds up to one ``base_delay``."""

    max_attempts: int = 3
    base_delay: float = 1.0
    max_delay: float = 60.0
    jitter: bool = True

    def delay(self, attempt: int, retry_after: float | None = None, draw: Callable[[], float] = random.random) -> float:
        if retry_after is not None:
            return min(retry_after, self.max_delay)
        return min(self.base_delay * 2**attempt + (draw() * self.base_delay if self.jitter else 0), self.max_delay)

    def call(self, f: Callable, *args, wait: Callable[[float], None] = time.sleep, fatal: tuple[type[Exception], ...] = ()):
        """The first result of ``f``; the last error if every attempt fails, or at once if it is ``fatal``."""
        for attempt in range(self.max_attempts):
            try:
                return f(*args)
            except fatal:
                raise
            except Exception as e:
                if attempt + 1 == self.max_attempts:
                    raise
                wait(self.delay(attempt, getattr(e, "retry_after", None)))


# The presets.
HTTP = Retry()
RATE_LIMIT = Retry(5, 2.0, 300.0)
