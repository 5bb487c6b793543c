"""Structured logging: a line of JSON per event, or ``key=value`` for people who debug."""

from __future__ import annotations

import json
import logging
from datetime import datetime, timezone

_OWN = set(vars(logging.makeLogRecord({}))) | {"message", "asctime", "taskName"}
#: Libraries that say too much.
NOISY = ("py4j", "urllib3", "pyspark")


class Structured(logging.Formatter):
    """Whatever is given as ``extra`` becomes a field."""

    def __init__(self, debug: bool = False) -> None:
        super().__init__()
        self.debug = debug

    def format(self, record: logging.LogRecord) -> str:
        at = datetime.fromtimestamp(record.created, timezone.utc).isoformat()
        fields = {"event": record.getMessage(), "logger": record.name, "level": record.levelname.lower(), "timestamp": at}
        fields |= {k: v for k, v in vars(record).items() if k not in _OWN}
        if record.exc_info:
            fields["error"] = self.formatException(record.exc_info)
        return " ".join(f"{k}={v!r}" for k, v in fields.items()) if self.debug else json.dumps(fields, default=str, ensure_ascii=False)


def configure(level: str = "INFO", debug: bool = False) -> None:
    handler = logging.StreamHandler()
    handler.setFormatter(Structured(debug))
    logging.basicConfig(level=logging.DEBUG if debug else getattr(logging, level.upper(), logging.INFO), handlers=[handler], force=True)
    for name in NOISY:
        logging.getLogger(name).setLevel(logging.WARNING)
