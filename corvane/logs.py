"""Logging: one handler for the console, and one for a file if asked for."""

from __future__ import annotations

import logging
import os

FORM = "%(asctime)s %(levelname)s %(name)s: %(message)s"


def configure(level: str = "INFO", file: str | None = None) -> logging.Logger:
    """The package's logger, set up anew: called twice, it doesn't log twice. A file that can't be opened is said once and left out."""
    log = logging.getLogger("corvane")
    for h in list(log.handlers):
        log.removeHandler(h)
        h.close()
    log.setLevel(level)
    log.propagate = False
    handlers: list[logging.Handler] = [logging.StreamHandler()]
    if file:
        try:
            os.makedirs(os.path.dirname(file) or ".", exist_ok=True)
            handlers.append(logging.FileHandler(file, encoding="utf-8"))
        except OSError as e:
            handlers[0].stream.write(f"no log file: {e}\n")
    for h in handlers:
        h.setFormatter(logging.Formatter(FORM))
        log.addHandler(h)
    return log
