"""A run's progress as lines of JSON in the log: names and numbers, never the contents of rows."""

from __future__ import annotations

import json
import logging
import time

log = logging.getLogger("textloom.progress")

#: The longest name; anything longer might be a text.
LONGEST = 64


def progress(event: str, **facts: int | float | bool | str | None) -> str:
    """Log the event with its facts and return the line. Strings must be short names without white space."""
    for name, value in facts.items():
        if not isinstance(value, (int, float, bool, type(None))) and not (isinstance(value, str) and len(value) <= LONGEST and not any(c.isspace() for c in value)):
            raise ValueError(f"{name} of {event} is no number and no short name")
    line = json.dumps({"time": round(time.time(), 3), "event": event, **facts}, ensure_ascii=False)
    log.info(line)
    return line
