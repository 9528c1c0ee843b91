"""A log file for each stage, on the driver."""

from __future__ import annotations

import logging
import os
from contextlib import contextmanager


@contextmanager
def stage_log(path: str, level: int = logging.INFO):
    """While it lasts, what this package logs also goes to a file. A path on a store that isn't mounted here gets none: Spark's own logs hold it."""
    logger = logging.getLogger("variantloom")
    if "://" in path and not path.startswith("file://"):
        yield
        return
    path = path.removeprefix("file://")
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    handler = logging.FileHandler(path)
    handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s %(message)s"))
    before = logger.level
    logger.addHandler(handler)
    logger.setLevel(level)
    try:
        yield
    except Exception:
        logger.exception("failed")
        raise
    finally:
        logger.removeHandler(handler)
        handler.close()
        logger.setLevel(before)
