"""What the jobs share: configuration, logging, a session for the command line."""

from __future__ import annotations

import json
import logging
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession  # noqa: E402

from sievework.session import ship  # noqa: E402


def config_of(path: str | None, default: str) -> dict:
    """A small JSON file of settings; without a path, the one beside the jobs."""
    return json.loads((Path(path) if path else Path(__file__).resolve().parent / default).read_text("utf-8"))


def session(name: str) -> SparkSession:
    """The session of a command line: what spark-submit or the defaults say, and this library on the executors."""
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    return ship(SparkSession.builder.appName(name).getOrCreate())
