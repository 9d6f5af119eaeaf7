"""Tables that registered queries look up, written once a session for a data folder.

A lookup or an update runs over a table that is already there, so its write is
no part of the query: it happens at the first call, and its time is kept apart
(``WRITE_SECONDS``).  The tables of a data folder are taken as fixed while the
session lasts.
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable

from pyspark.sql import SparkSession

from ..session import work_path

_PATHS: dict[tuple, str] = {}
WRITE_SECONDS: dict[str, float] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """The path of table ``name`` of ``sf_dir``, written with ``write(path)`` if this session has none yet."""
    key = (spark.sparkContext.applicationId, os.path.normpath(sf_dir), name)
    if key not in _PATHS:
        path, start = work_path(spark, name), time.perf_counter()
        write(path)
        WRITE_SECONDS[name] = round(time.perf_counter() - start, 3)
        _PATHS[key] = path
    return _PATHS[key]
