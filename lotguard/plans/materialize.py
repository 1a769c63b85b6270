"""Land derived tables once and read them back.

The pipeline's stages hand over through written tables (the landed sheet
rows, the published hand-off); queries that consume a stage read its table
instead of re-deriving it. Tables live under the session's
``spark.checkpoint.dir`` (shared storage on a cluster), keyed by the input
files' names, sizes and modification times and by a hash of this package's
source, so a changed input or changed code never reads a stale table. Writing
also cuts lineage: a lost executor recomputes from the written table, not
from the raw inputs.
"""

from __future__ import annotations

import hashlib
import json
import os
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lotguard.session import ensure_checkpoint_dir
from lotguard.sources.files import create_if_absent, exists, hadoop

_PKG = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_CODE_HASH: str | None = None


def _code_hash() -> str:
    global _CODE_HASH
    if _CODE_HASH is None:
        h = hashlib.sha256()
        for root, _, files in sorted(os.walk(_PKG)):
            for f in sorted(files):
                if f.endswith(".py"):
                    with open(os.path.join(root, f), "rb") as fh:
                        h.update(f.encode() + fh.read())
        _CODE_HASH = h.hexdigest()[:12]
    return _CODE_HASH


def _input_key(spark: SparkSession, sf_dir: str) -> str:
    fs, root = hadoop(spark, sf_dir)
    h = hashlib.sha256(sf_dir.encode())
    for st in sorted(fs.listStatus(root), key=lambda s: s.getPath().getName()):
        h.update(f"{st.getPath().getName()}:{st.getLen()}:{st.getModificationTime()};".encode())
    return h.hexdigest()[:12]


_LOCKS: dict[str, threading.Lock] = {}
_FRAMES: dict[tuple[str, str], DataFrame] = {}


def landed(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame], even_by: str | None = None) -> DataFrame:
    """Read table ``name`` derived from ``sf_dir``; build and write it first
    if it is not there yet. Rows are written as their last step leaves them,
    without a shuffle for the write: rows of a batch stay together, so that they
    pack well here and in the shuffles that read them. ``even_by`` evens out a
    table of many unequal parts by a column."""
    # Listed anew each time: a changed input has another key.
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/lotguard-landed/{_input_key(spark, sf_dir)}-{_code_hash()}/{name}"
    key = (spark.sparkContext.applicationId, path)
    if key in _FRAMES:
        # A landed table never changes: reuse the handle (no new file listing
        # or footer read per query).
        return _FRAMES[key]
    fs, done = hadoop(spark, path + "/_SUCCESS")
    # One writer per table in this driver: concurrent queries wait for it.
    with _LOCKS.setdefault(path, threading.Lock()):
        if not fs.exists(done):
            df = build()
            (df.hint("rebalance", even_by) if even_by else df).write.mode("overwrite").parquet(path)
        _FRAMES[key] = spark.read.parquet(path)
    return _FRAMES[key]


def landed_run(spark: SparkSession, sf_dir: str, name: str, build: Callable[[str], dict]) -> dict:
    """What ``build(folder)`` returns (a dict of paths and ids of a job's written
    outputs); it runs once for these inputs and this code."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/lotguard-landed/{_input_key(spark, sf_dir)}-{_code_hash()}/{name}"
    with _LOCKS.setdefault(path, threading.Lock()):
        if not exists(spark, f"{path}/done.json"):
            # a folder of its own for each attempt: a broken one is never read
            create_if_absent(spark, f"{path}/done.json", json.dumps(build(f"{path}/{uuid.uuid4().hex}")))
        return json.loads(spark.read.text(f"{path}/done.json").first()[0])
