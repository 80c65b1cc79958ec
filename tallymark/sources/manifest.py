"""What has been written, under which settings: a small JSON file, replaced atomically."""

from __future__ import annotations

import hashlib
import json
import os
import tempfile
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.config import OUTPUT_SCHEMA_VERSION


def write_json(path: str, payload: Any) -> None:
    """Through a temporary file in the same folder, synced and renamed."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    fd, tmp = tempfile.mkstemp(dir=os.path.dirname(path) or ".", suffix=".tmp")
    try:
        with os.fdopen(fd, "w", encoding="utf-8") as f:
            json.dump(payload, f, ensure_ascii=False, indent=1, sort_keys=True)
            f.flush()
            os.fsync(f.fileno())
        os.replace(tmp, path)
    except BaseException:
        if os.path.exists(tmp):
            os.remove(tmp)
        raise


def read_json(path: str) -> dict:
    """{} for a missing or broken file."""
    try:
        with open(path, encoding="utf-8") as f:
            got = json.load(f)
        return got if isinstance(got, dict) else {}
    except (OSError, ValueError):
        return {}


class Manifest:
    """Entries by key, each with the digest of its settings; another version of the schema starts empty."""

    def __init__(self, path: str):
        self.path = path
        got = read_json(path)
        self.entries: dict[str, Any] = got.get("entries", {}) if got.get("version") == OUTPUT_SCHEMA_VERSION else {}

    def save(self) -> None:
        write_json(self.path, {"version": OUTPUT_SCHEMA_VERSION, "entries": self.entries})

    def put(self, key: str, value: Any) -> None:
        self.entries[key] = value
        self.save()

    def drop(self, key: str) -> None:
        if self.entries.pop(key, None) is not None:
            self.save()

    def fresh(self, key: str, digest: str, inputs: Any) -> bool:
        """True if the entry was made from these inputs under these settings."""
        e = self.entries.get(key)
        return isinstance(e, dict) and e.get("digest") == digest and e.get("inputs") == inputs

    def sweep(self) -> int:
        """Removes temporary files left by a killed run."""
        folder = os.path.dirname(self.path) or "."
        old = [n for n in os.listdir(folder) if n.endswith(".tmp")] if os.path.isdir(folder) else []
        for n in old:
            os.remove(os.path.join(folder, n))
        return len(old)


def quick_hash(path: str, part: int = 1 << 20) -> str:
    """Digest of a file's size and its first and last part: reads two parts, however large the file."""
    size = os.path.getsize(path)
    h = hashlib.sha256(str(size).encode())
    with open(path, "rb") as f:
        h.update(f.read(part))
        if size > part:
            f.seek(max(part, size - part))
            h.update(f.read(part))
    return h.hexdigest()


def fingerprint(paths: list[str]) -> list[list]:
    """(name, size, time of change, digest) of files, for freshness: an edit in the middle of a file shows in its time."""
    return [[os.path.basename(p), os.path.getsize(p), os.stat(p).st_mtime_ns, quick_hash(p)] for p in sorted(paths)]


def table_digest(df: DataFrame | None) -> str:
    """Digest of the rows of a dimension table, whatever their order; none for no table."""
    if df is None:
        return "none"
    n, a, b = df.select(F.xxhash64(*df.columns).alias("h"), F.xxhash64(F.lit(1), *df.columns).alias("g")).agg(F.count("h"), F.sum(F.col("h").cast("decimal(38,0)")), F.sum(F.col("g").cast("decimal(38,0)"))).first()
    return hashlib.sha256(f"{df.schema.simpleString()}:{n}:{a}:{b}".encode()).hexdigest()[:16]
