"""Restart state by version: which files were read, published and completed.

The marker is one small JSON document per version, with a handful of files; it decides what a run
has to do. Questions on tables of files (pending, changed) are joins.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpmill.sinks.events import read_text, write_text

REPROCESS, CONTINUE, SKIP = "reprocess", "continue", "skip"
PENDING, RUNNING, DONE, FAILED = "pending", "in_progress", "completed", "failed"


def _now() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


@dataclass
class FileProgress:
    status: str = PENDING
    records: int = 0
    messages: int = 0
    sha256: str | None = None
    started_at: str | None = None
    completed_at: str | None = None
    error: str | None = None


@dataclass
class Phase:
    status: str = PENDING
    started_at: str | None = None
    completed_at: str | None = None
    errors: list[str] = field(default_factory=list)

    def start(self) -> None:
        self.status, self.started_at = RUNNING, self.started_at or _now()

    def finish(self, error: str | None = None) -> None:
        if error:
            self.errors.append(error)
        self.status, self.completed_at = FAILED if error else DONE, _now()


@dataclass
class Marker:
    """Phases (download, processing, publishing) and files of one version."""

    version: str
    started_at: str = field(default_factory=_now)
    phases: dict[str, Phase] = field(default_factory=lambda: {k: Phase() for k in ("download", "processing", "publishing")})
    files: dict[str, FileProgress] = field(default_factory=dict)
    status: str = PENDING

    def decide(self, force: bool = False) -> str:
        """Reprocess all, continue what is open, or skip a version that is complete.

        A download that failed or was cut off starts over only while no file is completed: fetching again
        costs little, publishing a completed file again costs hours."""
        if force:
            return REPROCESS
        if self.phases["download"].status in (FAILED, RUNNING):
            return CONTINUE if any(f.status == DONE for f in self.files.values()) else REPROCESS
        if self.phases["processing"].status not in (FAILED, RUNNING) and self.status == DONE:
            return SKIP
        return CONTINUE

    def pending(self, names: list[str]) -> list[str]:
        return [n for n in names if self.files.get(n, FileProgress()).status != DONE]

    def start_file(self, name: str) -> None:
        """A file that was under way starts again from its first record."""
        self.files[name] = FileProgress(RUNNING, sha256=self.files.get(name, FileProgress()).sha256, started_at=_now())

    def file_verified(self, name: str, sha256: str) -> bool:
        """Note the hash of a landed file. A completed file of other bytes is open again, its counts go and the
        version is no longer complete (True). Completed files without a hash are left alone."""
        own = self.files.setdefault(name, FileProgress())
        changed = own.status == DONE and own.sha256 is not None and own.sha256 != sha256
        if changed:
            self.files[name] = FileProgress(sha256=sha256)
            if self.status == DONE:
                self.status = RUNNING
            for phase in ("processing", "publishing"):
                if self.phases[phase].status == DONE:
                    self.phases[phase].status, self.phases[phase].completed_at = RUNNING, None
        elif own.status != DONE:
            own.sha256 = sha256
        return changed

    def advance_file(self, name: str, records: int) -> None:
        """Records of a file that is under way, for monitoring only: it starts again from its first record."""
        self.files[name].records = records

    def complete_file(self, name: str, records: int, messages: int) -> None:
        own = self.files.setdefault(name, FileProgress())
        own.status, own.records, own.messages, own.completed_at = DONE, records, messages, _now()

    def fail_file(self, name: str, error: str) -> None:
        """A file that failed is open: it starts again in the next run."""
        own = self.files.setdefault(name, FileProgress())
        own.status, own.error, own.completed_at = FAILED, error, _now()

    def totals(self) -> tuple[int, int]:
        return sum(f.records for f in self.files.values()), sum(f.messages for f in self.files.values())

    def complete(self) -> None:
        self.status = DONE
        for phase in ("processing", "publishing"):
            self.phases[phase].finish()

    def to_json(self) -> str:
        records, messages = self.totals()
        return json.dumps(asdict(self) | {"summary": {"records": records, "messages": messages, "files": len(self.files)}}, indent=1, sort_keys=True)

    @classmethod
    def from_json(cls, text: str | None, version: str) -> Marker:
        """The marker in ``text``; a fresh one if there is none, it is broken or of another version."""
        try:
            raw = json.loads(text or "")
            if raw["version"] != version:
                return cls(version)
            return cls(version, raw["started_at"], {k: Phase(**v) for k, v in raw["phases"].items()},
                       {k: FileProgress(**v) for k, v in raw["files"].items()}, raw["status"])
        except (ValueError, KeyError, TypeError, AttributeError):
            return cls(version)


def load_marker(spark: SparkSession, folder: str, version: str) -> Marker:
    return Marker.from_json(read_text(spark, f"{folder}/state_{version}.json"), version)


def save_marker(spark: SparkSession, folder: str, marker: Marker) -> None:
    write_text(spark, f"{folder}/state_{marker.version}.json", marker.to_json())


def decision(download: Column, processing: Column, overall: Column, some_done: Column, force: Column) -> Column:
    """``Marker.decide`` over a table of versions: what to do with each of them. A status that is null is pending."""
    under_way = lambda c: F.coalesce(c.isin(FAILED, RUNNING), F.lit(False))
    again = force | (under_way(download) & ~some_done)
    closed = ~under_way(download) & ~under_way(processing) & F.coalesce(overall == DONE, F.lit(False))
    return F.when(again, REPROCESS).when(closed, SKIP).otherwise(CONTINUE)


def version_decisions(files: DataFrame, phases: DataFrame, force: Column | None = None) -> DataFrame:
    """(version, decision, open_files) of versions by the table of their phases (version, download, processing, overall) and
    that of their files (version, file, status)."""
    own = files.groupBy("version").agg(F.count_if(F.col("status") == DONE).alias("done"), F.count_if(F.coalesce(F.col("status") != DONE, F.lit(True))).alias("open"))
    rows = phases.join(own, "version", "left")
    made = decision(F.col("download"), F.col("processing"), F.col("overall"), F.coalesce(F.col("done"), F.lit(0)) > 0, F.lit(False) if force is None else force)
    return rows.select("version", made.alias("decision"), F.coalesce("open", F.lit(0)).cast("long").alias("open_files"))


def duration_seconds(start: Column, end: Column) -> Column:
    """Whole seconds from one time to another, null while either is open."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def pending_files(files: DataFrame, completed: DataFrame) -> DataFrame:
    """Files (column ``file``) without a completed row."""
    return files.join(completed.select("file"), "file", "left_anti")


def changed_files(files: DataFrame, completed: DataFrame) -> DataFrame:
    """Completed files whose bytes are others now: both hashes known and different."""
    old = completed.select("file", F.col("sha256").alias("old_sha256"))
    return files.join(old, "file").where("sha256 <> old_sha256").select("file", "old_sha256", "sha256")


def upserted(progress: DataFrame, news: DataFrame, key: str = "file", order: str = "ts") -> DataFrame:
    """The control table with the latest row per file."""
    rows = progress.unionByName(news)
    return rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), order).alias("r")).select("r.*")
