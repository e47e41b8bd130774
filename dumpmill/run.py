"""Entry points: a single file by manifest, and a folder of dumps with restart state."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, replace
from datetime import UTC, datetime
from functools import reduce
from threading import Event, Lock, Thread

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dumpmill.operators import report
from dumpmill.operators.blocks import attach_blocks
from dumpmill.operators.normalize import normalize
from dumpmill.operators.policy import apply_filters, split_skipped, violations, violations_long
from dumpmill.operators.state import REPROCESS, SKIP, Marker, load_marker, save_marker
from dumpmill.operators.status import Config
from dumpmill.plans.policy import Policy
from dumpmill.sinks import events as E
from dumpmill.sinks.broker import Desk, publish as publish_frames
from dumpmill.sources import Source
from dumpmill.sources.files import stream_sha256
from dumpmill.sources.manifest import read_manifest
from dumpmill.sources.xml import NAME, check_faults, read_dump, rejects

LOG = logging.getLogger("dumpmill")


@dataclass(frozen=True)
class Prepared:
    """The lazy tables of one entity."""

    parsed: DataFrame
    skipped: DataFrame
    checked: DataFrame
    records: DataFrame


def prepare(parsed: DataFrame, entity: str, policy: Policy | None = None, provider: str = "catalog") -> Prepared:
    """Skips, filters and rules on raw records, then the flat shape, blocks and hashes.

    Without a policy nothing is skipped or flagged; normalization always takes place.
    """
    own = (policy or Policy()).of(entity)
    good = parsed.where("error is null").drop("error")
    kept, skipped = split_skipped(good, own.skips, "data")
    checked = apply_filters(kept, own, "data")
    checked = checked.withColumn("violations", violations(checked, own.rules, "data"))
    return Prepared(good, skipped, checked, prepared_records(checked, entity, provider))


def prepared_records(checked: DataFrame, entity: str, provider: str = "catalog") -> DataFrame:
    """Checked records in their flat shape with blocks and hashes."""
    records = normalize(checked, entity)
    if entity == "releases":
        records = attach_blocks(records, provider=provider)
    return E.with_hash(records)


def quality_tables(parts: list[Prepared]) -> dict[str, DataFrame]:
    """The inputs of ``report.render`` over several entities. A text lists up to 1,000 ids of a reason; all are in the flagged output."""
    union = lambda frames: reduce(lambda a, b: a.unionByName(b), frames)
    return {
        "totals": report.record_totals(union([p.parsed.select("data_type") for p in parts])),
        "violations": report.violation_counts(union([violations_long(p.checked, "data_type") for p in parts])),
        "skips": report.skip_counts(union([p.skipped.select("data_type", "id", "_skip") for p in parts]), 1000),
        "repairs": report.repair_counts(union([p.checked.select("data_type", "actions") for p in parts])),
    }


@contextmanager
def watched(sent: Callable[[], int], every: int, save: Callable[[int], None]) -> Iterator[None]:
    """Calls ``save`` with the count whenever it has grown by ``every`` while the block runs."""
    ended = Event()

    def look() -> None:
        last = 0
        while not ended.wait(0.5):
            if (now := sent()) - last >= every:
                last = now
                save(last)

    thread = Thread(target=look, daemon=True)
    thread.start()
    try:
        yield
    finally:
        ended.set()
        thread.join()


def process_file(
    spark: SparkSession, path: str, out: str, policy: Policy | None = None, config: Config | None = None, publish: E.Send | None = None,
    on_progress: Callable[[int], None] | None = None, desk: Desk | None = None,
) -> tuple[str, int, int]:
    """Read one dump, write its events (and flagged records under a policy), then its completion.

    Returns (entity, records that the parser read, events). Records under the policy are written once below
    ``out/_work`` for all outputs, and removed at the end, also of one that fails; the completion event follows the data.
    With ``publish``, events go to the adapter in batches and at the rate of ``config``, not to files; files that share a
    ``desk`` share its rate.
    """
    config = config or Config()
    entity = spark.range(1).select(F.regexp_extract(F.lit(path), NAME, 3)).head()[0]
    if not entity:
        raise ValueError(f"{path} is no dump file")
    if publish and desk is None:
        with Desk.of(spark, config.rate) as own_desk:
            return process_file(spark, path, out, policy, config, publish, on_progress, own_desk)
    work = f"{out}/_work/{uuid.uuid4().hex}"
    try:
        return _processed(spark, path, entity, out, work, policy, config, publish, on_progress or (lambda n: None), desk)
    finally:
        E.removed(spark, work)


def _kept(df: DataFrame, path: str, trees: tuple[str, ...] = ("data",)) -> DataFrame:
    """``df`` written and read back, records as JSON in between."""
    df.withColumns({c: F.to_json(F.to_variant_object(c)) for c in trees}).write.parquet(path)
    return df.sparkSession.read.parquet(path).withColumns({c: F.parse_json(c).cast("map<string,variant>") for c in trees})


def _processed(spark, path, entity, out, work, policy, config, publish, on_progress, desk) -> tuple[str, int, int]:
    parsed = _kept(read_dump(spark, path, entity, capture_raw=policy is not None, budget=config.fault_budget), f"{work}/raw")
    if check_faults(parsed, None):
        E.append(rejects(parsed), f"{out}/rejected", "data_type", "json")  # also of a file that is refused now
        check_faults(parsed, config.fault_budget)
    own = prepare(parsed, entity, policy, config.provider)
    if policy is not None:  # every output below reads what the policy left, which is evaluated here only
        own = replace(own, checked=_kept(own.checked, f"{work}/checked"), skipped=_kept(own.skipped, f"{work}/skipped"))
        own = replace(own, records=prepared_records(own.checked, entity, config.provider))
    total = own.parsed.count()
    data = E.data_events(own.records)
    if publish:
        data.write.parquet(f"{work}/events")  # made once, so that ranges are the same when they are tried again
        ready, job = spark.read.parquet(f"{work}/events"), uuid.uuid4().hex
        tasks = max(spark.sparkContext.defaultParallelism, -(-total // config.checkpoint_every))
        try:
            with watched(lambda: desk.sent(job), config.checkpoint_every, on_progress):
                sent = publish_frames(ready, publish, config.batch_size, None, config.prefix, tasks, desk=desk, job=job)
        finally:
            desk.forget(job)
    else:
        seen = Observation()
        E.write_events(data.observe(seen, F.count(F.lit(1)).alias("n")), f"{out}/events", config.prefix)
        sent = seen.get["n"]
    if policy is not None:
        long = violations_long(own.checked, "data_type", "id", "file")
        E.write_lines(E.violation_lines(long), f"{out}/flagged/violations")
        E.write_lines(E.skip_lines(own.skipped), f"{out}/flagged/skipped")
        flagged = long.select("data_type", "id", "severity").unionByName(own.skipped.select("data_type", "id", F.lit(None).cast("string").alias("severity")))
        E.append(E.captures(own.parsed, flagged), f"{out}/flagged/captures", "data_type", "json")
        text = report.render(**quality_tables([own]))
        E.write_text(spark, f"{out}/flagged/report_{entity}.txt", text)
        if report.has_findings(text):
            LOG.warning("%s", text)
    done = spark.createDataFrame([(path, entity, total)], "file string, data_type string, records long")
    _complete(E.file_complete_events(done), out, config, publish)
    return entity, total, sent


def _complete(events: DataFrame, out: str, config: Config, publish: E.Send | None) -> None:
    if publish:
        E.publish_completion(events, publish, config.prefix)
    else:
        E.write_events(events, f"{out}/events", config.prefix)


def run_manifest(spark: SparkSession, manifest: str, out: str, config: Config | None = None, publish: E.Send | None = None, **options) -> tuple[str, int, int]:
    """The file that a manifest names, and the completion of the whole extraction."""
    own = read_manifest(spark, manifest)
    started = F.lit(datetime.now(UTC))
    entity, total, sent = process_file(spark, own.path, out, config=config, publish=publish, **options)
    counts = spark.createDataFrame([(entity, total)], "data_type string, records long")
    _complete(E.extraction_complete_events(report.record_counts(counts), own.version, started), out, config or Config(), publish)
    return entity, total, sent


class FilesFailed(RuntimeError):
    """``errors`` by file name, and the counts of files that were ``done``."""

    def __init__(self, errors: dict[str, Exception], done: dict[str, int]):
        super().__init__("; ".join(f"{name}: {type(e).__name__}: {e}" for name, e in sorted(errors.items())))
        self.errors, self.done = errors, done


class _Held:
    """A marker that several threads change and save, one at a time."""

    def __init__(self, spark: SparkSession, folder: str, marker: Marker):
        self.spark, self.folder, self.marker, self.lock = spark, folder, marker, Lock()

    def __call__(self, change: Callable[[Marker], None] = lambda m: None) -> None:
        with self.lock:
            change(self.marker)
            save_marker(self.spark, self.folder, self.marker)


def _side_by_side(spark: SparkSession, work: dict[str, Callable[[], int]], workers: int) -> tuple[dict[str, int], dict[str, Exception]]:
    """Results and errors of jobs that run in threads, each in a scheduler pool of its own: under FAIR scheduling
    (``spark.scheduler.mode``) their tasks take turns. Jobs carry the tag ``dumpmill:<name>``, by which one can be interrupted."""
    done, errors = {}, {}

    def run(name: str) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        spark.sparkContext.addJobTag(f"dumpmill:{name}")
        try:
            if (result := work[name]()) is not None:
                done[name] = result
        except Exception as e:  # noqa: BLE001  other files go on
            LOG.error("%s: %s", name, e)
            errors[name] = e
        finally:
            spark.sparkContext.removeJobTag(f"dumpmill:{name}")
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max(1, workers)) as pool:
        list(pool.map(run, work))
    return done, errors


def run_version(
    spark: SparkSession, paths: list[str], version: str, out: str, state: str, force: bool = False, config: Config | None = None,
    publish: E.Send | None = None, stop: Callable[[], bool] = lambda: False, **options,
) -> dict[str, int]:
    """All dumps of a version, ``config.workers`` files side by side, with a marker in ``state``.

    Landed files are hashed first; a completed file whose bytes are others now is processed again, also in a
    version that was complete. A file is completed after its data and its completion event; the marker is closed
    after the event that ends the extraction. A file that fails does not hold up the others: the marker keeps them, says which
    failed, and FilesFailed is raised at the end; the next run takes what is open. ``stop`` is asked before each file: files
    under way are finished then, others stay open, and the version is not closed. With an adapter all files share the rate.
    """
    config = config or Config()
    marker = load_marker(spark, state, version)
    decision = marker.decide(force)
    if decision == REPROCESS:
        marker = type(marker)(version)
    names = {p.rsplit("/", 1)[-1]: p for p in paths}
    held = _Held(spark, state, marker)
    if decision != SKIP:
        held(lambda m: m.phases["download"].start())
    hashes, errors = {}, {}

    def hashed(name: str) -> int:
        hashes[name] = stream_sha256(spark, names[name])
        return 0

    _, errors = _side_by_side(spark, {name: lambda name=name: hashed(name) for name in names}, config.workers)
    if errors:
        held(lambda m: m.phases["download"].finish(str(FilesFailed(errors, {}))))
        raise FilesFailed(errors, {})
    changed = [name for name in names if marker.file_verified(name, hashes[name])]
    if decision == SKIP and not changed:
        return {}

    def begin(m: Marker) -> None:
        m.phases["download"].finish()
        m.phases["processing"].start()

    held(begin)
    stopped = Event()

    def one(name: str, desk: Desk | None) -> int | None:
        if stopped.is_set() or stop():
            stopped.set()
            return None
        held(lambda m: m.start_file(name))
        try:
            _, total, sent = process_file(spark, names[name], out, config=config, publish=publish, desk=desk, on_progress=lambda n: held(lambda m: m.advance_file(name, n)), **options)
        except Exception as e:
            text = f"{type(e).__name__}: {e}"
            held(lambda m: m.fail_file(name, text))
            raise
        held(lambda m: m.complete_file(name, total, sent))
        return total

    desk = Desk.of(spark, config.rate) if publish else None
    try:
        done, errors = _side_by_side(spark, {name: lambda name=name: one(name, desk) for name in marker.pending(list(names))}, config.workers)
    finally:
        if desk is not None:
            desk.__exit__()
    if errors:
        failed = FilesFailed(errors, done)
        held(lambda m: m.phases["processing"].finish(str(failed)))
        raise failed
    if stopped.is_set():
        return done
    rows = [(name.rsplit("_", 1)[-1].split(".")[0], f.records) for name, f in marker.files.items()]
    counts = spark.createDataFrame(rows, "data_type string, records long")
    started = F.to_timestamp(F.lit(marker.started_at))
    _complete(E.extraction_complete_events(report.record_counts(counts), version, started), out, config, publish)
    held(lambda m: m.complete())
    return done


def run_latest(spark: SparkSession, source: Source, out: str, state: str, **options) -> dict[str, int]:
    """``run_version`` of a source's newest complete version; nothing where it has none."""
    if (version := source.latest()) is None:
        return {}
    return run_version(spark, source.paths(version), version, out, state, **options)
