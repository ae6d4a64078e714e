"""Watching folders: listings of what is new or changed, read on the executors; two-tier stages, progress callbacks."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQueryListener

from lodestone.operators.graph import shared_folder

SUFFIXES = ".vex,.vfl,.h,.md,.txt,.json"


class Listing:
    """Which files of a folder are known, as a log of listings: log/n holds the files that were new or changed at the n-th one, log/snapshot-n all that were known then.

    An offset is the number of a listing, so what lies between two offsets is read from the log, the same after a restart as before. Folders may be paths
    or URIs of any file system that pyarrow opens.
    """

    KEEP = 16  # listings before they are folded into a snapshot

    def __init__(self, options: dict[str, str]) -> None:
        self.options = dict(options)
        self.suffixes = tuple(options.get("suffixes", SUFFIXES).split(","))
        self.files, self.folder = fs.FileSystem.from_uri(options["path"])
        self.logs, self.log = fs.FileSystem.from_uri(options["log"])
        self.number, self.known = -1, {}

    def _names(self) -> list[str]:
        return [x.base_name for x in self.logs.get_file_info(fs.FileSelector(self.log, allow_not_found=True)) if not x.base_name.startswith(".")]

    def _read(self, name: str) -> list:
        with self.logs.open_input_stream(f"{self.log}/{name}") as f:
            return json.loads(f.read())

    def _write(self, name: str, rows: list) -> None:
        beside = f"{self.log}/.{name}.{uuid.uuid4().hex}"
        with self.logs.open_output_stream(beside) as f:
            f.write(json.dumps(rows).encode())
        self.logs.move(beside, f"{self.log}/{name}")  # a listing is there as a whole or not at all

    def recall(self) -> None:
        """What the log knows."""
        names = self._names()
        snapshots = [int(n[9:]) for n in names if n.startswith("snapshot-")]
        self.number = max(snapshots, default=-1)
        self.known = {p: (t, n) for p, t, n, _ in self._read(f"snapshot-{self.number}")} if snapshots else {}
        for n in sorted(int(n) for n in names if n.isdigit()):
            if n > self.number:
                self.number = n
                self.known |= {p: (t, size) for p, t, size, _ in self._read(str(n))}

    def begin(self, existing: bool) -> None:
        """The first listing, unless the log has one: files that are there do not count, unless they are to."""
        self.recall()
        if self.number < 0:
            self.logs.create_dir(self.log)
            self._write("snapshot-0", [] if existing else [[p, t, n, "known"] for p, (t, n) in sorted(self._there().items())])
            self.recall()

    def _there(self) -> dict[str, tuple[int, int]]:
        found = self.files.get_file_info(fs.FileSelector(self.folder, recursive=True))
        return {x.path: (x.mtime_ns // 1000, x.size) for x in found if x.is_file and x.base_name.endswith(self.suffixes)}

    def look(self) -> int:
        """Lists the folder; the number of the last listing that differed from what was known."""
        if self.number < 0:
            self.recall()
        new = [[p, *x, "modified" if p in self.known else "created"] for p, x in sorted(self._there().items(), key=lambda y: (y[1], y[0])) if self.known.get(p) != x]
        if new:
            self._write(str(self.number + 1), new)
            self.number += 1
            self.known |= {p: (t, n) for p, t, n, _ in new}
        return self.number

    def between(self, start: int, end: int) -> list[list]:
        return [x for n in range(start + 1, end + 1) for x in self._read(str(n))]

    def forget(self, end: int) -> None:
        """Folds listings up to one that has been read into a snapshot."""
        names = self._names()
        old = sorted(int(n) for n in names if n.isdigit() and int(n) <= end)
        if len(old) >= self.KEEP:
            last = max((int(n[9:]) for n in names if n.startswith("snapshot-")), default=-1)
            known = {p: [p, t, n, "known"] for p, t, n, _ in self._read(f"snapshot-{last}")}
            for n in old:
                known |= {p: [p, t, size, "known"] for p, t, size, _ in self._read(str(n))}
            self._write(f"snapshot-{end}", list(known.values()))
            for name in [*map(str, old), f"snapshot-{last}"]:
                self.logs.delete_file(f"{self.log}/{name}")


@dataclass
class _Files(InputPartition):
    files: list


class _Changes(DataSourceStreamReader):
    """Lists on the driver, reads on the executors."""

    def __init__(self, options: dict[str, str]) -> None:
        self.options = dict(options)
        self.listing: Listing | None = None

    def _log(self) -> Listing:
        if self.listing is None:
            self.listing = Listing(self.options)
        return self.listing

    def initialOffset(self) -> dict:  # noqa: N802
        self._log().begin(self.options.get("existing", "false").lower() == "true")
        return {"listing": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"listing": self._log().look()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        changes, size = self._log().between(start["listing"], end["listing"]), int(self.options.get("files", "64"))
        return [_Files(changes[at : at + size]) for at in range(0, len(changes), size)] or [_Files([])]

    def read(self, partition: _Files) -> Iterator[tuple]:
        files, _ = fs.FileSystem.from_uri(self.options["path"])
        for path, mtime, _, kind in partition.files:
            try:
                with files.open_input_stream(path, compression=None) as f:
                    yield path, mtime, kind, f.read().decode("utf-8", "replace")
            except FileNotFoundError:
                continue  # gone again

    def commit(self, end: dict) -> None:
        self._log().forget(end["listing"])

    def __getstate__(self) -> dict:
        return {"options": self.options, "listing": None}


class ListingSource(DataSource):
    """path, mtime (microseconds), kind (created, modified) and text of files below a folder whenever they appear or change."""

    @classmethod
    def name(cls) -> str:
        return "lodestone_listing"

    def schema(self) -> str:
        return "path string, mtime long, kind string, text string"

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: ANN001, N802
        return _Changes(self.options)


def watch(spark: SparkSession, folder: str, log: str | None = None, suffixes: str = SUFFIXES, existing: bool = False, files: int = 64) -> DataFrame:
    """path, mtime, kind, text, once for each file that appears and again for each change of it. Files that are there now do not count, unless existing.

    Folders are listed by the driver, texts are read by the executors, `files` in a partition, and never pass the driver. log: where listings are kept, a shared folder of one stream; by that
    name a restarted stream goes on where it was (none: a folder of its own, which a restart does not find). A file that changes between its listing and its reading is
    given as it then is, and again by the next listing.
    """
    if log is None:
        shared_folder(spark)
        log = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/listing-{uuid.uuid4().hex}"
        log = log.replace("file:/", "/", 1) if log.startswith("file:/") and not log.startswith("file://") else log
    Listing({"path": folder, "log": log, "suffixes": suffixes}).begin(existing)
    spark.dataSource.register(ListingSource)
    return spark.readStream.format("lodestone_listing").options(log=log, suffixes=suffixes, existing=str(existing).lower(), files=str(files)).load(folder)


def fresh_files(stream: DataFrame, since: Column | None = None) -> DataFrame:
    """A file stream (text, with _metadata) without the files that were there before a time (none: now)."""
    return stream.where(F.col("_metadata.file_modification_time") > (F.lit(time.time()).cast("timestamp") if since is None else since))


def two_tiers(tier_one: Callable[[DataFrame], DataFrame], flag: Column, tier_two: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[DataFrame], DataFrame]:
    """A stage: the first tier for all rows, the second for those that are not flagged; without one these are complete as they are. Column stage says which."""

    def run(rows: DataFrame) -> DataFrame:
        judged = tier_one(rows).withColumn("__flag", F.coalesce(flag, F.lit(False)))
        held = judged.where("__flag").drop("__flag").withColumn("stage", F.lit("validation"))
        passed = judged.where("not __flag").drop("__flag")
        return (tier_two(passed) if tier_two else passed).withColumn("stage", F.lit("complete")).unionByName(held, allowMissingColumns=True)

    return run


def telling(take: Callable[[DataFrame, int], None], path: str = "path", on_file: Callable[[str, int], None] | None = None, on_sample: Callable[[dict], None] | None = None) -> Callable[[DataFrame, int], None]:
    """A function for foreachBatch: take(batch, number), then on_file(path, rows) for each file of the batch and on_sample(row) for each row, a partition at a time on the driver."""

    def run(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            take(batch, number)
            if on_file:
                for r in batch.groupBy(path).count().toLocalIterator():
                    on_file(r[path], r["count"])
            if on_sample:
                for r in batch.toLocalIterator():
                    on_sample(r.asDict(recursive=True))
        finally:
            batch.unpersist()

    return run


class Callbacks(StreamingQueryListener):
    """Calls functions as streams go on: on_progress(rows of a batch, rows in all), on_error(message), on_complete(rows in all)."""

    def __init__(self, on_progress: Callable[[int, int], None] | None = None, on_error: Callable[[str], None] | None = None, on_complete: Callable[[int], None] | None = None) -> None:
        self.on_progress, self.on_error, self.on_complete, self.total = on_progress, on_error, on_complete, 0

    def onQueryStarted(self, event) -> None:  # noqa: ANN001, N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: ANN001, N802
        n = int(event.progress.numInputRows)
        self.total += n
        if self.on_progress:
            self.on_progress(n, self.total)

    def onQueryIdle(self, event) -> None:  # noqa: ANN001, N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: ANN001, N802
        if event.exception:
            if self.on_error:
                self.on_error(event.exception)
        elif self.on_complete:
            self.on_complete(self.total)


def observed(df: DataFrame, name: str, on_complete: Callable[[dict], None], *metrics: Column) -> DataFrame:
    """The frame, whose first action reports metrics (none: the number of rows) to a function in the background."""
    import threading

    from pyspark.sql import Observation

    seen = Observation(name)
    out = df.observe(seen, *(metrics or (F.count(F.lit(1)).alias("rows"),)))
    threading.Thread(target=lambda: on_complete(seen.get), daemon=True).start()
    return out
