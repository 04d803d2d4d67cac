"""Processing only new or changed records, with the target itself as the state.

Every output row holds the key and version of the source row it was made from.
What is pending is the source anti-joined against them. A new version of the
target becomes visible by one pointer file, so a run that dies leaves the last
published version in force and the next run finds the same rows pending.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cernido.operators.snapshots import CHAIN, listed_files
from cernido.tables import written


def pending(source: DataFrame, state: DataFrame, key: list[str], version: str) -> DataFrame:
    """The rows of ``source`` whose key and version the state doesn't hold.

    Keys compare null-safe; a null version is unknown and always pending.
    Columns of ``state`` beyond key and version are ignored. An empty state
    makes every row pending, an empty source none. Ties and repeated rows stay
    as they are: what is pending twice in the source comes twice.
    """
    marks = {c: f"__state_{i}" for i, c in enumerate([*key, version])}
    held = state.filter(F.col(version).isNotNull()).select(*[F.col(c).alias(m) for c, m in marks.items()])
    same = [F.col(c).eqNullSafe(F.col(marks[c])) for c in key]
    return source.join(held, [*same, F.col(version) == F.col(marks[version])], "left_anti")


class TargetState:
    """A target of immutable folders and one pointer file for each version.

    A version is a manifest: which folder holds each bucket of keys. ``publish``
    writes the changed buckets under a name that no other attempt has and then
    creates the pointer ``CURRENT-<n>``, which must not exist yet: readers see
    the old version or the new one, a second writer is refused and has touched
    nothing that is published. Folders that no pointer names are leftovers of
    failed runs and are ignored. Needs a file system whose rename refuses an
    existing target (HDFS); on a local one the pointer is a hard link.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._hadoop(self.path).getFileSystem(self._conf)

    def _hadoop(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def current(self) -> int:
        """The number of the current version, 0 before the first."""
        root = self._hadoop(self.path)
        if not self._fs.exists(root):
            return 0
        names = [s.getPath().getName() for s in self._fs.listStatus(root)]
        return max([int(n.split("-")[1]) for n in names if n.startswith("CURRENT-")], default=0)

    def manifest(self, number: int) -> dict:
        """{"schema", "key", "folders": bucket -> folder} of a version."""
        stream = self._fs.open(self._hadoop(f"{self.path}/CURRENT-{number}"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def read(self, number: int | None = None, only: list[int] | None = None) -> DataFrame | None:
        """A version's rows, the current one's if none is named; null before the
        first. ``only``: the rows of these buckets."""
        number = self.current() if number is None else number
        if not number:
            return None
        kept = self.manifest(number)
        schema = T.StructType.fromJson(kept["schema"])
        folders = [f"{self.path}/{f}" for b, f in sorted(kept["folders"].items()) if only is None or int(b) in only]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def bucket(self, key: list[str]) -> Column:
        return F.pmod(F.xxhash64(*key), F.lit(self.buckets)).cast("int")

    def publish(self, rows: DataFrame, key: list[str], before: int | None = None, replace: list[int] | None = None) -> int:
        """Writes ``rows`` as the next version; with ``replace`` they are the new
        content of these buckets and the others stay as they are. Fails if
        another writer published after ``before`` was read."""
        before = self.current() if before is None else before
        folders = {} if replace is None or not before else {b: f for b, f in self.manifest(before)["folders"].items() if int(b) not in replace}
        attempt = f"data-{before + 1}-{uuid.uuid4().hex}"
        place = f"{self.path}/{attempt}"
        rows.withColumn("__bucket", self.bucket(key)).repartition("__bucket").write.partitionBy("__bucket").parquet(place)
        made = [s.getPath().getName() for s in self._fs.listStatus(self._hadoop(place))]
        folders |= {n.split("=")[1]: f"{attempt}/{n}" for n in made if n.startswith("__bucket=")}
        self._point(before + 1, json.dumps({"schema": json.loads(rows.schema.json()), "key": key, "folders": folders}))
        return before + 1

    def _point(self, number: int, text: str) -> None:
        temporary, final = f"{self.path}/.pointer-{uuid.uuid4().hex}", f"{self.path}/CURRENT-{number}"
        out = self._fs.create(self._hadoop(temporary), False)
        out.write(bytearray(text.encode()))
        out.close()
        refused = RuntimeError(f"version {number} of {self.path} was published by another run")
        if self._fs.getUri().getScheme() == "file":
            try:
                os.link(self._hadoop(temporary).toUri().getPath(), self._hadoop(final).toUri().getPath())
            except FileExistsError:
                raise refused from None
            finally:
                self._fs.delete(self._hadoop(temporary), False)
        elif not self._fs.rename(self._hadoop(temporary), self._hadoop(final)):
            self._fs.delete(self._hadoop(temporary), False)
            raise refused


def run_incremental(
    source: DataFrame,
    target: TargetState,
    key: list[str],
    version: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """One run: process what is pending, replace the changed keys, publish.

    ``transform`` must keep the key and version columns; it runs once, its rows
    are written. Only the buckets that hold changed keys are written anew: the
    driver takes their numbers, of which there are as many as the target has
    buckets. Returns the rows of this run, as published. Running again without
    new rows publishes nothing.
    """
    before = target.current()
    state = target.read(before)
    made = written(transform(source if state is None else pending(source, state, key, version)), "made")
    if state is None:
        target.publish(made, key, before)
        return made
    touched = [r[0] for r in made.select(target.bucket(key)).distinct().collect()]
    if touched:
        same = [F.col(f"s.{c}").eqNullSafe(F.col(f"m.{c}")) for c in key]
        old = target.read(before, touched)
        kept = old.alias("s").join(made.select(*key).distinct().alias("m"), same, "left_anti")
        target.publish(kept.unionByName(made, allowMissingColumns=True), key, before, touched)
    return made


def replay_new_or_changed(files: DataFrame, runs: DataFrame) -> DataFrame:
    """(run_id, file_id) pending for each completed run, as of that run.

    Replays all runs in one pass. The target after run i holds, for each
    (chain, source_uri), the version of the latest run up to i that lists it;
    such a state row is in force until the next run that lists the same uri. So
    each state row is stamped with the run that meets it and the source rows
    are anti-joined against key, version and stamp. The window needs only the
    rows of one uri of one chain, so a hot scope splits over its files. Key and
    version are shuffled as hashes: 128 bits of the key, 64 of the version,
    which is compared within a key only.
    """
    listed = listed_files(files, runs).select(
        "run_id", "file_id", "seq", F.xxhash64(*CHAIN, "source_uri").alias("key_1"), F.xxhash64("source_uri", *CHAIN).alias("key_2"),
        F.when(F.col("content").isNotNull(), F.xxhash64("content")).alias("version"),
    )
    key = ["key_1", "key_2"]
    # the next run of the uri: the seq before this one in falling order, carried over equal ones
    falling = Window.partitionBy(*key).orderBy(F.desc("seq"))
    after = F.lag("seq").over(falling)
    state = listed.select(*key, "seq", "version").withColumn("after", F.when(after != F.col("seq"), after))
    met_by = F.last("after", ignorenulls=True).over(falling.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    state = state.withColumn("seq", met_by).filter("seq is not null").drop("after")
    return pending(listed, state, [*key, "seq"], "version").select("run_id", "file_id")


def publish_in_waves(files: DataFrame, runs: DataFrame, target: TargetState, waves: int = 3) -> DataFrame:
    """(chain columns, source_uri, content): the published target after the completed
    runs went through ``run_incremental`` in so many waves by completion time.

    The source of a wave is, for each (chain, source_uri), the row of its latest
    run; of several in one run the greatest content counts, unknown last. An
    attempt that fails before its pointer is made leaves no trace.
    """
    listed = written(listed_files(files, runs).select(*CHAIN, "source_uri", "content", "completed_at", "seq"), "listed")
    first, last = listed.agg(F.unix_micros(F.min("completed_at")), F.unix_micros(F.max("completed_at"))).first()
    key = [*CHAIN, "source_uri"]
    for wave in range(1, waves + 1):
        if first is None:
            break
        until = first + (last - first) * wave // waves
        now = listed.filter(F.unix_micros("completed_at") <= until)
        newest = now.groupBy(*key).agg(F.max(F.struct("seq", "content")).alias("newest")).select(*key, "newest.content")
        run_incremental(newest, target, key, "content")
    state = target.read()
    return listed.select(*key, "content").limit(0) if state is None else state.select(*key, "content")
