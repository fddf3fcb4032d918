"""Tables published in one step, and runs that go on where they stopped.

Under a root folder every table has a folder of versions. One small file, the pointer, says which
version of each table is the published one. A run writes its tables beside the published ones and
then replaces the pointer by a rename, so a reader sees all of the old or all of the new tables,
and a failed run leaves the old ones. A ledger of finished steps lets a rerun under the same name
skip them. One run at a time publishes under a root.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

_POINTER = "_published.json"
#: Publications whose versions ``vacuum`` keeps besides the current one.
KEPT = 2


def _files(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), location


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file, None if there is none."""
    files, location = _files(spark, path)
    if not files.exists(location):
        return None
    stream = files.open(location)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside ``path`` and rename it over it: readers find the old content or the new."""
    beside = f"{path}.{uuid.uuid4().hex}"
    files, location = _files(spark, beside)
    stream = files.create(location, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    jvm = spark._jvm
    rename = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    rename[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    target = files.makeQualified(jvm.org.apache.hadoop.fs.Path(path))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsparkSession.sessionState().newHadoopConf())
    context.rename(files.makeQualified(location), target, rename)


def replace_folder(df: DataFrame, path: str) -> None:
    """Write ``df`` beside ``path``, then put it in its place by renames: a failed write leaves the old table."""
    spark = df.sparkSession
    mark = uuid.uuid4().hex
    new, old = f"{path.rstrip('/')}.new-{mark}", f"{path.rstrip('/')}.old-{mark}"
    df.write.parquet(new)
    files, target = _files(spark, path)
    paths = {x: spark._jvm.org.apache.hadoop.fs.Path(x) for x in (new, old)}
    held = files.exists(target)
    if held and not files.rename(target, paths[old]):
        raise OSError(f"cannot move {path} away")
    if not files.rename(paths[new], target):
        if held:
            files.rename(paths[old], target)
        raise OSError(f"cannot put a table at {path}")
    if held:
        files.delete(paths[old], True)


def _pointer(spark: SparkSession, root: str) -> dict:
    text = read_text(spark, f"{root.rstrip('/')}/{_POINTER}")
    return json.loads(text) if text else {"version": 0, "tables": {}, "earlier": []}


def published(spark: SparkSession, root: str) -> dict[str, str]:
    """Paths of the published tables by name."""
    return _pointer(spark, root)["tables"]


def publications(spark: SparkSession, root: str) -> int:
    """How often something was published under ``root``."""
    return _pointer(spark, root)["version"]


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The published version of a table; a later publication does not change this DataFrame."""
    return spark.read.parquet(published(spark, root)[name])


def publish(spark: SparkSession, root: str, tables: dict[str, str]) -> int:
    """Make the written ``tables`` (paths by name) the published ones, all at once; others stay. Gives the new version number."""
    now = _pointer(spark, root)
    new = {"version": now["version"] + 1, "tables": {**now["tables"], **tables}, "earlier": [now["tables"], *now["earlier"]][:KEPT]}
    replace_text(spark, f"{root.rstrip('/')}/{_POINTER}", json.dumps(new))
    return new["version"]


class Run:
    """A named run of steps, each of which writes one table.

    A finished step is entered in the ledger, with the path of its table. A run under the same name
    takes finished steps from there, also in another session; what an unfinished step has written
    is not referred to by anything. After its publication a name starts anew.
    """

    def __init__(self, spark: SparkSession, root: str, name: str | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.name = name or uuid.uuid4().hex
        self.tables: dict[str, str] = {}
        self.skipped: list[str] = []

    def _entry(self, step: str) -> str:
        return f"{self.root}/_runs/{self.name}/{step}.json"

    def step(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The table of a step, from the ledger if it is there, else made and written now."""
        done = read_text(self.spark, self._entry(name))
        if done is None:
            path = f"{self.root}/{name}/{uuid.uuid4().hex}"
            make().write.parquet(path)
            replace_text(self.spark, self._entry(name), json.dumps({"path": path}))
        else:
            path = json.loads(done)["path"]
            self.skipped.append(name)
        self.tables[name] = path
        return self.spark.read.parquet(path)

    def publish(self) -> dict[str, str]:
        """Publish the tables of all steps and close the ledger."""
        publish(self.spark, self.root, self.tables)
        self.forget()
        return dict(self.tables)

    def forget(self) -> None:
        """Drop the ledger, so that the next run of this name makes every step again."""
        files, location = _files(self.spark, f"{self.root}/_runs/{self.name}")
        files.delete(location, True)


def vacuum(spark: SparkSession, root: str, names: Iterable[str]) -> int:
    """Remove versions of the named tables that neither the pointer, its last ``KEPT`` publications nor an open ledger refers to."""
    root = root.rstrip("/")
    now = _pointer(spark, root)
    used = {path for tables in (now["tables"], *now["earlier"]) for path in tables.values()}
    files, runs = _files(spark, f"{root}/_runs")
    if files.exists(runs):
        for run in files.listStatus(runs):
            for entry in files.listStatus(run.getPath()):
                text = read_text(spark, entry.getPath().toString()) if entry.getPath().getName().endswith(".json") else None
                used |= {json.loads(text)["path"]} if text else set()
    kept = {spark._jvm.org.apache.hadoop.fs.Path(path).toUri().getPath() for path in used}
    removed = 0
    for name in names:
        _, folder = _files(spark, f"{root}/{name}")
        for version in files.listStatus(folder) if files.exists(folder) else ():
            if version.getPath().toUri().getPath() not in kept:
                files.delete(version.getPath(), True)
                removed += 1
    return removed
