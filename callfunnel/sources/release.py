"""Releases: a publication is seen whole or not at all, and rewrites only the weeks that changed.

Everything is written into a new folder `<root>/releases/<id>`; only then is `<root>/CURRENT`
replaced, by one rename, with a manifest that names the release and, for every week, the release
that holds it. A failed run leaves the manifest as it was, and readers go on seeing the release before. The folder
that the manifest named last is kept for readers that have it open; older ones that no week needs are deleted.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "CURRENT"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


@dataclass
class Release:
    """One publication: week -> (digest of its calls, release that holds it); table -> (schema, weekly or not)."""

    root: str
    id: str
    weeks: dict[str, tuple[str, str]] = field(default_factory=dict)
    tables: dict[str, tuple[str, bool]] = field(default_factory=dict)
    before: str | None = None

    def folder(self, release: str | None = None) -> str:
        return f"{self.root}/releases/{release or self.id}"

    def table(self, spark: SparkSession, name: str, weeks: set[str] | None = None) -> DataFrame:
        """A published table, or the given weeks of a weekly one; each release's part is read by its partitions."""
        layout, weekly = self.tables[name]
        schema = T.StructType.fromJson(json.loads(layout))
        if not weekly:
            return spark.read.schema(schema).parquet(f"{self.folder()}/tables/{name}")
        out = spark.createDataFrame([], schema)
        for release in sorted({r for _, r in self.weeks.values()}):
            mine = [w for w, (_, r) in self.weeks.items() if r == release and (weeks is None or w in weeks)]
            path = f"{self.folder(release)}/tables/{name}"
            if mine and _fs(spark, path).exists(_path(spark, path)):
                out = out.unionByName(spark.read.schema(schema).parquet(path).filter(F.col("wk").isin(mine)))
        return out


def current(spark: SparkSession, root: str) -> Release | None:
    """The published release, None before the first."""
    root = root.rstrip("/")
    path = _path(spark, f"{root}/{MANIFEST}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    held = json.loads(text)
    return Release(root, held["id"], {w: tuple(v) for w, v in held["weeks"].items()}, {n: tuple(v) for n, v in held["tables"].items()}, held["before"])


def begin(spark: SparkSession, root: str) -> Release:
    """A release to be written; nobody sees it before `switch`."""
    return Release(root.rstrip("/"), f"{int(time.time())}-{uuid.uuid4().hex[:12]}")


def switch(spark: SparkSession, release: Release) -> None:
    """Make the written release the current one, by one rename, then delete folders that nothing names."""
    old = current(spark, release.root)
    release.before = old.id if old else None
    text = json.dumps({"id": release.id, "weeks": release.weeks, "tables": release.tables, "before": release.before})
    jvm, fs = spark._jvm, _fs(spark, release.root)
    draft = _path(spark, f"{release.root}/{MANIFEST}.{release.id}")
    stream = fs.create(draft, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri() if draft.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration())
    over = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = over
    context.rename(fs.makeQualified(draft), fs.makeQualified(_path(spark, f"{release.root}/{MANIFEST}")), options)
    needed = {release.id, release.before, *(r for _, r in release.weeks.values())}
    if old:
        needed |= {r for _, r in old.weeks.values()}
    for status in fs.listStatus(_path(spark, f"{release.root}/releases")):
        if status.getPath().getName() not in needed and status.getPath().getName() < release.id:
            fs.delete(status.getPath(), True)


def week_digests(calls: DataFrame) -> dict[str, str]:
    """Per week the number of its calls and the sum of their hashes, whatever their order; a row a week."""
    h = F.xxhash64(*sorted(calls.columns)).cast("decimal(38,0)")
    return {r["wk"]: f"{r['n']}:{r['s']}" for r in calls.groupBy("wk").agg(F.count(F.lit(1)).alias("n"), F.sum(h).alias("s")).collect()}


# ---------------------------------------------------------------- one file of many parts
def join_parts(spark: SparkSession, folder: str, target: str) -> int:
    """One file `target` of a folder's part files in order; its size in bytes.

    Where a part begins is the sum of the sizes before it. A file system that can concatenate does
    so without copying; in a shared folder every part is copied to its place by a task of its own.
    The target appears under its name once it is whole.
    """
    fs = _fs(spark, folder)
    parts = sorted(((s.getPath().toString(), s.getLen()) for s in fs.listStatus(_path(spark, folder)) if s.getPath().getName().startswith("part-")))
    starts, size = [], 0
    for _, n in parts:
        starts.append(size)
        size += n
    draft = f"{target}.draft"
    if fs.getScheme() == "file":
        local = lambda p: _path(spark, p).toUri().getPath()
        with open(local(draft), "wb") as f:
            f.truncate(size)
        _copy_parts(spark, [(local(p), n, s) for (p, n), s in zip(parts, starts) if n], local(draft))
        fs.rename(_path(spark, draft), _path(spark, target))
        return size
    _concatenate(spark, fs, [p for p, n in parts if n], target)
    return size


def _copy_parts(spark: SparkSession, parts: list[tuple[str, int, int]], target: str, chunk: int = 1 << 22) -> None:
    def run(frames):
        for frame in frames:
            for path, size, start in zip(frame["path"], frame["size"], frame["start"]):
                with open(path, "rb") as source, open(target, "r+b") as out:
                    out.seek(int(start))
                    while data := source.read(chunk):
                        out.write(data)
            yield frame[["size"]]

    if parts:
        rows = spark.createDataFrame(parts, "path string, size long, start long").repartition(min(len(parts), 1000))
        copied = rows.mapInPandas(run, "size long").agg(F.sum("size")).first()[0]
        if copied != sum(n for _, n, _ in parts):
            raise RuntimeError("parts changed while they were joined")


def _concatenate(spark, fs, parts: list[str], target: str) -> None:
    """By the file system itself, which moves blocks of the parts behind the first; one that can't raises."""
    first, rest = parts[0], parts[1:]
    if rest:
        paths = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(rest))
        for k, p in enumerate(rest):
            paths[k] = _path(spark, p)
        fs.concat(_path(spark, first), paths)
    fs.rename(_path(spark, first), _path(spark, target))
