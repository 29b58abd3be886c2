"""Day tables whose days are replaced all at once.

A table is a folder of Parquet files partitioned by day, as Spark writes it, and a list of
what counts, the manifest::

    <table>/date=2024-05-01/v00000012-1f3a...-00000-....parquet
    <table>/_manifests/00000012.json

A write appends files that carry its version in their names (no file is moved, so nothing
is copied on an object store) and then creates the next manifest, one small file, which
names the version of every day. That creation is the switch: readers that go by the newest
manifest see the whole old table before it and the whole new one after it, whenever the
writer stops. Files that the new manifest no longer names are deleted afterwards, so a
plain ``spark.read.parquet`` of the folder sees the same rows once a write has ended.

Each day's entry also holds the schema it was written with and what it was built from
(:mod:`shelfwise.jobs` compares the latter to find the days that a change upstream affects).

One writer at a time: of two that start from the same manifest, the second fails.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import hashlib
import json
import re
import uuid
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MANIFESTS = "_manifests"
# Days of tables that were written without a manifest: Spark's own file names.
UNMANAGED = "part"
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@dataclass(frozen=True)
class Day:
    """One day of a table: the version (file name prefix) that counts, how many files it has
    (0: the day was built and is empty), its schema and what it was built from."""

    version: str
    files: int
    schema: str
    built_from: str | None = None


@dataclass
class Manifest:
    number: int
    column: str
    days: dict[str, Day] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @staticmethod
    def from_json(text: str) -> Manifest:
        raw = json.loads(text)
        return Manifest(raw["number"], raw["column"], {d: Day(**x) for d, x in raw["days"].items()}, raw["schemas"])

    def between(self, start: dt.date | None, end: dt.date | None) -> dict[str, Day]:
        """Days of the range (ISO dates compare as text); without bounds, the NULL day as well."""
        low, high = (x.isoformat() if x else None for x in (start, end))
        return {d: x for d, x in sorted(self.days.items())
                if (low is None or low <= d) and (high is None or d <= high)}


class Folder:
    """A table's folder on whatever file system its path names."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm, self.path = spark._jvm, path.rstrip("/")
        self.root = self.at()
        self.fs = self.root.getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, *parts: str):
        return self.jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def listed(self, *parts: str) -> list:
        folder = self.at(*parts)
        return list(self.fs.listStatus(folder)) if self.fs.exists(folder) else []

    def day_folders(self, column: str) -> list[str]:
        names = (f.getPath().getName() for f in self.listed() if f.isDirectory())
        return sorted(n for n in names if n.startswith(f"{column}="))

    def data_files(self, folder: str) -> list:
        return [f for f in self.listed(folder) if f.isFile() and f.getPath().getName()[0] not in "._"]

    def written(self, column: str, version: str) -> dict[str, int]:
        """Files of ``version`` by day."""
        found: dict[str, int] = {}
        for f in self.fs.globStatus(self.at(f"{column}=*", f"{version}-*")) or []:
            day = f.getPath().getParent().getName().removeprefix(f"{column}=")
            found[day] = found.get(day, 0) + 1
        return found

    def manifest_numbers(self) -> list[int]:
        names = (f.getPath().getName() for f in self.listed(MANIFESTS))
        return sorted(int(n.removesuffix(".json")) for n in names if re.fullmatch(r"\d+\.json", n))

    def read_text(self, *parts: str) -> str:
        stream = self.fs.open(self.at(*parts))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, text: str, *parts: str) -> None:
        """Write a new file; an error if it exists."""
        stream = self.fs.create(self.at(*parts), False)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()


def manifest(spark: SparkSession, path: str) -> Manifest | None:
    """The newest whole manifest of a table, or None for a folder without any.

    One that is cut off (its writer stopped in it) was never switched to."""
    folder = Folder(spark, path)
    for number in reversed(folder.manifest_numbers()):
        try:
            return Manifest.from_json(folder.read_text(MANIFESTS, f"{number:08d}.json"))
        except ValueError:
            continue
    return None


def _schema_id(schema: str) -> str:
    return hashlib.sha1(schema.encode()).hexdigest()[:12]


def _commit(folder: Folder, new: Manifest) -> None:
    try:
        folder.create(new.to_json(), MANIFESTS, f"{new.number:08d}.json")
    except Py4JJavaError as exc:
        if "AlreadyExists" not in str(exc):
            raise
        raise RuntimeError(f"{folder.path}: another writer has switched to version {new.number}") from None


def _drop_superseded(folder: Folder, new: Manifest, days: set[str]) -> None:
    """Delete the files of ``days`` that the manifest does not name, then older manifests."""
    for day in sorted(days):
        name, kept = f"{new.column}={day}", new.days.get(day)
        files = folder.data_files(name)
        old = [f for f in files if not (kept and f.getPath().getName().startswith(f"{kept.version}-"))]
        if len(old) == len(files):
            folder.fs.delete(folder.at(name), True)
            continue
        for f in old:
            folder.fs.delete(f.getPath(), False)
    for number in folder.manifest_numbers():
        if number < new.number - 1:
            folder.fs.delete(folder.at(MANIFESTS, f"{number:08d}.json"), False)


@contextlib.contextmanager
def _shuffles_dropped(spark: SparkSession):
    """Writes in this block delete their shuffle files when they end, instead of when the
    driver happens to collect garbage: a job of several tables then needs disk for the largest
    write only. No plan outlives its write, so nothing reads those files again."""
    old = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(DROP_SHUFFLES) if old is None else spark.conf.set(DROP_SHUFFLES, old)


def replace_days(df: DataFrame | list[DataFrame], path: str, column: str, replace_all: bool = False, days: list[dt.date] | None = None,
                 start: dt.date | None = None, end: dt.date | None = None, built_from: dict[str, str] | None = None) -> None:
    """Write ``df`` and switch the table to it, day by day replaced.

    Days that ``df`` has are replaced. Days that it lacks go too: all with ``replace_all``,
    else those of ``days`` and, with a ``start`` or an ``end``, those of that range.
    ``built_from`` notes what each day was built from; its days are listed even without rows.

    Rows are rebalanced by day, which AQE splits by size, so a day gets files of about the
    advisory size and not one from each task.

    ``df`` can be a list: its frames are written one after the other, each of which deletes its
    shuffle files before the next, and switched together.
    """
    frames = df if isinstance(df, list) else [df]
    df = frames[0]
    spark = df.sparkSession
    folder = Folder(spark, path)
    old = manifest(spark, path)
    if old is None:
        listed = {n.removeprefix(f"{column}="): len(folder.data_files(n)) for n in folder.day_folders(column)}
        old = Manifest(0, column, {d: Day(UNMANAGED, n, "") for d, n in listed.items()})
    number = max([old.number, *folder.manifest_numbers()]) + 1
    version = f"v{number:08d}-{uuid.uuid4().hex[:12]}"
    with _shuffles_dropped(spark):
        for frame in frames:
            (frame.hint("rebalance", column).write.mode("append").option("mapreduce.output.basename", version)
             .partitionBy(column).parquet(path))

    written = folder.written(column, version)
    schema = T.StructType([f for f in df.schema.fields if f.name != column]).json()
    named = set(built_from or ())
    gone = set(old.days) if replace_all else {d.isoformat() for d in days or ()}
    if start or end:
        gone |= set(old.between(start, end))
    noted = built_from or {}
    kept = {d: x for d, x in old.days.items() if d not in gone | set(written) | named}
    new = {d: Day(version, written.get(d, 0), _schema_id(schema), noted.get(d)) for d in set(written) | named}
    whole = Manifest(number, column, kept | new)
    schemas = old.schemas | {_schema_id(schema): schema}
    whole.schemas = {x.schema: schemas[x.schema] for x in whole.days.values() if x.schema}
    _commit(folder, whole)
    _drop_superseded(folder, whole, (gone | set(written) | named) & (set(old.days) | set(written)))


def clean(spark: SparkSession, path: str) -> None:
    """Delete what stopped writers left: files that the newest manifest does not name."""
    found = manifest(spark, path)
    if found:
        folder = Folder(spark, path)
        _drop_superseded(folder, found, {n.removeprefix(f"{found.column}=") for n in folder.day_folders(found.column)})


def read_days(spark: SparkSession, path: str, found: Manifest, schema: T.StructType | None = None,
              start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """The rows of a manifest's days (only their files are listed); without ``schema``, that of the newest day."""
    if schema is None:
        newest = [x.schema for _, x in sorted(found.days.items()) if x.schema]
        schema = T.StructType([*T.StructType.fromJson(json.loads(found.schemas[newest[-1]])).fields,
                               T.StructField(found.column, T.DateType())]) if newest else T.StructType([])
    for _ in range(2):
        used = {d: x for d, x in found.between(start, end).items() if x.files}
        if not used:
            return spark.createDataFrame([], schema)
        root = path.rstrip("/")
        try:
            df = spark.read.schema(schema).option("basePath", root).parquet(
                *(f"{root}/{found.column}={d}/{x.version}-*" for d, x in used.items()))
            if len(df._jdf.inputFiles()) == sum(x.files for x in used.values()):
                return df
        except Exception:
            if manifest(spark, path).number == found.number:
                raise
        # A writer has replaced days since the manifest was read.
        found = manifest(spark, path)
    raise RuntimeError(f"{path}: files that the manifest names are missing")


def read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A table as its newest manifest has it, or a plain folder as it is."""
    found = manifest(spark, path)
    if found is None:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    return read_days(spark, path, found, schema)


def has_days(spark: SparkSession, path: str, column: str = "date") -> bool:
    """Whether a table has any day with rows."""
    found = manifest(spark, path)
    return any(x.files for x in found.days.values()) if found else bool(Folder(spark, path).day_folders(column))


def _state(files: list) -> str:
    """What a listing says about files: names, sizes and times."""
    seen = sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files)
    return hashlib.sha1(json.dumps(seen).encode()).hexdigest()[:16]


def day_states(spark: SparkSession, path: str, column: str) -> dict[str, str]:
    """For each day of a table a text that changes when the day does: its version or, in a
    folder that others write, the state of its files. Empty days are left out."""
    found = manifest(spark, path)
    if found:
        return {d: x.version for d, x in found.days.items() if x.files}
    folder = Folder(spark, path)
    states = {n.removeprefix(f"{column}="): folder.data_files(n) for n in folder.day_folders(column)}
    return {d: _state(files) for d, files in states.items() if files}


def day_bytes(spark: SparkSession, path: str, column: str) -> dict[str, int]:
    """The size of each day's files that count."""
    found, folder = manifest(spark, path), Folder(spark, path)
    versions = {d: f"{x.version}-" for d, x in found.days.items() if x.files} if found else None
    sizes = {}
    for name in folder.day_folders(column):
        day = name.removeprefix(f"{column}=")
        if versions is None or day in versions:
            sizes[day] = sum(f.getLen() for f in folder.data_files(name)
                             if versions is None or f.getPath().getName().startswith(versions[day]))
    return sizes


def state(spark: SparkSession, path: str) -> str:
    """The same for a file or a folder without days."""
    folder = Folder(spark, path)
    if not folder.fs.exists(folder.root):
        return ""
    return _state([f for f in folder.listed() if f.isFile() and f.getPath().getName()[0] not in "._"])
