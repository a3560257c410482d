"""Tables in versions: data folders and commit pointers that readers resolve.

    <table>/_data/<label>-<id>/...        written once, never changed
    <table>/_commits/000000000007.json    which folders are version 7

A version is a set of parts (one for a plain table, one for each day of a
staged table), each with its folder and what is known about it (rows, key
range, profile). A writer puts new folders beside the old ones and then moves
a complete pointer file into place under the next number, without replacing
one: the move is the commit. A write that stops half-way leaves folders that
no pointer names, and the table as it was. Of two writers that started
from one version the second fails and may start again. Readers take the newest
pointer; a plan made over a version goes on reading its folders after
later commits, until ``vacuum`` removes versions by age.

A pointer is a small file (one entry for each part), read and written by the
driver; rows go through Spark's readers and writers alone.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

COMMITS, DATA = "_commits", "_data"


class CommitConflict(RuntimeError):
    """Another writer committed since this one read the table."""


@dataclass(frozen=True)
class Commit:
    number: int
    written_at: str
    parts: dict = field(default_factory=dict)
    meta: dict = field(default_factory=dict)


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    # -- files of the driver ---------------------------------------------------------

    def _at(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    @property
    def _fs(self):
        return self._at().getFileSystem(self._conf)

    def _numbers(self) -> list[int]:
        where = self._at(COMMITS)
        if not self._fs.exists(where):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(where)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _load(self, number: int) -> Commit:
        stream = self._fs.open(self._at(COMMITS, f"{number:012d}.json"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Commit(**json.loads(text))

    def exists(self) -> bool:
        return bool(self._numbers())

    def current(self) -> Commit | None:
        numbers = self._numbers()
        return self._load(numbers[-1]) if numbers else None

    # -- writing ---------------------------------------------------------------------

    def new_folder(self, label: str = "t") -> str:
        """A folder, relative to the table, for the files of one write."""
        return f"{DATA}/{label}-{uuid.uuid4().hex}"

    def full(self, folder: str) -> str:
        return f"{self.path}/{folder}"

    def commit(self, parts: dict, meta: dict | None = None, after: Commit | None = None) -> Commit:
        """Make ``parts`` the version after ``after`` (None: the first one)."""
        new = Commit((after.number if after else 0) + 1, dt.datetime.now(dt.timezone.utc).isoformat(), parts, meta or {})
        self._fs.mkdirs(self._at(COMMITS))
        draft = self._at(COMMITS, f".draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(json.dumps(new.__dict__).encode())
        out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self._conf) if draft.toUri().getScheme() \
            else self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        plain = self._jvm.java.lang.reflect.Array.newInstance(
            self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)  # no option: never replaces
        try:
            context.rename(draft, self._at(COMMITS, f"{new.number:012d}.json"), plain)
        except Py4JJavaError as exc:
            self._fs.delete(draft, False)
            if "FileAlreadyExistsException" in str(exc.java_exception):
                raise CommitConflict(f"version {new.number} of {self.path} is there already") from None
            raise
        return new

    def replace(self, df: DataFrame, label: str = "t", meta: dict | None = None) -> Commit:
        """The rows of ``df`` become the table. (``df`` may read the version before.)"""
        before = self.current()
        folder = self.new_folder(label)
        df.write.parquet(self.full(folder))
        return self.commit({"": {"folder": folder}}, meta, before)

    # -- reading ---------------------------------------------------------------------

    def read(self, parts: list[str] | None = None, every_column: bool = False, version: Commit | None = None) -> DataFrame | None:
        """The table, or only the given parts of it; None if there is none.
        Columns that the table keeps for its own use are left out, unless ``every_column``."""
        now = version or self.current()
        if now is None:
            return None
        folders = [p["folder"] for name, p in now.parts.items() if parts is None or name in parts]
        schema = T.StructType.fromJson(now.meta["schema"]) if "schema" in now.meta else None
        if not folders:
            return self.spark.createDataFrame([], schema) if schema and parts is None else None
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        df = reader.parquet(*[self.full(f) for f in folders])
        public = now.meta.get("columns")
        return df if every_column or not public else df.select(*public)

    # -- old versions ------------------------------------------------------------------

    def vacuum(self, older_than: dt.timedelta, now: dt.datetime | None = None) -> list[str]:
        """Remove versions that were replaced longer ago than ``older_than``
        and folders of that age that no version left names; returns the folders removed."""
        numbers = self._numbers()
        if not numbers:
            return []
        limit = (now or dt.datetime.now(dt.timezone.utc)) - older_than
        versions = [self._load(n) for n in numbers]
        # a version is in use until the next one is written
        left = [v for v, after in zip(versions, versions[1:]) if dt.datetime.fromisoformat(after.written_at) >= limit] + versions[-1:]
        named = {top for v in left for p in v.parts.values() for top in _folders(p)}
        for v in versions:
            if v not in left:
                self._fs.delete(self._at(COMMITS, f"{v.number:012d}.json"), False)
        gone = []
        if self._fs.exists(self._at(DATA)):
            for status in self._fs.listStatus(self._at(DATA)):
                folder = f"{DATA}/{status.getPath().getName()}"
                old = status.getModificationTime() / 1000 < limit.timestamp()
                if folder not in named and old:  # a younger one may be a write in progress
                    self._fs.delete(status.getPath(), True)
                    gone.append(folder)
        return gone


def _folders(value) -> set[str]:
    """The top folders below ``_data`` that an entry of a pointer names."""
    if isinstance(value, dict):
        return set().union(*map(_folders, value.values())) if value else set()
    if isinstance(value, str) and value.startswith(DATA + "/"):
        return {"/".join(value.split("/")[:2])}
    return set()
