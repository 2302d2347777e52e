"""Session helpers: scratch folders, per-read split sizes, Hadoop file access."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh, shared folder below ``spark.checkpoint.dir``.

    Without that setting a local session gets a temporary folder; a cluster gets an
    error, since a folder of one machine is not visible to the others.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", base)
    app = spark.sparkContext.applicationId
    return f"{base.rstrip('/')}/millrace-{app}/{label}-{uuid.uuid4().hex[:12]}"


#: Tasks of a sized read for each core.  What it is cut into beyond that is dealt out among them.
TASKS_PER_CORE = 64


def most_tasks(spark: SparkSession) -> int:
    """Tasks among which a sized read deals out its pieces, if it has more of these."""
    given = spark.conf.get("spark.sql.files.maxPartitionNum", None)
    return int(given) if given else TASKS_PER_CORE * spark.sparkContext.defaultParallelism


def sized_session(spark: SparkSession, size: int) -> SparkSession:
    """A sibling session whose file scans are cut every ``size`` bytes.

    The setting belongs to the session that owns a scan, so two reads in one job can
    have two sizes.  Context, executors and the other settings are shared.  A task reads one
    piece, or several one after the other where there would be more than ``most_tasks``: tasks, and
    the files that they write, cost the driver some time each, however small they are.
    """
    sibling = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            sibling.conf.set(key, value)
    sibling.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    sibling.conf.set("spark.sql.files.maxPartitionNum", str(most_tasks(spark)))
    return sibling


@contextmanager
def active(spark: SparkSession) -> Iterator[None]:
    """``spark`` as the active session: Python data sources are looked up there, whoever reads."""
    sessions = spark._jvm.org.apache.spark.sql.classic.SparkSession
    before = sessions.getActiveSession()
    sessions.setActiveSession(spark._jsparkSession)
    try:
        yield
    finally:
        if before.isDefined():
            sessions.setActiveSession(before.get())
        else:
            sessions.clearActiveSession()


def adopt(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``df`` bound to ``spark`` again, so that views and joins land in the caller's session.

    The empty side is removed by the optimizer.
    """
    if df.isStreaming:
        return df
    empty = spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema])
    return empty.union(df)


_limits_lock = threading.Lock()
_limits: dict[int, tuple[int, str]] = {}


@contextmanager
def small_methods(spark: SparkSession) -> Iterator[None]:
    """Keep generated methods below the size that the HotSpot compiler refuses.

    Rendering many columns makes one large method; this is the value that the Spark
    documentation recommends for HotSpot.  The setting is put back when the last of the
    exports that run side by side in the session is done.
    """
    key, session = "spark.sql.codegen.hugeMethodLimit", id(spark._jsparkSession)
    with _limits_lock:
        users, before = _limits.get(session, (0, spark.conf.get(key)))
        _limits[session] = (users + 1, before)
        spark.conf.set(key, "8000")
    try:
        yield
    finally:
        with _limits_lock:
            users, before = _limits.pop(session)
            if users > 1:
                _limits[session] = (users - 1, before)
            else:
                spark.conf.set(key, before)


class Files:
    """The few Hadoop ``FileSystem`` calls a commit needs, for any scheme Spark can open."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self.root = self.path(root)
        self._fs = self.root.getFileSystem(self._conf)
        self._gateway = spark.sparkContext._gateway

    @cached_property
    def _context(self):
        return self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)

    @cached_property
    def _overwrite(self):
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        flags = self._gateway.new_array(rename, 1)
        flags[0] = rename.OVERWRITE
        return flags

    def path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def qualified(self, text: str) -> str:
        return self._fs.makeQualified(self.path(text)).toString()

    def exists(self, text: str) -> bool:
        return self._fs.exists(self.path(text))

    def is_symlink(self, text: str) -> bool:
        return self._context.getFileLinkStatus(self.path(text)).isSymlink()

    def is_directory(self, text: str) -> bool:
        return self._fs.getFileStatus(self.path(text)).isDirectory()

    def length(self, text: str) -> int:
        return self._fs.getFileStatus(self.path(text)).getLen()

    def names(self, text: str) -> list[tuple[str, int]]:
        """Name and length of the direct children."""
        return [(s.getPath().getName(), s.getLen()) for s in self._fs.listStatus(self.path(text))]

    def glob(self, pattern: str) -> list[str]:
        found = self._fs.globStatus(self.path(pattern))
        return [s.getPath().toString() for s in found] if found else []

    def walk(self, text: str) -> list[tuple[str, int]]:
        """Path relative to ``text`` and length of every file below it."""
        return [(path, length) for path, length, _ in self.walk_with_times(text)]

    def walk_with_times(self, text: str) -> list[tuple[str, int, int]]:
        """``walk`` with the time of the last change in milliseconds."""
        base = self._fs.makeQualified(self.path(text)).toString().rstrip("/") + "/"
        found = []
        remote = self._fs.listFiles(self.path(text), True)
        while remote.hasNext():
            status = remote.next()
            found.append((status.getPath().toString().removeprefix(base), status.getLen(), status.getModificationTime()))
        return found

    def make_directory(self, text: str) -> None:
        if not self._fs.mkdirs(self.path(text)):
            raise OSError(f"cannot create {text}")

    def replace(self, source: str, target: str) -> None:
        """Move a file over whatever has the name; one step where the file system can."""
        self._context.rename(self.path(source), self.path(target), self._overwrite)

    def read_text(self, text: str) -> str:
        stream = self._fs.open(self.path(text))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
        finally:
            stream.close()

    def write_text(self, text: str, body: str) -> None:
        stream = self._fs.create(self.path(text), True)
        try:
            stream.write(bytearray(body.encode("utf-8")))
        finally:
            stream.close()

    def remove(self, text: str) -> None:
        self._fs.delete(self.path(text), True)
