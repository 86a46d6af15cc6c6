"""The folder that all executors can reach, for results that must be written once."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """This application's own folder under ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder; on a cluster
    the setting is required, since a folder of one machine would be useless to
    the others.
    """
    context = spark.sparkContext
    root = spark.conf.get(_SETTING, None) or context.getConf().get(_SETTING)
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError(f"{_SETTING} must name a folder that all executors share")
        app = context.applicationId
        root = _local_roots.get(app) or _local_roots.setdefault(app, tempfile.mkdtemp(prefix="run-"))
    return f"{root.rstrip('/')}/uptake-{context.applicationId}"


class Scratch:
    """The folders given out while a ``scratch`` block is open, in order."""

    def __init__(self) -> None:
        self.paths: list[str] = []
        self.kept: list[str] = []

    def keep_last(self) -> str:
        """Spares the folder given out last, and returns it."""
        self.kept.append(self.paths.pop())
        return self.kept[-1]


_open: ContextVar[Scratch | None] = ContextVar("scratch", default=None)


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has been written to."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    block = _open.get()
    if block is not None:
        block.paths.append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that ``fresh_folder`` gave to this application; any other path is refused."""
    parent, _, name = path.rpartition("/")
    if parent != shared_folder(spark) or name in ("", ".", ".."):
        raise ValueError(f"{path} is not a folder of this application")
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """Deletes at its end, also after an error, all folders that this thread was given inside and did not keep.

    Only what has been written out, or computed to the end, may outlive the block: a lazy frame over a deleted folder fails. Kept
    folders pass to the block around this one.
    """
    block, outer = Scratch(), _open.get()
    token = _open.set(block)
    try:
        yield block
    finally:
        _open.reset(token)
        for path in block.paths:
            remove(spark, path)
        if outer is not None:
            outer.paths.extend(block.kept)
