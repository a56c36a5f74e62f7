"""Session helpers: a local session for tests and the shared folder of a cluster."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "linepareto") -> SparkSession:
    """A single-JVM session for tests and benches; a cluster brings its own."""
    partitions = "8" if cores == "*" else str(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_run: ContextVar[str | None] = ContextVar("run", default=None)


def _root(spark: SparkSession) -> str:
    """The folder below `spark.checkpoint.dir`, which every executor can reach.

    Only a local master may go without that setting; it then gets a temporary folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="linepareto-"))
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/linepareto"


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder in the shared one: of the `run` this is in, else to be removed by whoever wants it removed."""
    return "/".join([_root(spark), *([_run.get()] if _run.get() else []), f"{purpose}-{uuid4().hex}"])


@contextmanager
def run(spark: SparkSession) -> Iterator[None]:
    """All intermediate tables made inside are removed at its end, whether it fails or not.

    What is to last has to be written elsewhere inside of it; a run within a run is part of the outer one.
    """
    if _run.get():
        yield
        return
    token = _run.set(f"run-{uuid4().hex}")
    try:
        yield
    finally:
        remove_folder(spark, f"{_root(spark)}/{_run.get()}")
        _run.reset(token)


def _stored_at(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder of intermediate tables, wherever it is stored; none is fine."""
    path, store = _stored_at(spark, folder)
    store.delete(path, True)


@contextmanager
def published(spark: SparkSession, folder: str) -> Iterator[str]:
    """A hidden folder to write to, which takes the place of `folder` once all is written.

    If writing fails, what was there before stays and nothing else does.
    """
    above, _, name = folder.rstrip("/").rpartition("/")
    staged = f"{above}{'/' if above else ''}.{name}-{uuid4().hex}"
    try:
        yield staged
        (old, store), (new, _) = _stored_at(spark, folder), _stored_at(spark, staged)
        store.delete(old, True)
        if not store.rename(new, old):
            raise OSError(f"{staged} could not be moved to {folder}")
    finally:
        remove_folder(spark, staged)
