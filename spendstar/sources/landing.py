"""Landing stage: raw files are put where bronze reads them, byte for byte.

The source system uploads the raw CSV to an object-store container and bronze
reads it back from there. Here the same hand-over is a Spark job: the files' paths are dealt to
tasks, which copy them as streams and compare the checksums of what they read and
what then lies in the landing place. The copies go to a fresh folder that takes the
place of the old one once all are there, so a failure leaves what was landed before.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession

from spendstar.sources.files import Files

LANDING_CONF = "spendstar.landing.uri"
BLOCK = 8 << 20
# Schemes that Hadoop and Arrow name differently.
_ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}


def resolve_landing_uri(
    spark: SparkSession | None = None, explicit: str | None = None, default: str | None = None
) -> str | None:
    """Explicit argument wins, then the session setting, then the default."""
    if explicit:
        return explicit
    if spark is not None:
        configured = spark.conf.get(LANDING_CONF, None)
        if configured:
            return configured
    return default


def write_raw_csv(raw: DataFrame, uri: str) -> str:
    """Write raw text rows as CSV with a header, keeping spaces and quotes intact."""
    (
        raw.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("emptyValue", '""')
        .csv(uri)
    )
    return uri


class LandingError(RuntimeError):
    """A file did not arrive as it was."""


def _arrow_path(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """A worker's file system and path for a full Hadoop path."""
    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return arrow_fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return arrow_fs.FileSystem.from_uri(f"{_ARROW_SCHEMES.get(scheme, scheme)}:{quote(rest)}")


def _digest(place: arrow_fs.FileSystem, path: str, copy=None) -> tuple[int, str]:
    """Bytes and checksum of a file, read block by block; each block is also given to ``copy``."""
    size, seen = 0, hashlib.sha256()
    with place.open_input_stream(path) as stream:
        while block := stream.read(BLOCK):
            size += len(block)
            seen.update(block)
            if copy is not None:
                copy.write(block)
    return size, seen.hexdigest()


def copy_file(source: str, target: str) -> tuple[int, str]:
    """Copy one file; its size and checksum, the same on both sides.

    Written under another name first, so two attempts of one task do not mix.
    """
    (from_fs, from_path), (to_fs, to_path) = _arrow_path(source), _arrow_path(target)
    folder, name = to_path.rsplit("/", 1)
    attempt = f"{folder}/_{uuid.uuid4().hex}-{name}"
    with to_fs.open_output_stream(attempt) as out:
        sent = _digest(from_fs, from_path, out)
    arrived = _digest(to_fs, attempt)
    if sent != arrived:
        raise LandingError(f"{source}: {sent} was sent, {arrived} arrived")
    to_fs.move(attempt, to_path)
    return sent


def _copy_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sources, targets = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        done = [copy_file(s, t) for s, t in zip(sources, targets, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), pa.array([n for n, _ in done], pa.int64()), pa.array([d for _, d in done], pa.string())],
            names=["target", "bytes", "sha256"],
        )


def _source_files(files: Files, source_uri: str, target: str) -> list[tuple[str, int]]:
    """(path, bytes) of the files that a path, folder or glob names, as Spark would read them."""
    found: list[tuple[str, int]] = []
    for path, folder, size in files.matching(source_uri):
        if f"{path}/".startswith(f"{target}/") or (folder and f"{target}/".startswith(f"{path}/")):
            raise ValueError(f"landing place {target} and source {path} overlap")
        if folder:
            visible = [(n, s) for n, s in files.sizes(path) if not n.startswith((".", "_"))]
            found += [(f"{path}/{n}", s) for n, s in visible]
        else:
            found.append((path, size))
    if any(path.startswith(f"{target}/") for path, _ in found):
        raise ValueError(f"landing place {target} holds files of the source {source_uri}")
    if not found:
        raise FileNotFoundError(f"no file at {source_uri}")
    return sorted(found)


def _targets(paths: list[str], folder: str) -> list[str]:
    """A place in the folder for each path: its own name, numbered where names repeat."""
    names = [p.rsplit("/", 1)[1] for p in paths]
    repeated = len(set(names)) < len(names)
    return [f"{folder}/{k:06d}-{n}" if repeated else f"{folder}/{n}" for k, n in enumerate(names)]


def land(spark: SparkSession, source_uri: str, landing_uri: str) -> str:
    """Copy the raw file(s) at ``source_uri`` (a file, folder or glob) into ``landing_uri``; return it.

    The files arrive byte for byte. What was landed there before is replaced as a whole;
    a place that is, holds or lies in a folder of the source is refused and left alone.
    """
    files = Files(spark)
    target = files.qualified(landing_uri).rstrip("/")
    listed = _source_files(files, source_uri, target)
    version = uuid.uuid4().hex
    incoming, before = f"{target}.incoming-{version}", f"{target}.before-{version}"
    files.make(incoming)
    try:
        places = _targets([p for p, _ in listed], incoming)
        # large files first, dealt in turn
        rows = sorted(zip([p for p, _ in listed], places, [n for _, n in listed], strict=True), key=lambda r: -r[2])
        tasks = min(len(rows), 4 * spark.sparkContext.defaultParallelism)
        paths = spark.createDataFrame([r[:2] for r in rows], "source string, target string")
        done = paths.repartition(tasks).mapInArrow(_copy_all, "target string, bytes long, sha256 string").collect()
        arrived, sizes = {r["target"]: r["bytes"] for r in done}, {r[1]: r[2] for r in rows}
        if arrived != sizes:
            wrong = sorted(k for k in sizes if arrived.get(k) != sizes[k])
            raise LandingError(f"files changed while they were copied: {wrong[:5]}")
        _switch(files, incoming, target, before)
    except BaseException:
        files.remove(incoming)
        raise
    return landing_uri


def _switch(files: Files, incoming: str, target: str, before: str) -> None:
    """Put the new folder in place of the old one; the old one stays if that fails."""
    if not files.exists(target):
        files.move(incoming, target)
        return
    files.move(target, before)
    try:
        files.move(incoming, target)
    except BaseException:
        files.move(before, target)
        raise
    files.remove(before)
