"""Byte access to files from inside Spark tasks (local, HDFS, object stores)
through ``pyarrow.fs``, plus shipping this package to the executors."""
from __future__ import annotations

import os
import threading

_SHIPPED: set[int] = set()
_SHIP_LOCK = threading.Lock()


def _uri(path: str) -> str:
    if path.startswith("s3a://") or path.startswith("s3n://"):
        return "s3://" + path.split("://", 1)[1]
    return path


def filesystem(path: str):
    """``(filesystem, path)`` for a Spark path (``file:``, ``hdfs://``, ``s3a://`` ...).

    Spark reports paths unencoded (``file:/a b.csv``) while ``pyarrow`` parses
    URIs, so local paths are opened directly and the path part of other URIs is
    percent-encoded first."""
    import re
    from urllib.parse import quote

    import pyarrow.fs as pafs
    uri = _uri(path)
    if uri.startswith("file:"):
        local = re.sub(r"^file:(//[^/]*)?", "", uri)
        return pafs.LocalFileSystem(), local
    m = re.match(r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)(.*)$", uri, flags=re.S)
    if not m:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(m.group(1) + quote(m.group(2), safe="/"))


def open_input(path: str):
    fs, p = filesystem(path)
    return fs.open_input_file(p)


def read_range(path: str, start: int, length: int) -> bytes:
    with open_input(path) as f:
        return f.read_at(length, start)


def open_output(path: str):
    fs, p = filesystem(path)
    parent = p.rsplit("/", 1)[0]
    if parent:
        fs.create_dir(parent, recursive=True)
    return fs.open_output_stream(p, compression=None)   # bytes as given, whatever the extension


class atomic_output:
    """Write a file from a task so that readers only ever see a complete file:
    bytes go to an attempt-specific temporary name that is moved into place on
    success (a retried or speculative attempt just replaces it)."""

    def __init__(self, path: str):
        self.path = path
        try:
            from pyspark import TaskContext
            ctx = TaskContext.get()
            tag = f"{ctx.stageId()}-{ctx.partitionId()}-{ctx.attemptNumber()}" if ctx else "driver"
        except Exception:
            tag = "local"
        base = path.rsplit("/", 1)
        self.tmp = f"{base[0]}/.{base[-1]}.tmp-{tag}" if len(base) == 2 else f".{path}.tmp-{tag}"

    def __enter__(self):
        self.stream = open_output(self.tmp)
        return self.stream

    def __exit__(self, exc_type, exc, tb):
        self.stream.close()
        fs, tmp = filesystem(self.tmp)
        if exc_type is None:
            fs.move(tmp, filesystem(self.path)[1])
        else:
            fs.delete_file(tmp)
        return False


def ship_package(spark) -> None:
    """Make ``csvforge`` importable in Python workers: the package is zipped in
    memory, written to the shared folder (named by its content hash) and added
    with ``addPyFile``."""
    sc = spark.sparkContext
    key = id(sc)  # one upload per SparkContext
    with _SHIP_LOCK:
        if key in _SHIPPED:
            return
        _ship(spark, sc)
        _SHIPPED.add(key)


def _ship(spark, sc) -> None:
    import hashlib
    import io
    import zipfile
    pkg_dir = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(pkg_dir)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in sorted(os.walk(pkg_dir)):
            if "__pycache__" in folder:
                continue
            for name in sorted(files):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.relpath(full, root))
    blob = buf.getvalue()
    from ..session import shared_dir
    target = f"{shared_dir(spark)}/csvforge-pkg/csvforge-{hashlib.sha1(blob).hexdigest()[:16]}.zip"
    fs, p = filesystem(target)
    if fs.get_file_info(p).type.name == "NotFound":
        with atomic_output(target) as out:
            out.write(blob)
    sc.addPyFile(target)


def extend_schema(schema, *fields):
    """A new schema with extra ``(name, type)`` fields (``StructType.add`` would
    modify the DataFrame's own schema object)."""
    from pyspark.sql import types as T
    out = T.StructType(list(schema.fields))
    for name, typ in fields:
        out = out.add(name, typ)
    return out


def remove_dir(path: str) -> bool:
    """Best-effort recursive delete of a work folder (driver side)."""
    try:
        fs, p = filesystem(path)
        fs.delete_dir(p)
        return True
    except Exception:  # missing folder or unsupported file system: leave it
        return False
