"""Small files in a shared store, as a driver reads and writes them; put_if_absent is what several drivers agree by."""

from __future__ import annotations

import os
import uuid

import pyarrow.fs as pafs
from pyspark.sql import SparkSession


def local(path: str) -> str | None:
    """The path on this machine's file system, if it is there."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    return None if "://" in path else path


def store(path: str) -> tuple[pafs.FileSystem, str]:
    here = local(path)
    return pafs.FileSystem.from_uri(path) if here is None else (pafs.LocalFileSystem(), os.path.abspath(here))


def names(folder: str) -> list[str]:
    """Names in a folder; none if it isn't there."""
    fs, path = store(folder)
    return [x.base_name for x in fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))]


def read(path: str) -> bytes:
    fs, name = store(path)
    with fs.open_input_stream(name, compression=None) as f:
        return f.read()


def put_if_absent(spark: SparkSession, path: str, data: bytes) -> bool:
    """Write a file, whole, unless there is one of that name; False if there is. A hard link on a local file system, a rename that doesn't
    replace on others (Hadoop's, which is atomic where the store's is)."""
    folder, name = path.rsplit("/", 1)
    here = local(path)
    if here is None:
        return _renamed(spark, folder, name, data)
    os.makedirs(os.path.dirname(here), exist_ok=True)
    part = os.path.join(os.path.dirname(here), f".{name}.{uuid.uuid4().hex}")
    with open(part, "xb") as f:
        f.write(data)
        f.flush()
        os.fsync(f.fileno())
    try:
        os.link(part, here)
        return True
    except FileExistsError:
        return False
    finally:
        os.unlink(part)


def _renamed(spark: SparkSession, folder: str, name: str, data: bytes) -> bool:
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    hadoop = jvm.org.apache.hadoop
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    part, dest = hadoop.fs.Path(f"{folder}/.{name}.{uuid.uuid4().hex}"), hadoop.fs.Path(f"{folder}/{name}")
    fs = part.getFileSystem(conf)
    fs.mkdirs(hadoop.fs.Path(folder))
    out = fs.create(part, False)
    out.write(bytearray(data))
    out.close()
    try:
        hadoop.fs.FileContext.getFileContext(dest.toUri(), conf).rename(part, dest, gateway.new_array(hadoop.fs.Options.Rename, 0))
        return True
    except Exception as e:
        if "FileAlreadyExistsException" not in str(e):
            raise
        return False
    finally:
        fs.delete(part, False)
