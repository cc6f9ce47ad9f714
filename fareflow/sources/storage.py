"""Existence, listing and canonical addresses on whatever file system a path names."""

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    location, fs = _resolve(spark, path)
    return fs.exists(location)


def folder_depth(spark: SparkSession, path: str) -> int:
    """Slashes up to and including the one after a folder's address; 0 for a file."""
    location, fs = _resolve(spark, path)
    return uri(spark, path).count("/") + 1 if fs.getFileStatus(location).isDirectory() else 0


def expand(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a glob, sorted by name."""
    location, fs = _resolve(spark, pattern)
    return sorted(status.getPath().toString() for status in fs.globStatus(location) or [])


def data_files(spark: SparkSession, folder: str) -> list[str]:
    """The files below a folder that a scan of it reads."""
    location, fs = _resolve(spark, folder)
    depth = len(fs.makeQualified(location).toString().split("/"))
    found, files = [], fs.listFiles(location, True)
    while files.hasNext():
        path = files.next().getPath().toString()
        if not any(name.startswith(("_", ".")) and "=" not in name for name in path.split("/")[depth:]):
            found.append(path)
    return found


def parquet_columns(spark: SparkSession, path: str) -> list[str]:
    """Names of one Parquet file's columns, from its footer."""
    location, _ = _resolve(spark, path)
    parquet = spark._jvm.org.apache.parquet.hadoop
    source = parquet.util.HadoopInputFile.fromPath(location, spark.sparkContext._jsc.hadoopConfiguration())
    reader = parquet.ParquetFileReader.open(source)
    try:
        return [field.getName() for field in reader.getFileMetaData().getSchema().getFields()]
    finally:
        reader.close()


def uri(spark: SparkSession, path: str) -> str:
    """The address as the scan's `_metadata.file_path` spells it."""
    location, fs = _resolve(spark, path)
    return re.sub(r"^file:/+", "file:/", fs.makeQualified(location).toUri().toString())


def children(spark: SparkSession, folder: str) -> list[str]:
    location, fs = _resolve(spark, folder)
    return [status.getPath().getName() for status in fs.listStatus(location)]


def part_sizes(spark: SparkSession, folder: str) -> dict[str, int]:
    """Bytes of each part file that lies right in the folder, by name."""
    location, fs = _resolve(spark, folder)
    sizes = {status.getPath().getName(): status.getLen() for status in fs.listStatus(location)}
    return {name: n for name, n in sizes.items() if name.startswith("part-")}


def size(spark: SparkSession, path: str) -> int:
    location, fs = _resolve(spark, path)
    return fs.getContentSummary(location).getLength()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file whole."""
    location, fs = _resolve(spark, path)
    stream = fs.open(location)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Makes a small file that did not exist, whole or not at all; raises FileExistsError if another was faster."""
    target, fs = _resolve(spark, path)
    draft, _ = _resolve(spark, f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    jvm = spark._jvm
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    never_over = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.rename(draft, target, never_over)
    except Py4JJavaError as error:
        fs.delete(draft, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            raise FileExistsError(path) from error
        raise


def delete(spark: SparkSession, path: str) -> None:
    location, fs = _resolve(spark, path)
    fs.delete(location, True)


def replace(spark: SparkSession, new: str, target: str) -> None:
    """Puts `new` in the place of `target`; if that fails, what was there before is there again.

    The old one steps aside under another name and is deleted once the new one stands.
    """
    source, fs = _resolve(spark, new)
    destination, _ = _resolve(spark, target)
    aside, _ = _resolve(spark, f"{target.rstrip('/')}.old-{uuid.uuid4().hex}")
    held = fs.exists(destination)
    if held and not fs.rename(destination, aside):
        raise OSError(f"cannot replace {target}")
    try:
        done = fs.rename(source, destination)
    except Exception:
        done = False
        raise
    finally:
        if not done and held:
            fs.rename(aside, destination)
    if not done:
        raise OSError(f"cannot write {target}")
    if held:
        fs.delete(aside, True)


def promote_part(spark: SparkSession, folder: str, target: str) -> None:
    """Turns a written folder's only part into the file `target`; a folder of that name is refused."""
    location, fs = _resolve(spark, folder)
    destination, _ = _resolve(spark, target)
    if fs.exists(destination) and fs.getFileStatus(destination).isDirectory():
        raise IsADirectoryError(f"{target} is a folder")
    files = [status.getPath() for status in fs.listStatus(location)]
    (part,) = [file for file in files if file.getName().startswith("part-")]
    replace(spark, part.toString(), target)
    fs.delete(location, True)
