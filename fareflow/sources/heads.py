"""What the head of every data file says, read where the data is read: by the executors.

One Spark job lists the files of any number of paths and opens each file's footer or header line.
Nothing is opened by the driver. Stores that only Spark can open, and the few heads
whose meaning is Spark's own to decide, come back as `unsure` and are left to the caller.
"""

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of a text file in which its header line must end.
HEADER_BYTES = 1 << 16
# Files whose heads one task opens.
FILES_PER_TASK = 64

HEADS = "file string, names array<string>, types array<string>, rows long, problem string, unsure boolean"
_ARROW = pa.schema(
    [
        ("file", pa.string()),
        ("names", pa.list_(pa.string())),
        ("types", pa.list_(pa.string())),
        ("rows", pa.int64()),
        ("problem", pa.string()),
        ("unsure", pa.bool_()),
    ]
)

# The type that Spark gives a stored one; others are left to Spark.
_SQL_TYPES = {
    "bool": "boolean",
    "int8": "tinyint",
    "int16": "smallint",
    "int32": "int",
    "int64": "bigint",
    "float": "float",
    "double": "double",
    "string": "string",
    "large_string": "string",
    "binary": "binary",
    "date32[day]": "date",
    "timestamp[us]": "timestamp_ntz",
    "timestamp[ms]": "timestamp_ntz",
    "timestamp[us, tz=UTC]": "timestamp",
    "timestamp[ms, tz=UTC]": "timestamp",
}


def _sql_type(kind: pa.DataType, physical: str | None) -> str | None:
    if physical == "INT96":
        return "timestamp"
    if pa.types.is_decimal(kind):
        return f"decimal({kind.precision},{kind.scale})"
    return _SQL_TYPES.get(str(kind))


def _footer(file) -> dict:
    import pyarrow.parquet as pq

    reader = pq.ParquetFile(file)
    leaves = {leaf.path: leaf.physical_type for leaf in (reader.schema.column(i) for i in range(len(reader.schema)))}
    fields = list(reader.schema.to_arrow_schema())
    return {
        "names": [f.name for f in fields],
        "types": [_sql_type(f.type, leaves.get(f.name)) for f in fields],
        "rows": reader.metadata.num_rows,
    }


def _header(file) -> dict:
    """Names as Spark makes them unique; what depends on quotes, blank lines or encodings is left to it."""
    line, end, _ = file.read(HEADER_BYTES).partition(b"\n")
    if not line and not end:
        return {"names": [], "types": []}
    if (not end and len(line) >= HEADER_BYTES) or not line.strip() or any(mark in line for mark in (b'"', b"\\", b"\xef\xbb\xbf", b"\0")):
        return {"unsure": True}
    found = line.decode().rstrip("\r").split(",")
    low = [name.lower() for name in found]
    names = [f"_c{i}" if not name else f"{name}{i}" if low.count(low[i]) > 1 else name for i, name in enumerate(found)]
    return {"names": names, "types": ["string"] * len(names)}


def _head(uri: str, format: str) -> dict:
    """The head of one file; `problem` if the file is none of its format, `unsure` if this process cannot tell."""
    from pyarrow import fs

    try:
        store, path = fs.FileSystem.from_uri(uri)
        file = store.open_input_file(path)
    except (OSError, ValueError, NotImplementedError, pa.ArrowException):
        return {"unsure": True}
    try:
        with file:
            return (_footer if format == "parquet" else _header)(file)
    except pa.ArrowInvalid as error:
        return {"problem": str(error).splitlines()[0]}
    except (OSError, ValueError, pa.ArrowException):
        return {"unsure": True}


def file_heads(files: DataFrame) -> DataFrame:
    """HEADS of (file, format): names and types of its columns, its rows if it is Parquet.

    A type is null where Spark's own reading decides. Null `names` come with a `problem`, or `unsure`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [{"file": uri, "unsure": False, **_head(uri, format)} for uri, format in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return files.select("file", "format").mapInArrow(run, HEADS)


def listed_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file) of every data file at or below the paths, by listing alone; many paths are listed by a job."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return reader.load(list(paths)).select(F.col("_metadata.file_path").alias("file"))


def input_heads(spark: SparkSession, inputs: DataFrame, paths: Sequence[str]) -> DataFrame:
    """(uri, folder, names, types, rows, lacking, problem, unsure): one row for each input (uri, format, needed).

    Names and types are those of the input's first file. `lacking` names a file of an input that has
    not all `needed` columns, and those it lacks; partition folders count as columns. `folder`
    says that files lie below the input. An input without any file has no row.
    """
    depths = [r.depth for r in inputs.select((F.length("uri") - F.length(F.replace("uri", F.lit("/"))) + 1).alias("depth")).distinct().collect()]
    files = listed_files(spark, paths)
    owners = F.explode(F.array_distinct(F.array(*[F.substring_index("file", "/", d) for d in depths])))
    files = files.select("file", owners.alias("uri")).join(inputs, "uri")
    n = max(1, -(-files.count() // FILES_PER_TASK))
    heads = file_heads(files.select("file", "format").distinct().repartition(n))
    rows = files.join(heads, "file")
    inside = F.expr("substring(file, length(uri) + 1)")
    keyed = F.transform(F.filter(F.split(inside, "/"), lambda p: p.contains("=")), lambda p: F.lower(F.substring_index(p, "=", 1)))
    held = F.concat(F.transform("names", F.lower), keyed)
    missing = F.array_except(F.transform("needed", F.lower), held)
    # As they are spelled in `needed`.
    missing = F.filter("needed", lambda c: F.array_contains(missing, F.lower(c)))
    known = F.col("problem").isNull() & ~F.col("unsure")
    lacking = F.when(known & (F.size(missing) > 0), F.struct("file", F.array_join(missing, ", ").alias("columns")))
    vague = F.exists("needed", lambda c: F.array_contains(keyed, F.lower(c)))
    odd = F.exists(
        F.arrays_zip("names", "types"), lambda f: f["types"].isNull() & F.array_contains(F.transform("needed", F.lower), F.lower(f["names"]))
    )
    unsure = F.col("unsure") | (known & (vague | F.coalesce(odd, F.lit(False))))
    return rows.groupBy("uri").agg(
        F.max(F.col("file") != F.col("uri")).alias("folder"),
        F.min_by(F.struct("names", "types"), F.when(known, F.col("file"))).alias("first"),
        F.sum("rows").alias("rows"),
        F.min(lacking).alias("lacking"),
        F.min("problem").alias("problem"),
        F.max(unsure).alias("unsure"),
    ).select("uri", "folder", "first.*", "rows", "lacking", "problem", "unsure")
