"""Trip files whose formats, column types and column orders differ from file to file.

One scan cannot read files that disagree on a column's type (Parquet) or order
(CSV), so paths are grouped by layout and each group becomes one scan. The plan
grows with the number of layouts, not of files, and the vectorised reader stays on.
"""

from collections import defaultdict
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow import schemas as S
from fareflow.operators.features import clean_trips, typed_trips
from fareflow.sources import storage
from fareflow.sources.heads import file_heads, input_heads

# Paths whose existence is looked up at a time.
PROBE_THREADS = 32

# Scan column that names the submitted path a row came from.
INPUT_URI = "input_uri"


class UnreadableTrips(ValueError):
    """The path holds no table with the needed trip columns."""


@dataclass(frozen=True)
class Layout:
    """What files must share to be read by one scan."""

    format: str
    folder_depth: int
    columns: tuple[tuple[str, str], ...]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, T.DataType.fromDDL(t)) for n, t in self.columns])


def input_format(path: str) -> str:
    for suffix in ("csv", "parquet"):
        if path.rstrip("/").endswith(f".{suffix}"):
            return suffix
    raise ValueError(f"{path}: trips must be .csv or .parquet")


def existing(spark: SparkSession, paths: Sequence[str]) -> list[bool]:
    with ThreadPoolExecutor(PROBE_THREADS) as pool:
        return list(pool.map(lambda path: storage.exists(spark, path), paths))


def check_inputs(spark: SparkSession, paths: Iterable[str]) -> None:
    """Refuses missing paths and unknown suffixes before any job starts."""
    paths = list(paths)
    for path, there in zip(paths, existing(spark, paths)):
        if not there:
            raise FileNotFoundError(path)
        input_format(path)


def month_paths(
    spark: SparkSession,
    root: str,
    years: Iterable[int],
    months: Iterable[int] = range(1, 13),
    pattern: str = S.MONTH_FILE_PATTERN,
) -> list[str]:
    """The monthly files that exist; having none at all is an error."""
    months = tuple(months)
    wanted = [f"{root}/{pattern.format(year=y, month=m)}" for y in years for m in months]
    found = [path for path, there in zip(wanted, existing(spark, wanted)) if there]
    if not found:
        raise FileNotFoundError(f"no monthly file under {root}")
    return found


def check_folder(spark: SparkSession, folder: str, needed: Sequence[str]) -> None:
    """Refuses a folder of Parquet files if one lacks a needed column: a scan would lose its rows.

    The driver reads every footer; for stores that only Spark opens.
    """

    def lacking(file: str) -> list[str]:
        held = {name.lower() for name in storage.parquet_columns(spark, file)}
        held |= {name.partition("=")[0].lower() for name in file.split("/") if "=" in name}
        return [c for c in needed if c.lower() not in held]

    files = storage.data_files(spark, folder)
    try:
        with ThreadPoolExecutor(PROBE_THREADS) as pool:
            for file, missing in zip(files, pool.map(lacking, files)):
                if missing:
                    raise UnreadableTrips(f"{file}: missing columns {', '.join(missing)}")
    except Py4JJavaError as error:
        raise UnreadableTrips(f"{folder}: {str(error.java_exception)}") from error


def probe(spark: SparkSession, path: str, labelled: bool, format: str | None = None) -> Layout:
    """The layout of one path as Spark infers it on the driver; for what `look_up` is not sure of."""
    format = format or input_format(path)
    reader = spark.read.option("header", "true") if format == "csv" else spark.read
    try:
        found = reader.format(format).load(path).schema
    except (PySparkException, Py4JJavaError) as error:
        raise UnreadableTrips(f"{path}: {str(error).splitlines()[0]}") from error
    depth = storage.folder_depth(spark, path)
    if format == "parquet" and depth:
        check_folder(spark, path, S.trip_columns(labelled))
    return _layout(path, format, depth, [(f.name, f.dataType.simpleString()) for f in found.fields], labelled)


def _layout(path: str, format: str, depth: int, found: list[tuple[str, str]], labelled: bool) -> Layout:
    by_name = {name.lower(): kind for name, kind in found}
    needed = S.trip_columns(labelled)
    missing = [c for c in needed if c.lower() not in by_name]
    if missing:
        raise UnreadableTrips(f"{path}: missing columns {', '.join(missing)}")
    # CSV binds by position, so every column counts; Parquet binds by name.
    if format == "csv":
        columns = tuple((name, "string") for name, _ in found)
    else:
        columns = tuple((c, by_name[c.lower()]) for c in needed)
    return Layout(format, depth, columns)


def check_files(spark: SparkSession, files: DataFrame, labelled: bool) -> None:
    """Refuses files, of any source, of which one is Parquet and lacks a needed column; a job reads the footers."""
    needed = S.trip_columns(labelled)
    rows = files.filter(F.col("file").endswith(".parquet")).select("file", F.lit("parquet").alias("format"))
    held = F.transform("names", F.lower)
    missing = F.filter(F.array(*[F.lit(c) for c in needed]), lambda c: ~F.array_contains(held, F.lower(c)) & ~F.lower("file").contains(F.concat(F.lit("/"), F.lower(c), F.lit("="))))
    heads = file_heads(rows).select("file", "problem", "unsure", missing.alias("missing"))
    wanting = F.col("problem").isNotNull() | F.col("unsure") | (F.size("missing") > 0)
    for head in heads.filter(wanting).toLocalIterator():
        lacking = head.missing
        if head.problem:
            raise UnreadableTrips(f"{head.file}: {head.problem}")
        if head.unsure:
            held = {name.lower() for name in storage.parquet_columns(spark, head.file)}
            lacking = [c for c in needed if c.lower() not in held]
        if lacking:
            raise UnreadableTrips(f"{head.file}: missing columns {', '.join(lacking)}")


def look_up(
    spark: SparkSession, paths: Sequence[str], labelled: bool, format: str | None = None
) -> dict[str, tuple[Layout | UnreadableTrips, int | None]]:
    """By path: its layout, or why it has none, and its rows if they are known; one job for all paths.

    A directory counts as one path and is taken to be of one writer; if its files differ
    in type or header after all, the scan raises instead of misreading them. One with a file that
    lacks a needed column is refused here.
    """
    paths = list(paths)
    if not paths:
        return {}
    uris = {storage.uri(spark, path): path for path in paths}
    needed = list(S.trip_columns(labelled))
    rows = [(uri, format or input_format(path), needed) for uri, path in uris.items()]
    heads = input_heads(spark, spark.createDataFrame(rows, "uri string, format string, needed array<string>"), paths)
    found: dict[str, tuple[Layout | UnreadableTrips, int | None]] = {}
    unsure: list[str] = []
    for head in heads.toLocalIterator():
        path = uris[head.uri]
        depth = head.uri.count("/") + 1 if head.folder else 0
        if head.unsure:
            unsure.append(path)
        elif head.problem:
            found[path] = UnreadableTrips(f"{path}: {head.problem}"), None
        elif head.lacking:
            found[path] = UnreadableTrips(f"{head.lacking.file}: missing columns {head.lacking.columns}"), None
        else:
            kind = format or input_format(path)
            found[path] = _layout(path, kind, depth, list(zip(head.names, head.types)), labelled), head.rows

    def attempt(path: str) -> Layout | UnreadableTrips:
        try:
            return probe(spark, path, labelled, format)
        except UnreadableTrips as error:
            return error

    with ThreadPoolExecutor(PROBE_THREADS) as pool:
        found |= {path: (layout, None) for path, layout in zip(unsure, pool.map(attempt, unsure))}
    return {path: found.get(path, (UnreadableTrips(f"{path}: holds no file"), None)) for path in paths}


def group_layouts(
    spark: SparkSession,
    paths: Sequence[str],
    labelled: bool,
    format: str | None = None,
    on_unreadable: Callable[[str, UnreadableTrips], None] | None = None,
) -> dict[Layout, list[str]]:
    """Paths by layout; an unreadable path raises unless a callback takes it."""
    groups: dict[Layout, list[str]] = defaultdict(list)
    for path, (outcome, _) in look_up(spark, paths, labelled, format).items():
        if isinstance(outcome, Layout):
            groups[outcome].append(path)
        elif on_unreadable:
            on_unreadable(path, outcome)
        else:
            raise outcome
    return dict(groups)


def scan(spark: SparkSession, layout: Layout, paths: Sequence[str], name_input: bool = False) -> DataFrame:
    """One scan over files of one layout, with stored column types."""
    reader = spark.read.schema(layout.schema)
    if layout.format == "csv":
        # A single file's header was read by the probe; a directory's files are checked by the scan.
        reader = reader.option("header", "true").option("enforceSchema", str(not layout.folder_depth).lower())
    df = reader.format(layout.format).load(list(paths))
    if not name_input:
        return df
    # Evaluated for every row: cutting at a known depth costs a tenth of a pattern match.
    file_path = F.col("_metadata.file_path")
    folder = F.substring_index(file_path, "/", layout.folder_depth)
    return df.withColumn(INPUT_URI, folder if layout.folder_depth else file_path)


def _over_layouts(
    spark: SparkSession,
    paths: Sequence[str],
    labelled: bool,
    format: str | None,
    shape: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    groups = group_layouts(spark, paths, labelled, format)
    frames = [shape(scan(spark, layout, members)) for layout, members in groups.items()]
    return reduce(DataFrame.unionByName, frames)


def read_trips(
    spark: SparkSession, paths: Sequence[str], labelled: bool = False, format: str | None = None
) -> DataFrame:
    """Typed trips of all paths in one frame, not yet cleaned."""
    return _over_layouts(spark, paths, labelled, format, lambda df: typed_trips(df, labelled))


def read_clean_trips(
    spark: SparkSession,
    paths: Sequence[str],
    labelled: bool = True,
    format: str | None = None,
    year: bool = False,
) -> DataFrame:
    """Cleaned trips of all paths, cleaned per layout so each scan gets its own pushed filters."""
    return _over_layouts(
        spark, paths, labelled, format, lambda df: clean_trips(df, labelled, year=year)
    )
