"""The run log: appended by submissions, merged now and then, read as one table at any time.

Each append is a folder of its own. A merge writes what it read into a folder that scans pass
over, then puts up a new version of the manifest, which names the merged folders and the appends they
hold; putting it up is one rename that only one of two merges can win. A reader takes the newest version's
merged folders and the appends it does not name, so it meets each row once, whenever it
looks. What a version has replaced is deleted only by the merge after it, so that readers of the
version before can finish.
"""

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from fareflow import schemas as S
from fareflow.sources import storage
from fareflow.sources.tables import csv_reader

MANIFEST = "_manifest"
# A merged folder of this size is left as it is by later merges.
FULL_BYTES = 128 << 20


def append_run_log(rows: DataFrame, path: str) -> None:
    """Adds one submission's rows, one file in a folder of its own so that submissions may run side by side."""
    folder = f"{path}/submission-{uuid.uuid4().hex}"
    rows.select(*S.RUN_LOG.fieldNames()).coalesce(1).write.option("header", "true").csv(folder)


def _manifest(spark: SparkSession, path: str) -> dict:
    versions = storage.children(spark, f"{path}/{MANIFEST}") if storage.exists(spark, f"{path}/{MANIFEST}") else []
    versions = [name for name in versions if name.startswith("v")]
    if not versions:
        return {"version": 0, "merged": [], "held": [], "replaced": []}
    return json.loads(storage.read_text(spark, f"{path}/{MANIFEST}/{max(versions)}"))


def _appended(spark: SparkSession, path: str, manifest: dict) -> list[str]:
    """Finished appends that no merged folder holds."""
    names = [name for name in storage.children(spark, path) if name.startswith("submission-")]
    names = sorted(set(names) - set(manifest["held"]))
    return [name for name in names if storage.exists(spark, f"{path}/{name}/_SUCCESS")]


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """The log of all submissions; CSV files from elsewhere, or one such file, are read as well."""
    reader = csv_reader(spark, S.RUN_LOG).option("recursiveFileLookup", "true")
    manifest = _manifest(spark, path)
    if not manifest["version"]:
        return reader.csv(path)
    others = [n for n in storage.children(spark, path) if not n.startswith(("_", ".", "submission-"))]
    names = [*manifest["merged"], *_appended(spark, path, manifest), *others]
    return reader.csv([f"{path}/{name}" for name in names])


def compact_run_log(spark: SparkSession, path: str, full_bytes: int = FULL_BYTES) -> int:
    """Merges the appends, and merged folders that are not yet full, into one; returns how many folders it merged.

    Raises FileExistsError if another merge was faster; the log is as that one left it.
    """
    before = _manifest(spark, path)
    appended = _appended(spark, path, before)
    small = [name for name in before["merged"] if storage.size(spark, f"{path}/{name}") < full_bytes]
    if len(appended) + len(small) < 2:
        return 0
    folders = [f"{path}/{name}" for name in (*small, *appended)]
    merged = f"_merged-{uuid.uuid4().hex}"
    parts = max(1, sum(storage.size(spark, folder) for folder in folders) // full_bytes)
    rows = csv_reader(spark, S.RUN_LOG).csv(folders)
    rows.coalesce(parts).write.option("header", "true").csv(f"{path}/{merged}")
    version = before["version"] + 1
    manifest = {
        "version": version,
        "merged": [*(name for name in before["merged"] if name not in small), merged],
        # Appends that stand in merged folders, as long as they are not deleted.
        "held": [*(name for name in before["held"] if storage.exists(spark, f"{path}/{name}")), *appended],
        "replaced": small,
    }
    try:
        storage.create_text(spark, f"{path}/{MANIFEST}/v{version:012d}", json.dumps(manifest))
    except FileExistsError:
        storage.delete(spark, f"{path}/{merged}")
        raise
    # Of the version before this one's; its own is still being read.
    for name in (*before["held"], *before["replaced"]):
        storage.delete(spark, f"{path}/{name}")
    return len(folders)
