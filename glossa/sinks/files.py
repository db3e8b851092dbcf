"""Writers: log CSV export (K1), patched documents (K3), preview (K4), publish (K5).

Sources are never patched in place (T2): every output goes to a fresh folder and is
published by writing a small manifest file last, so readers see all or nothing.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.records import run_rank
from ..schemas import LOG_CSV_COLUMNS
from ..session import TEXT_CODEC, exists, write_small_file
from . import manifests

CSV_WRITE_OPTIONS = {
    "header": "true", "quote": '"', "escape": '"', "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    "encoding": "UTF-8", "quoteAll": "false",
}


def write_log_csv(log: DataFrame, path: str, single_file: bool = False) -> None:
    """K1: the 6-column CSV with header; NULL ``string_id`` is written as ''.

    Rows are ranged by log order, so the numbered part files follow each other in it.
    ``single_file`` funnels the export through one task (only for small exports meant for
    a spreadsheet)."""
    order = [c for c in ("run_id", "batch_id", "pos", "variant_idx") if c in log.columns]
    if "run_id" in order:
        log = log.withColumn("run_id", run_rank())
    out = log.select(*order, *[F.coalesce(F.col(c), F.lit("")).alias(c) if c == "string_id"
                               else F.col(c) for c in LOG_CSV_COLUMNS])
    if single_file:
        out = out.coalesce(1)
    elif order:
        out = out.repartitionByRange(*order)
    if order:
        out = out.sortWithinPartitions(*order)
    out.select(*LOG_CSV_COLUMNS).write.mode("errorifexists").options(**CSV_WRITE_OPTIONS).csv(path)


def write_documents(rebuilt: DataFrame, root: str, version: str | None = None) -> str:
    """K3: patched documents as a (filepath, content) Parquet table under a new version
    folder; returns the folder.  Files themselves can be exported from it with
    :func:`export_files`."""
    version = version or uuid.uuid4().hex
    out = f"{root.rstrip('/')}/version={version}"
    rebuilt.select("filepath", "content").write.mode("errorifexists").parquet(out)
    publish(rebuilt.sparkSession, out, {"kind": "documents", "version": version})
    return out


def export_files(rebuilt: DataFrame, root: str) -> DataFrame:
    """Write each document to ``root/filepath`` on the executors (shared file system),
    each through a temporary file and an atomic rename (K5).  Returns (filepath, ok)."""
    import pandas as pd

    def write(batches):
        for pdf in batches:
            ok = []
            for fp, content in zip(pdf["filepath"], pdf["content"]):
                target = os.path.normpath(os.path.join(root, fp))
                if os.path.isabs(fp) or not target.startswith(os.path.normpath(root) + os.sep):
                    ok.append(False)  # a path that leaves the root is not written
                    continue
                os.makedirs(os.path.dirname(target), exist_ok=True)
                tmp = f"{target}.{uuid.uuid4().hex}.tmp"
                try:
                    with open(tmp, "w", encoding="utf-8") as f:
                        f.write(content)
                    os.replace(tmp, target)
                    ok.append(True)
                except OSError:
                    if os.path.exists(tmp):
                        os.unlink(tmp)
                    ok.append(False)
            yield pd.DataFrame({"filepath": pdf["filepath"], "ok": ok})

    return rebuilt.select("filepath", "content").mapInPandas(write, "filepath string, ok boolean")


def publish(spark: SparkSession, folder: str, meta: dict) -> None:
    """K5: mark a completed output folder, in any file system, by writing its manifest
    last (written aside, then renamed)."""
    if not exists(spark, folder):
        raise FileNotFoundError(f"nothing to publish at {folder}")
    write_small_file(spark, f"{folder.rstrip('/')}/_MANIFEST.json", json.dumps(meta))


class VersionConflict(RuntimeError):
    """Another writer has published since the version that this one started from."""


def published_number(spark: SparkSession, root: str) -> int:
    """Number of the version that readers see; -1 without one."""
    return manifests.newest(spark, root)[0]


def publish_version(spark: SparkSession, root: str, version: str, expected: int | None = None) -> int:
    """K5: make the folder ``version=<version>`` what readers of ``root`` see.

    ``expected`` is the number the writer started from (:func:`published_number`); if
    another version has been published since, nothing changes and VersionConflict is
    raised.  Without it the newest number is taken.  Returns the new number."""
    if not exists(spark, f"{root.rstrip('/')}/version={version}"):
        raise FileNotFoundError(f"no version {version} at {root}")
    seen = published_number(spark, root) if expected is None else expected
    if published_number(spark, root) != seen or not manifests.commit(spark, root, seen + 1, {"version": version}):
        raise VersionConflict(f"{root}: version {seen} is no longer the newest")
    return seen + 1


def read_published(spark: SparkSession, root: str, number: int | None = None) -> DataFrame | None:
    """The rows of the published version (or of an earlier ``number``); None without one.
    Folders that were never published, torn ones included, are not seen."""
    newest, body = manifests.newest(spark, root)
    if number is not None and number != newest:
        body = manifests.read(spark, root, number)
    return None if body is None else spark.read.parquet(f"{root.rstrip('/')}/version={body['version']}")


def write_published(df: DataFrame, root: str, expected: int | None = None) -> int:
    """Write ``df`` as a new version of ``root`` and publish it; returns its number."""
    version = uuid.uuid4().hex
    df.write.mode("errorifexists").option("compression", TEXT_CODEC).parquet(f"{root.rstrip('/')}/version={version}")
    return publish_version(df.sparkSession, root, version, expected)
