"""Copies of files between stores, by the executors: what a sync or download plan names, whole or not at all."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame

COPIED = "key string, status string, target string, bytes long, error string"
PIECE = 8 << 20


def _copy(source: str, target: str, key: str, suffix: str) -> int:
    """Bytes copied. The copy is made beside its place and moved there, so readers never see a part of it."""
    a, from_ = fs.FileSystem.from_uri(f"{source.rstrip('/')}/{key}")
    b, to = fs.FileSystem.from_uri(f"{target.rstrip('/')}/{key}")
    b.create_dir(to.rpartition("/")[0], recursive=True)
    n = 0
    with a.open_input_stream(from_) as reader, b.open_output_stream(to + suffix) as writer:
        while piece := reader.read(PIECE):
            writer.write(piece)
            n += len(piece)
    b.move(to + suffix, to)
    return n


def copied(plan: DataFrame, source: str, *targets: str) -> DataFrame:
    """(key, status, target, bytes, error) of each key of a plan (key; action, if there: upload, keep or delete) after its copy from a source to the first target that takes it; deletions are made at all of them.

    The rows must be read once, as a table is written: each evaluation copies again, with the same outcome. Targets after the first are fallbacks; a key that none takes is an error row, as is one whose source can't be read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suffix = f".{TaskContext.get().taskAttemptId()}.tmp"
        for b in batches:
            rows = []
            for key, action in zip(*(c.to_pylist() for c in b.columns)):
                row = {"key": key, "status": "kept", "target": None, "bytes": 0, "error": None}
                if action == "delete":
                    for target in targets:
                        system, at = fs.FileSystem.from_uri(f"{target.rstrip('/')}/{key}")
                        if system.get_file_info(at).type != fs.FileType.NotFound:
                            system.delete_file(at)
                            row["target"] = target
                    row["status"] = "deleted"
                elif action != "keep":
                    row["status"] = "error"
                    for target in targets:
                        try:
                            row |= {"bytes": _copy(source, target, key, suffix), "status": "copied", "target": target}
                            break
                        except OSError as e:  # the next target may take it
                            row["error"] = f"{type(e).__name__}: {e}"
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("key", pa.string()), ("status", pa.string()), ("target", pa.string()), ("bytes", pa.int64()), ("error", pa.string())]))

    if not targets:
        raise ValueError("a copy needs a target")
    wanted = plan.selectExpr("key", "action" if "action" in plan.columns else "'upload' as action")
    return wanted.mapInArrow(run, COPIED)
