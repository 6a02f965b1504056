"""What a batch must settle once and find again when it is replayed.

* Line ids: a batch claims a range of ids in a journal before it writes.  Ranges of all
  streams into one table follow each other without gaps between them and never overlap, and
  a replayed batch reads its claim.
* Landed files: a batch claims each of its files in the version that it writes to, so
  a file enters a version once, whichever stream, load or replay brings it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable

from pyspark.sql import SparkSession

from ..sources.journal import Journal, Folder


def reserve_ids(spark: SparkSession, path: str, stream: str, batch_id: int, n: int) -> int:
    """The first of the ``n`` ids that this batch has in the journal at ``path``."""
    journal = Journal(spark, path)
    for entry in journal.newest_first():
        if entry["stream"] == stream:
            if entry["batch"] == batch_id:
                if entry["last"] - entry["first"] + 1 != n:
                    raise ValueError(f"batch {batch_id} of {stream} has {n} lines and claimed {entry}")
                return entry["first"]
            if entry["batch"] < batch_id:
                break  # a stream claims in the order of its batches

    def claimed(last: dict | None) -> dict:
        first = (last["last"] if last else 0) + 1
        return {"stream": stream, "batch": batch_id, "first": first, "last": first + n - 1}

    return journal.append(claimed)["first"]


def claim_files(spark: SparkSession, path: str, stream: str, batch_id: int, files: Iterable[str]) -> list[str]:
    """Those of ``files`` that this batch holds: claimed now or when it ran before."""
    folder, own = Folder(spark, path), json.dumps({"stream": stream, "batch": batch_id})
    held = []
    for file in files:
        name = hashlib.sha256(file.encode("utf-8")).hexdigest()
        if folder.create(name, own) or folder.read(name) == own:
            held.append(file)
    return held
