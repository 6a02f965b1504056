"""Entries that are written once: versions, ids and claims of files."""

import threading

from shelfwise.session import local_path
from shelfwise.sources.journal import Folder, Journal
from shelfwise.streaming.claims import claim_files, reserve_ids


def test_entries_are_numbered_and_kept(spark, scratch):
    journal = Journal(spark, scratch("journal"))
    assert journal.last() is None and journal.numbers() == []
    for k in range(5):
        assert journal.append(lambda last, k=k: {"k": k, "before": last and last["k"]})["k"] == k
    assert [e["before"] for e in journal.newest_first()] == [3, 2, 1, 0, None]
    assert journal.append(lambda last: None) is None and journal.last()["k"] == 4
    assert journal.prune(2) == 3 and journal.numbers() == [4, 5]
    assert journal.append(lambda last: {"k": 9}) and journal.numbers() == [4, 5, 6]


def test_the_loser_of_a_number_decides_anew(spark, scratch):
    path = scratch("race")
    one, other = Journal(spark, path), Journal(spark, path)
    seen = []

    def decide(last):
        seen.append(last)
        if len(seen) == 1:  # another writer is faster
            other.append(lambda last: {"by": "other"})
        return {"by": "one"}

    one.append(decide)
    assert seen == [None, {"by": "other"}]
    assert [e["by"] for e in one.newest_first()] == ["one", "other"]


def test_writers_at_the_same_time_share_no_id(spark, scratch):
    path, got, errors = scratch("ids"), {}, []

    def write(stream):
        try:
            for batch in range(12):
                got[stream, batch] = reserve_ids(spark, path, stream, batch, 10 + batch)
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=write, args=(f"s{k}",)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    ids = sorted(i for (_, b), first in got.items() for i in range(first, first + 10 + b))
    assert ids == list(range(1, len(ids) + 1))
    # whatever came between, a batch run again has its range
    for (stream, batch), first in got.items():
        assert reserve_ids(spark, path, stream, batch, 10 + batch) == first


def test_batches_without_lines_claim_nothing(spark, scratch):
    path = scratch("none")
    assert reserve_ids(spark, path, "a", 0, 0) == 1 and reserve_ids(spark, path, "a", 1, 3) == 1
    assert reserve_ids(spark, path, "b", 0, 1) == 4 and reserve_ids(spark, path, "a", 0, 0) == 1


def test_a_file_is_held_by_one_batch(spark, scratch):
    path = scratch("files")
    assert claim_files(spark, path, "a", 0, ["x", "y"]) == ["x", "y"]
    assert claim_files(spark, path, "b", 0, ["y", "z"]) == ["z"]
    assert claim_files(spark, path, "a", 0, ["x", "y"]) == ["x", "y"]
    assert claim_files(spark, path, "a", 1, ["x"]) == []


def test_other_file_systems_create_if_absent_too(spark, scratch):
    """The way through Hadoop, as on a file system that is not local."""
    folder = Folder(spark, "file:" + local_path(scratch("hadoop")))
    folder.local = None
    assert folder.names() == []
    assert folder.create("one", "first é") and not folder.create("one", "second")
    assert folder.read("one") == "first é" and folder.names() == ["one"]
    folder.delete("one")
    assert folder.names() == []
