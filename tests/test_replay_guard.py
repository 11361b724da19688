"""Repeated and late rows of a stream, each left out and counted, whatever is run again."""

import pytest
from pyspark.sql import functions as F

from logwarden.operators.ingest import clean_logs
from logwarden.streaming.replay_guard import ReplayGuard
from tests.test_feature_stream import SCHEMA, follow, request, write


def batch(spark, rows):
    return clean_logs(spark.createDataFrame(rows, SCHEMA))


def ids(frame):
    return sorted(r.row_id for r in frame.collect())


def counts(guard, spark):
    return [(r.received, r.admitted, r.repeats, r.late) for r in guard.counts(spark).orderBy("batch_id").collect()]


NO_TIME = (9, "n/a", *request(9, 0)[2:])
BATCHES = [
    [request(1, 0), request(2, 30), request(2, 30), NO_TIME],
    [request(2, 30), request(3, 100), NO_TIME],        # row 2 and the row without time come again
    [request(1, 0), request(4, 95), request(5, 200)],  # row 1 is more than a minute behind 100
    [request(5, 200), request(3, 100), request(6, 150)],
    [],
    [request(6, 150), request(7, 500)],
]
ADMITTED = [[1, 2, 9], [3], [4, 5], [6], [], [7]]
COUNTED = [(4, 3, 1, 0), (3, 1, 2, 0), (3, 2, 0, 1), (3, 1, 1, 1), (0, 0, 0, 0), (2, 1, 1, 0)]


def test_repeats_and_late_rows(spark, tmp_path):
    guard = ReplayGuard(str(tmp_path), ["row_id"], 60)
    for number, rows in enumerate(BATCHES):
        assert ids(guard.admit(batch(spark, rows), number)) == ADMITTED[number], number
    assert counts(guard, spark) == COUNTED
    assert ids(guard.late_rows(spark)) == [1, 3]
    # the last batches run again, by a process that starts anew
    again = ReplayGuard(str(tmp_path), ["row_id"], 60)
    for number in (4, 5):
        assert ids(again.admit(batch(spark, BATCHES[number]), number)) == ADMITTED[number]
    assert counts(again, spark) == COUNTED
    with pytest.raises(ValueError, match="before 9"):
        again.admit(batch(spark, []), 9)


def test_on_a_stream(spark, tmp_path):
    guard, seen = ReplayGuard(f"{tmp_path}/guard", ["row_id"], 60), []
    for number, rows in enumerate(BATCHES[:3]):
        write(spark, rows, f"{tmp_path}/in", f"part{number}")
        guard.start(follow(spark, f"{tmp_path}/in"), lambda b, i: seen.append((i, ids(b))), f"{tmp_path}/checkpoint").awaitTermination()
    assert seen == list(enumerate(ADMITTED[:3]))
    assert guard.counts(spark).agg(F.sum("late"), F.sum("repeats")).first()[:] == (1, 3)
