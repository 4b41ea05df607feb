"""The stream of messages and calls: each message once, state that does not grow, late rows counted."""

import datetime as dt

import pytest

from millrace.streaming import traces as T
from tests.conftest import rows

MESSAGES, CALLS = "m long, u long, said timestamp", "c long, u long, called timestamp, ms long"


def at(minutes):
    return dt.datetime(2024, 3, 1) + dt.timedelta(minutes=minutes)


def run(spark, tmp_path, messages, calls):
    for data, schema, name in ((messages, MESSAGES, "m"), (calls, CALLS, "c")):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
    query = T.start_trace(spark.readStream.schema(MESSAGES).parquet(str(tmp_path / "m")), spark.readStream.schema(CALLS).parquet(str(tmp_path / "c")),
                          "u", "said", "called", str(tmp_path / "out"), "10 minutes", "30 minutes")
    query.awaitTermination()
    return query


def table(spark, tmp_path):
    return T.trace_table(spark, str(tmp_path / "out"), ["m", "u", "said"], "said", "called", "c", ["ms"])


@pytest.fixture(scope="module")
def streamed(spark, tmp_path_factory):
    """A day of messages every ten minutes in four batches; every third message has two calls."""
    path = tmp_path_factory.mktemp("trace")
    held, batches = [], []
    for part in range(4):
        stretch = range(part * 36, part * 36 + 36)
        messages = [(i, i % 2, at(10 * i)) for i in stretch]
        calls = [(10 * i + k, i % 2, at(10 * i + 3 + k), i) for i in stretch if i % 3 == 0 for k in (1, 0)]
        held.append(T.held_rows(run(spark, path, messages, calls)))
        batches.append(rows(table(spark, path).select("m")))
    last = run(spark, path, [(None, 0, at(5000))], [(None, 0, at(5000), None)])
    late = run(spark, path, [(None, 0, at(9000)), (501, 0, at(200))], [(None, 0, at(9000), None)])
    return path, held, batches, T.held_rows(last), T.dropped_rows(late)


def test_each_message_once_with_its_first_call(spark, streamed):
    path, _, batches, _, _ = streamed
    expected = [(i, i % 2, at(10 * i), at(10 * i + 3), 10 * i, i, 180.0) if i % 3 == 0 else (i, i % 2, at(10 * i), None, None, None, None) for i in range(144)]
    assert rows(table(spark, path).filter("m < 500")) == sorted(expected, key=str)
    for before, later in zip(batches, batches[1:]):
        assert set(before) <= set(later)
    alone = spark.read.parquet(str(path / "out" / "changes")).filter("c IS NULL AND m IS NOT NULL")
    assert alone.count() == alone.select("m").distinct().count()


def test_state_is_bounded(streamed):
    _, held, _, after, _ = streamed
    assert max(held[1:]) <= held[0] + 10 and held[-1] < 144 and after <= 2


def test_late_rows_are_counted(spark, streamed):
    path, _, _, _, dropped = streamed
    assert dropped == 1 and rows(table(spark, path).filter("m = 501")) == []  # it came after the streams had passed by days


def test_without_batches(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        table(spark, tmp_path)
