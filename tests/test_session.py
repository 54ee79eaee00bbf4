import os
import types

import pytest

from stationflow import session


class Settings(dict):
    def set(self, key, value):
        self[key] = value


def fake(master, **settings):
    return types.SimpleNamespace(conf=Settings(settings), sparkContext=types.SimpleNamespace(master=master))


def test_shared_dir():
    named = fake("spark://host:7077", **{"spark.checkpoint.dir": "hdfs://store/work"})
    assert session.shared_dir(named) == "hdfs://store/work"
    assert session.work_dir(named, "x").startswith("hdfs://store/work/x-")
    with pytest.raises(ValueError):
        session.shared_dir(fake("spark://host:7077"))
    local = fake("local[2]")
    assert session.shared_dir(local) == session.shared_dir(local)


def test_written_and_released(spark):
    frame = session.written(spark.range(10).selectExpr("id * 2 AS x"), "test")
    assert frame.count() == 10 and "Range" not in frame._jdf.queryExecution().optimizedPlan().toString()
    folder = session._FOLDERS[-1][1]
    session.release()
    assert not os.path.exists(folder.removeprefix("file:")) and not session._FOLDERS


def test_released_since_a_mark(spark):
    first = session.written(spark.range(3), "first")
    since = session.mark()
    second, third = session.written(spark.range(4), "second"), session.written(spark.range(5), "third")
    session.release(since, keep=[third])
    assert first.count() == 3 and third.count() == 5
    assert not os.path.exists(second._work_folder.removeprefix("file:")) and session.mark() == since + 1
