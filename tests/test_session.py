import os

import pytest

from pageloom import session


def folders(spark):
    root = f"{session.shared_dir(spark)}/pageloom"
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_scratch_leaves_nothing(spark, tmp_path):
    before = folders(spark)
    with session.scratch(spark):
        rows = session.materialize(spark.range(100), "numbers")
        assert folders(spark) != before
        session.stored(rows, str(tmp_path / "kept"))
    assert folders(spark) == before
    assert spark.read.parquet(str(tmp_path / "kept")).count() == 100


def test_scratch_after_a_failure_and_nested(spark):
    before = folders(spark)
    with pytest.raises(ValueError, match="stop"), session.scratch(spark):
        outer = session.materialize(spark.range(5), "outer")
        with session.scratch(spark):
            session.materialize(spark.range(5), "inner")
        assert outer.count() == 5
        raise ValueError("stop")
    assert folders(spark) == before


def test_folders_outside_of_a_block_stay(spark):
    rows = session.materialize(spark.range(3), "stays")
    with session.scratch(spark):
        pass
    assert rows.count() == 3


def test_one_temporary_folder_for_a_process(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return "local[1]" if key == "spark.master" else default

    class Session:
        conf = Conf()

    assert session.shared_dir(Session()) == session.shared_dir(Session())
    monkeypatch.setattr(Conf, "get", lambda self, key, default=None: "spark://x" if key == "spark.master" else default)
    with pytest.raises(RuntimeError, match="not set"):
        session.shared_dir(Session())
