from types import SimpleNamespace

import pytest

from contactloom import session


def test_stages_are_written_and_dropped(spark):
    df = session.stage(spark.range(5), "five")
    path = session._staged(spark)[-1]
    assert df.count() == 5 and path.startswith(session.shared_dir(spark))
    earlier = session.staged_so_far(spark) - 1
    assert session.drop_stages(spark, earlier) == 1 and session.staged_so_far(spark) == earlier
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(path).count()


def test_the_last_tables_can_stay(spark):
    earlier = session.staged_so_far(spark)
    _, _, last = (session.stage(spark.range(n), "some") for n in (1, 2, 3))
    assert session.drop_stages(spark, earlier, keep=1) == 2
    assert last.count() == 3 and session.staged_so_far(spark) == earlier + 1
    assert session.drop_stages(spark, earlier, keep=5) == 0 and last.count() == 3
    assert session.drop_stages(spark, earlier) == 1


def test_a_cluster_needs_a_shared_folder():
    def spark(master, conf=None, named=None):
        return SimpleNamespace(sparkContext=SimpleNamespace(master=master, getConf=lambda: SimpleNamespace(get=lambda _: conf), getCheckpointDir=lambda: named))

    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
            session.shared_dir(spark(master))
        assert session.shared_dir(spark(master, "hdfs://a/b/")) == "hdfs://a/b"
        assert session.shared_dir(spark(master, None, "hdfs://c")) == "hdfs://c"
    assert session.shared_dir(spark("local[4]")).startswith("file:///")
