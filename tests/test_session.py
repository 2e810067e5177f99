import os
from types import SimpleNamespace

import pytest

from tapelake import session


def test_written_tables_are_released(spark):
    session.release(spark)
    df = session.materialize(spark.range(5))
    path = session._WRITTEN[-1][1]
    assert df.count() == 5 and os.path.isdir(path) and path.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert session.release(spark) == 1 and not os.path.exists(path)


def test_a_cluster_must_name_its_folder():
    def fake(master, folder=None):
        conf = SimpleNamespace(get=lambda k, d=None: folder if k == "spark.checkpoint.dir" else d)
        return SimpleNamespace(sparkContext=SimpleNamespace(master=master, getConf=lambda: conf), conf=conf)

    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            session.shared_folder(fake(master))
    assert session.shared_folder(fake("yarn", "/shared/")) == "/shared"
    assert os.path.isdir(session.shared_folder(fake("local[2]")))
