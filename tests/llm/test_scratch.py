"""Where intermediate tables go."""

from types import SimpleNamespace

import pytest

from larder.llm.scratch import shared_dir


def session(master, named=None, there=None):
    made = []
    sc = SimpleNamespace(master=master, getCheckpointDir=lambda: made[-1] if made else there, setCheckpointDir=made.append)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: named), sparkContext=sc)


def test_the_shared_folder_counts():
    assert shared_dir(session("yarn", "s3a://x/y")) == "s3a://x/y"
    assert shared_dir(session("yarn", None, "hdfs://z")) == "hdfs://z"


def test_only_a_local_session_gets_a_temporary_one():
    assert shared_dir(session("local[8]"))
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://https://host"):
        with pytest.raises(ValueError, match="checkpoint"):
            shared_dir(session(master))
