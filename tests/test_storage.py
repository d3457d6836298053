import threading

import pytest

from pixelloom.sources import storage


class Elsewhere:
    """A session of a cluster that names no shared folder."""

    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        master = "spark://host:7077"


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_dir(Elsewhere)


def test_concurrent_writers_leave_the_session_as_it_was(spark):
    before = spark.conf.get(storage._CLEANUP)
    out = []
    jobs = [threading.Thread(target=lambda k=k: out.append(storage.materialise(spark.range(10 + k), "t").count())) for k in range(4)]
    for j in jobs:
        j.start()
    for j in jobs:
        j.join()
    assert sorted(out) == [10, 11, 12, 13] and spark.conf.get(storage._CLEANUP) == before
