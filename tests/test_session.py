"""The shared folder."""

import os

import pytest

from tallyframe import session


class Far:
    """A session of a cluster without a shared folder."""

    class conf:  # noqa: N801
        @staticmethod
        def get(_, default=None):
            return default

    class sparkContext:  # noqa: N801
        master = "spark://there:7077"


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Far())


def test_folders_are_removed_when_asked(spark):
    held = session.cut_lineage(spark.range(5))
    path = session._made[-1]
    assert held.count() == 5 and os.path.isdir(path)
    session.clear(spark)
    assert not os.path.exists(path) and not session._made


def test_costly_rows_go_to_more_tasks_where_the_table_is_larger(spark):
    cores = spark.sparkContext.defaultParallelism
    few, many = session.spread(spark.range(0, 100, 1, 2)), session.spread(spark.range(0, 100, 1, 3 * cores))
    assert few.rdd.getNumPartitions() == session.SPREAD * cores and many.rdd.getNumPartitions() == session.SPREAD * 3 * cores
    assert few.count() == many.count() == 100
