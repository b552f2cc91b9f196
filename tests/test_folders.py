"""Scratch folders."""

import os
from types import SimpleNamespace

import pytest

from strata import folders


def test_scratch_is_removed_when_asked(spark):
    folders.remove_scratch(spark)
    path = folders.scratch(spark)
    spark.range(3).write.parquet(path)
    unused = folders.scratch(spark)
    assert os.path.isdir(path) and path != unused
    assert folders.remove_scratch(spark) == 2
    assert not os.path.exists(path)
    assert folders.remove_scratch(spark) == 0


class Cluster:
    """A session that says it runs on a cluster."""

    def __init__(self, **settings):
        self.conf = SimpleNamespace(get=lambda name, *default: settings.get(name, *default))
        local = SimpleNamespace(isLocal=lambda: False)
        self.sparkContext = SimpleNamespace(_jsc=SimpleNamespace(sc=lambda: local))


def test_the_machines_own_disks_are_refused_on_a_cluster():
    own = {"spark.sql.warehouse.dir": "file:/tmp/warehouse"}
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        folders.scratch(Cluster(**own))
    assert folders.scratch(Cluster(**own, **{"spark.checkpoint.dir": "file:/shared/"})).startswith("file:/shared/strata-")
    assert folders.scratch(Cluster(**{"spark.sql.warehouse.dir": "viewfs://store/w"})).startswith("viewfs://store/w/")
