"""The shared folder and the number of state partitions."""

from types import SimpleNamespace

import pytest

from footfall.session import LOCAL_FOLDER, shared_folder, state_partitions


def session(master, **conf):
    return SimpleNamespace(
        sparkContext=SimpleNamespace(master=master, defaultParallelism=3),
        conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d), set=conf.__setitem__),
        settings=conf,
    )


def test_a_cluster_must_name_its_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("spark://host:7077"), "x")
    name = "spark.checkpoint.dir"
    assert shared_folder(session("yarn", **{name: "hdfs:///shared/"}), "x").startswith("hdfs:///shared/footfall/x-")
    assert shared_folder(session("local[4]"), "x").startswith(LOCAL_FOLDER)


def test_a_chosen_number_of_partitions_stays():
    name = "spark.sql.shuffle.partitions"
    for master, before, inside in (("local[3]", "200", "3"), ("local[3]", "7", "7"), ("yarn", "200", "200")):
        fake = session(master, **{name: before})
        with state_partitions(fake):
            assert fake.settings[name] == inside
        assert fake.settings[name] == before


def test_the_test_session_names_a_folder(spark):
    assert spark.conf.get("spark.checkpoint.dir")
