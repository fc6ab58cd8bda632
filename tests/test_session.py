"""Where intermediate tables go."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from tidewarden.session import fresh_folder, shared_folder


def session(master, folder=None, application="app-1"):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: folder if key == "spark.checkpoint.dir" else default),
        sparkContext=SimpleNamespace(master=master, applicationId=application),
    )


def test_the_setting_is_used_as_it_is():
    assert shared_folder(session("yarn", "hdfs://name/shared/")) == "hdfs://name/shared"
    one, other = (fresh_folder(session("yarn", "/shared"), "x") for _ in range(2))
    assert one.startswith("/shared/x-") and one != other


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[3,2,1024]"])
def test_a_cluster_must_name_a_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session(master))


def test_a_local_master_gets_one_private_folder_per_application():
    assert shared_folder(session("local[4]")) == shared_folder(session("local[4]"))
    assert shared_folder(session("local[4]")) != shared_folder(session("local[4]", application="app-2"))


def test_queries_run_without_the_setting(spark, monkeypatch):
    """The session itself cannot unset it, so the lookup is made to miss."""
    kind = type(spark.conf)
    plain = kind.get
    monkeypatch.setattr(kind, "get", lambda self, key, *a: None if key == "spark.checkpoint.dir" else plain(self, key, *a))
    folder = fresh_folder(spark, "rows")
    spark.range(3).write.parquet(folder)
    assert spark.read.parquet(folder).count() == 3
