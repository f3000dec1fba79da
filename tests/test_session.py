from types import SimpleNamespace

import pytest

from pingloom import session


def fake(master, configured=None, application="app-1"):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: configured or default),
        sparkContext=SimpleNamespace(master=master, applicationId=application),
    )


def test_cluster_names_the_folder():
    assert session.shared_dir(fake("spark://host:7077", "s3a://bucket/shared/")) == "s3a://bucket/shared"


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        session.shared_dir(fake("yarn"))


def test_local_fallback_is_one_folder_per_application():
    assert session.shared_dir(fake("local[2]")) == session.shared_dir(fake("local[2]"))


def test_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")
