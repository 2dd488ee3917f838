"""Staged tables belong to the application that made them."""

import os
from types import SimpleNamespace
from urllib.parse import urlparse

import pytest

from tallyrill.session import release, stage, staging_root


def test_release_removes_what_was_staged(spark):
    release(spark)
    staged = stage(spark.range(3))
    files = [urlparse(f).path for f in staged.inputFiles()]
    assert staged.count() == 3 and files and all(map(os.path.exists, files))
    assert release(spark) == 1 and not any(map(os.path.exists, files))
    assert release(spark) == 0


def unset(master):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: None), sparkContext=SimpleNamespace(master=master, applicationId=master))


def test_a_folder_of_this_machine_only_for_a_local_master():
    root = staging_root(unset("local[2]"))
    assert os.path.isdir(root) and staging_root(unset("local[2]")) == root
    with pytest.raises(RuntimeError, match="all executors share"):
        staging_root(unset("spark://there:7077"))
