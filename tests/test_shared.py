from __future__ import annotations

import types

import pytest

from feira.sources.shared import shared_folder


def session(folder, master):
    return types.SimpleNamespace(
        conf=types.SimpleNamespace(get=lambda key, default: folder),
        sparkContext=types.SimpleNamespace(master=master),
    )


def test_named_folder_is_used():
    assert shared_folder(session("hdfs://nn/ck/", "yarn")) == "hdfs://nn/ck"


def test_cluster_without_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session(None, "yarn"))


def test_local_session_gets_its_own():
    first = shared_folder(session(None, "local[2]"))
    assert first and shared_folder(session(None, "local[*]")) == first
