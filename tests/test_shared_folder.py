"""Where cut points are written."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from adlens.sources.materialise import shared_folder


def session(master, folder=None, checkpoint=None):
    made = []
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: made[0] if made else checkpoint, setCheckpointDir=made.append)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: folder), sparkContext=context)


def test_folder_of_the_session_comes_first(tmp_path):
    assert shared_folder(session("spark://host:7077", "/shared/x/")) == "/shared/x"
    assert shared_folder(session("yarn", None, "/set/before")) == "/set/before"


def test_a_cluster_without_a_shared_folder_is_an_error():
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,3000]"):
        with pytest.raises(RuntimeError):
            shared_folder(session(master))
    assert "adlens-" in shared_folder(session("local[2]"))
