from __future__ import annotations

from types import SimpleNamespace

import pytest

from rillflow.session import in_one_process, shared_folder


def test_masters():
    assert in_one_process("local") and in_one_process("local[*]") and in_one_process("local[4,2]")
    assert not in_one_process("local-cluster[2,1,1024]") and not in_one_process("yarn")


def test_cluster_needs_a_shared_folder():
    context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    session = SimpleNamespace(
        sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: default)
    )
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session)
