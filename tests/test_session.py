from pathlib import Path

import pytest

from response_ledger.session import landed, scratch, scratch_path


class Session:
    """As much of a session as the choice of the scratch folder looks at."""

    def __init__(self, **settings):
        self.settings, self.conf = settings, self

    def get(self, name, default=None):
        return self.settings.get(name.replace("spark.", "").replace(".", "_"), default)


def test_the_named_folder_is_used():
    cluster = Session(checkpoint_dir="s3a://shared/scratch/", master="yarn")
    first, second = (scratch_path(cluster, "plan") for _ in range(2))
    assert first.startswith("s3a://shared/scratch/plan-") and first != second


def test_a_cluster_without_a_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(Session(master="spark://host:7077"), "plan")


def test_a_local_session_has_a_folder_of_its_own():
    first, second = (scratch_path(Session(master="local[2]"), name) for name in ("plan", "x"))
    assert Path(first).parent == Path(second).parent and Path(first).parent.is_dir()


def test_scratch_tables_go_with_their_block(spark):
    with pytest.raises(ValueError, match="stop"), scratch(spark):
        table = landed(spark.range(3), "three")
        (folder,) = {Path(name.removeprefix("file:")).parent for name in table.inputFiles()}
        assert folder.is_dir()
        raise ValueError("stop")
    assert not folder.exists()
