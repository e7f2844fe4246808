"""The checkpoint folder comes from the session; none is invented when one is set."""

from regpanel.session import checkpoint_dir, ensure_checkpoint_dir


def test_no_shared_folder_on_a_cluster_is_an_error():
    import pytest

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_checkpoint_dir_is_read_not_overridden(spark):
    configured = checkpoint_dir(spark)
    assert configured
    assert ensure_checkpoint_dir(spark, fallback="/nonexistent/should-not-be-used") == configured
    assert spark.sparkContext.getCheckpointDir() is not None
