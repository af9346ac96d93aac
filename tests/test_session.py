import pytest

from tradelens import session as SS


def test_checkpoint_dir_is_read_not_replaced(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert SS.ensure_checkpoint_dir(spark) == configured
    a, b = SS.scratch_path(spark, "x"), SS.scratch_path(spark, "x")
    assert a != b and a.startswith(configured)


class _Conf:
    def get(self, key, default=None):
        return default


class _Context:
    def __init__(self, master="local[2]"):
        self.dir, self.master = None, master

    def getCheckpointDir(self):  # noqa: N802
        return self.dir

    def setCheckpointDir(self, d):  # noqa: N802
        self.dir = d


class _Session:
    def __init__(self, master="local[2]"):
        self.conf, self.sparkContext = _Conf(), _Context(master)


def test_unset_checkpoint_dir_gets_a_local_folder_on_the_context():
    fake = _Session()
    got = SS.ensure_checkpoint_dir(fake)
    assert got and fake.sparkContext.dir == got
    assert SS.ensure_checkpoint_dir(fake) == got


def test_unset_checkpoint_dir_raises_on_a_cluster():
    for master in ("local-cluster[2,1,1024]", "spark://host:7077", "yarn"):
        with pytest.raises(RuntimeError):
            SS.ensure_checkpoint_dir(_Session(master))


def test_apply_recommended_sets_what_it_says(spark):
    before = {k: spark.conf.get(k, None) for k in SS.RECOMMENDED_CONF}
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "1k")
        SS.apply_recommended(spark)
        assert spark.conf.get("spark.sql.ansi.enabled") == "true"
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
        assert spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold") == "1k"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_session_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
