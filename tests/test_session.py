from haulage.session import SCALE_CONF, ensure_checkpoint_dir


def test_checkpoint_dir_comes_from_session(spark):
    # The session already names a checkpoint directory (spark-defaults or the
    # test builder); ensure_checkpoint_dir returns it and never replaces it.
    before = spark.sparkContext.getCheckpointDir()
    assert before
    assert ensure_checkpoint_dir(spark) == before
    assert spark.sparkContext.getCheckpointDir() == before


def test_scale_conf_enables_adaptive_skew_handling(spark):
    assert SCALE_CONF["spark.sql.adaptive.enabled"] == "true"
    assert SCALE_CONF["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    assert spark.conf.get("spark.ui.enabled") == "false"
