from placeframe.session import ensure_checkpoint_dir, fresh_dir, shared_root


def test_scratch_lives_under_the_configured_checkpoint_dir(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    root = shared_root(spark)
    if configured:
        assert root == configured.rstrip("/")
    assert ensure_checkpoint_dir(spark)
    a, b = fresh_dir(spark, "x"), fresh_dir(spark, "x")
    assert a != b and a.startswith(root + "/placeframe/x-")


def test_session_defaults(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.ui.enabled") == "false"
