from strata.session import checkpoint_dir, ensure_checkpoint_dir, scratch_path


def test_checkpoint_dir_is_read_not_overridden(spark):
    before = checkpoint_dir(spark)
    assert before is not None
    assert ensure_checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()
    assert checkpoint_dir(spark) == before          # a second call changes nothing


def test_scratch_paths_are_fresh_and_under_the_checkpoint_folder(spark):
    base = ensure_checkpoint_dir(spark).rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(base) and b.startswith(base)


def test_ui_is_off(spark):
    assert spark.conf.get("spark.ui.enabled") == "false"
