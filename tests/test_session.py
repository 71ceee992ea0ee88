from appraise.session import ensure_checkpoint_dir, scratch_path


def test_scratch_lives_under_the_session_checkpoint_dir(spark):
    current = spark.sparkContext.getCheckpointDir()
    assert current
    # an existing setting is read, never replaced
    assert ensure_checkpoint_dir(spark) == current
    assert spark.sparkContext.getCheckpointDir() == current
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(current) and b.startswith(current) and a != b
