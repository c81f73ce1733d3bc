from footfall.session import ensure_utc, scratch_path, shared_dir


def test_shared_dir_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert shared_dir(spark) == configured
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(shared_dir(spark))


def test_ensure_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    ensure_utc(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
