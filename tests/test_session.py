from costindex.session import CLUSTER_CONF, ensure_checkpoint_dir, shared_root, stage_table


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert ensure_checkpoint_dir(spark) == configured
    assert shared_root(spark, "x").startswith(configured.rstrip("/") + "/costindex/")


def test_stage_table_round_trips_under_the_shared_folder(spark):
    df = spark.range(5)
    staged = stage_table(df, "t")
    assert sorted(r.id for r in staged.collect()) == [0, 1, 2, 3, 4]
    root = ensure_checkpoint_dir(spark).rstrip("/")
    assert any(root.split(":")[-1] in f for f in staged.inputFiles())


def test_cluster_conf_keeps_aqe_and_skew_handling_on():
    assert CLUSTER_CONF["spark.sql.adaptive.enabled"] == "true"
    assert CLUSTER_CONF["spark.sql.adaptive.skewJoin.enabled"] == "true"
