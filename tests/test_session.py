import pytest
from pyspark.sql import functions as F

from tallymark.session import ensure_checkpoint_dir, materialise, spread


def test_spread_only_where_needed(spark):
    parts = lambda df: df.rdd.getNumPartitions()
    assert parts(spread(spark.range(100).coalesce(1))) > 1
    many = spark.range(100, numPartitions=32)
    assert spread(many) is many
    shuffled = spark.range(100).groupBy("id").count()
    assert spread(shuffled) is shuffled


def test_tables_go_to_the_checkpoint_folder(spark):
    df = spark.range(10).withColumn("x", F.lit(None).cast("string"))
    back = materialise(df)
    assert back.schema.names == ["id", "x"] and back.count() == 10
    assert ensure_checkpoint_dir(spark).rstrip("/") in back.inputFiles()[0].replace("file://", "file:")


def test_setting_of_the_session_holds(spark):
    have = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    assert ensure_checkpoint_dir(spark) == have


def test_no_folder_of_one_machine_on_a_cluster(monkeypatch):
    """Without spark.checkpoint.dir only a local master gets a folder of its own."""

    class Context:
        master = "spark://host:7077"
        _jsc = type("J", (), {"sc": lambda self: type("S", (), {"getCheckpointDir": lambda self: type("O", (), {"isDefined": lambda self: False})()})()})()

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": lambda self, name, default=None: default})()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())
