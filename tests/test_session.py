import os

from municare import session, storage


def test_shared_folder_is_new_and_below_the_checkpoint_folder(spark):
    one, two = session.shared_folder(spark, "a"), session.shared_folder(spark, "a")
    root = session._checkpoint_root(spark) or one.rsplit("/", 1)[0]
    assert one != two and one.startswith(f"{root.rstrip('/')}/a-")


def test_shuffles_follow_the_input(spark, folder):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.range(100_000).write.parquet(folder)
        bytes_ = storage.size(spark, folder)
        assert session.size_shuffles(spark, folder) == spark.sparkContext.defaultParallelism
        few = session.size_shuffles(spark, folder, expansion=1, target_bytes=bytes_ // 100)
        assert 100 <= few <= 101
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(few)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_settings_apply_to_a_running_session(spark):
    assert session.configure(spark).conf.get("spark.sql.ansi.enabled") == "true"


def test_local_session_without_a_checkpoint_folder(spark, monkeypatch):
    monkeypatch.setattr(session, "_checkpoint_root", lambda _: None)
    made = session.shared_folder(spark, "x")
    assert os.path.isdir(os.path.dirname(made))
    monkeypatch.undo()
    assert spark.sparkContext.getCheckpointDir()
