"""JDBC readers and writers: what they ask of Spark. No database is involved."""

from unittest.mock import MagicMock

from changeflow.sources.jdbc import jdbc_scan, jdbc_scan_shards, jdbc_write


def test_plain_read():
    spark = MagicMock()
    jdbc_scan(spark, "jdbc:x", "t", "id long, v string", fetch=5)
    spark.read.jdbc.assert_called_once_with(
        "jdbc:x", "t", properties={"fetchsize": "5", "customSchema": "id long, v string"})


def test_each_condition_is_a_partition():
    spark = MagicMock()
    jdbc_scan(spark, "jdbc:x", "t", predicates=["id BETWEEN 0 AND 4", "id BETWEEN 5 AND 9"])
    assert spark.read.jdbc.call_args.kwargs["predicates"] == [
        "id BETWEEN 0 AND 4", "id BETWEEN 5 AND 9"]


def test_every_shard_is_read_over_the_whole_range():
    spark = MagicMock()
    jdbc_scan_shards(spark, ["jdbc:a", "jdbc:b"], "t", "id", 0, 9, 3)
    calls = [(c.args[0], c.kwargs["predicates"]) for c in spark.read.jdbc.call_args_list]
    assert calls == [("jdbc:a", ["id BETWEEN 0 AND 9"]),
                     ("jdbc:b", ["id BETWEEN 0 AND 4", "id BETWEEN 5 AND 9"])]


def test_write_appends_in_batches():
    df = MagicMock()
    jdbc_write(df, "jdbc:x", "t", batch=500, connections=4)
    df.repartition.assert_called_once_with(4)
    df.repartition.return_value.write.jdbc.assert_called_once_with(
        "jdbc:x", "t", mode="append", properties={"batchsize": "500"})
