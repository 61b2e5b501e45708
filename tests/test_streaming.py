from chatmill.streaming import operators as S
from pyspark.sql import functions as F


def run(spark, stream, name):
    q = stream.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)


def test_streams(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1, 0, "Одинаковый текст"), (1, 2, 60, "одинаковый ТЕКСТ"), (1, 3, 4000, "другой"), (1, 4, 400_000, "последний")], "chat_id long, msg_id long, s long, t string").withColumn("at", F.timestamp_seconds(F.col("s") + 1_000_000))
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    assert run(spark, S.deduplicated(stream(), "t", "at"), "s_dedup").count() == 3
    rows.union(rows).coalesce(1).write.parquet(str(tmp_path / "twice"))
    twice = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "twice"))
    assert run(spark, S.redeliveries(twice, ["chat_id", "msg_id"], "at"), "s_redelivered").count() == 4
    assert run(spark, S.bursts(stream(), "chat_id", "at"), "s_bursts").where("messages = 2").count() == 1
