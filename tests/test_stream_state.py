"""The vehicle stream keeps state for vehicles that have events, not for all of them."""

from pyspark.sql import functions as F

from ridewright.streaming import lifecycle


def test_idle_vehicles_cost_no_state(spark, folder):
    schema = "vehicle_id bigint, event_id bigint, ts timestamp, flow string, kind string"
    rows = spark.sql("select 3L vehicle_id, 1L event_id, timestamp '2024-01-01 00:00:00' ts, 'garage' flow, 'request' kind")
    rows.unionByName(rows.withColumn("vehicle_id", F.lit(700).cast("long"))).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
    vehicles = spark.range(200).select(F.col("id").alias("vehicle_id"), F.lit("notavailable").alias("status"))
    out = lifecycle.replay_stream(stream, vehicles.unionByName(vehicles))
    query = out.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/c")
    query = query.trigger(availableNow=True).start()
    query.awaitTermination()
    assert sum(s["numRowsTotal"] for p in query.recentProgress[-1:] for s in p["stateOperators"]) == 2
    found = {r.vehicle_id: (r.status_before, r.accepted) for r in spark.read.parquet(f"{folder}/out").collect()}
    assert found == {3: ("notavailable", True), 700: ("available", False)}
