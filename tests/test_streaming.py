from datetime import datetime

from conftest import page, rows
from test_ingest import fetch, incident, ms

from areascore.sources import tables
from areascore.streaming.counts import stream_counts, tumbling_counts, yearly_from_windows
from areascore.streaming.incremental import run_incremental


def test_incremental_runs_and_replay(spark, write, tmp_path):
    landing, raw, state = str(tmp_path / "land"), str(tmp_path / "raw"), str(tmp_path / "state")
    run = lambda mark: run_incremental(spark, landing, raw, str(tmp_path / mark), state)
    table = lambda: sorted(r[0] for r in rows(tables.read_raw(spark, raw, "crime"), "incident_occurred", "incident_type"))
    # A run while a fetch is landing sees nothing of it; the next one reads all its pages.
    fetch(write, "01", page(incident(ms(2024, 1, 5)), incident(ms(2024, 2, 1))), complete=False)
    run("ck")
    assert table() == []
    fetch(write, "01", page(incident(ms(2024, 1, 5)), incident(ms(2024, 2, 1))), page(incident(ms(2024, 2, 20))))
    run("ck")
    assert table() == [datetime(2024, 1, 5), datetime(2024, 2, 1), datetime(2024, 2, 20)]

    # Two fetches with overlapping lookback land before the next run; each repeats the range.
    again = [incident(ms(2024, 2, 1)), incident(ms(2024, 2, 10), kind="LATE"), incident(ms(2024, 2, 20)), incident(ms(2024, 3, 1))]
    fetch(write, "02", page(*again))
    fetch(write, "03", page(*again, incident(ms(2024, 3, 2))))
    run("ck")
    want = [datetime(2024, 1, 5), datetime(2024, 2, 1), datetime(2024, 2, 10), datetime(2024, 2, 20), datetime(2024, 3, 1), datetime(2024, 3, 2)]
    assert table() == want
    run("ck")
    run("another checkpoint, which replays every batch")
    assert table() == want
    assert tables.get_state(spark, state, "crime")[0] == "2024-03-02T00:00:00"


def test_stream_counts_match_batch_and_keep_late_records(spark, tmp_path):
    schema = "incident_occurred timestamp, zip_code string"
    source = str(tmp_path / "in")
    day = lambda m, d: datetime(2024, m, d)
    batches = [
        [(day(1, 2), "1"), (day(1, 20), "2"), (day(2, 10), "1")],
        [(day(1, 25), "1"), (day(3, 1), "2")],  # the first one is late but within 30 days of 10 Feb
        [(day(6, 1), "9")],  # moves the watermark so that earlier windows close
        [(day(9, 1), "9")],
    ]
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        counts = stream_counts(stream, "incident_occurred", "zip_code", "30 days", "1 day")
        query = (
            counts.writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    closed = spark.createDataFrame([r for b in batches[:2] for r in b], schema)
    want = tumbling_counts(closed, "incident_occurred", "zip_code", "1 day")
    assert [r for r in rows(got) if r[1] != "9"] == rows(want)
    assert rows(yearly_from_windows(want, "zip_code")) == [("1", 2024, 3), ("2", 2024, 2)]
