"""The landed topic as a streaming source: admission, starts, restarts, lost segments."""

import uuid

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from devicegrid.session import shared_path
from devicegrid.streaming import topic


def _messages(spark, first, past):
    """Offsets in three partitions, a third of them in each, with a null key and a null value among them."""
    i = F.col("id")
    return spark.range(first, past).select(
        F.when(i % 7 != 0, F.concat(F.lit("A"), i.cast("string"))).alias("key"),
        F.when(i % 11 != 0, F.concat(F.lit("v"), i.cast("string"))).alias("value"),
        F.timestamp_seconds(i).alias("kafka_ts"), (i % 3).cast("int").alias("partition"), i.alias("offset"))


def _run(spark, base, **options):
    stream = topic.topic_stream(spark, f"{base}/topic", f"{base}/progress", segment_offsets=50, task_offsets=100, **options)
    q = (stream.writeStream.format("parquet").option("path", f"{base}/out")
         .option("checkpointLocation", f"{base}/ck").outputMode("append").start())
    try:
        topic.drain(q)
    finally:
        sizes = [p.numInputRows for p in q.recentProgress if p.numInputRows]
    return sizes


def _rows(spark, base):
    return sorted(spark.read.schema(topic.ENVELOPE_DDL).parquet(f"{base}/out").collect(), key=lambda r: r.offset)


@pytest.fixture
def base(spark):
    return shared_path(spark, "tests", f"topic-{uuid.uuid4().hex[:10]}")


def test_batches_are_bounded_and_a_restart_repeats_nothing(spark, base):
    topic.land(_messages(spark, 0, 400), f"{base}/topic", 50)
    sizes = _run(spark, base, max_offsets=300)
    assert sum(sizes) == 400 and len(sizes) >= 4 and max(sizes) <= 300
    assert _rows(spark, base) == sorted(_messages(spark, 0, 400).collect(), key=lambda r: r.offset)
    assert _run(spark, base, max_offsets=300) == []
    topic.land(_messages(spark, 400, 530), f"{base}/topic", 50)
    assert sum(_run(spark, base, max_offsets=300)) == 130
    assert [r.offset for r in _rows(spark, base)] == list(range(530))


def test_latest_takes_what_is_landed_after_the_first_start(spark, base):
    topic.land(_messages(spark, 0, 200), f"{base}/topic", 50)
    assert _run(spark, base, starting="latest") == []
    topic.land(_messages(spark, 200, 320), f"{base}/topic", 50)
    _run(spark, base, starting="latest")
    assert [r.offset for r in _rows(spark, base)] == list(range(200, 320))


def test_a_lost_segment_is_passed_over_or_an_error(spark, base):
    lost = (F.col("partition") == 1) & F.col("offset").between(50, 99)
    topic.land(_messages(spark, 0, 300).filter(~lost), f"{base}/topic", 50)
    with pytest.raises(StreamingQueryException, match="1 segments of partition 1 are missing"):
        _run(spark, f"{base}", fail_on_data_loss=True)
    _run(spark, base)
    assert [r.offset for r in _rows(spark, base)] == [i for i in range(300) if not (i % 3 == 1 and 50 <= i <= 99)]


def test_an_empty_topic(spark, base):
    topic.land(_messages(spark, 0, 0), f"{base}/topic", 50)
    assert _run(spark, base) == []
    with pytest.raises(ValueError, match="earliest"):
        topic.topic_stream(spark, base, base, starting="middle")


OFFSETS = st.dictionaries(st.sampled_from("0123"), st.integers(0, 1000), min_size=1)


@given(OFFSETS, OFFSETS, st.integers(1, 500))
def test_admission_never_goes_back_nor_over_the_limit(done, more, limit):
    ends = {p: done[p] + n for p, n in more.items() if p in done}
    got = topic.admitted(done, ends, limit)
    waiting = sum(ends.values()) - sum(done[p] for p in ends)
    assert all(done[p] <= got[p] <= ends.get(p, done[p]) for p in done)
    assert sum(got.values()) - sum(done.values()) == min(limit, waiting)


def test_a_batch_lists_what_it_reads_not_the_whole_topic(spark, base, monkeypatch):
    topic.land(_messages(spark, 0, 3000), f"{base}/topic", 50)
    reader = topic.TopicReader({"path": f"{base}/topic", "progress": f"{base}/progress", "starting": "earliest", "max_offsets": "300",
                                "task_offsets": "100", "segment_offsets": "50", "fail_on_data_loss": "true"})
    looks = []
    monkeypatch.setattr(reader, "_segments", lambda found=reader._segments: looks.append(1) or found())
    at, rows = reader.initialOffset(), 0
    while (end := reader.latestOffset()) != at:
        rows += sum(b.num_rows for part in reader.partitions(at, end) for b in reader.read(part))
        at = end
    assert rows == 3000 and len(looks) <= 4  # 30 batches
    topic.land(_messages(spark, 3000, 3100), f"{base}/topic", 50)
    end = reader.latestOffset()
    assert sum(b.num_rows for part in reader.partitions(at, end) for b in reader.read(part)) == 100
