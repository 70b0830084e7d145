from contextlib import contextmanager

import os

import pyarrow.parquet as pq
import pytest
from pyspark import TaskContext
from pyspark.errors import StreamingQueryException

from cellweave.operators.partitions import foreach, foreach_partition, map_partitions
from cellweave.session import qualified
from cellweave.sources.outbox import Outbox
from cellweave.streaming.sinks import stream_foreach_partition


def tracing(path):
    """A resource that writes down when it is opened and closed, and what is done with it."""

    @contextmanager
    def resource():
        from pyspark import TaskContext

        with open(f"{path}/{TaskContext.get().partitionId()}", "w") as log:
            log.write("open\n")
            try:
                yield log
            finally:
                log.write("close\n")

    return resource


def logs(path):
    return {p.name: p.read_text().split("\n")[:-1] for p in path.iterdir()}


def test_resource_stays_open_until_the_output_is_read(spark, tmp_path):
    def twice(batches, log):
        for batch in batches:
            yield batch.assign(x=batch["id"] * 2)
            log.write("after batch\n")

    got = map_partitions(spark.range(0, 10, 1, 2), tracing(tmp_path), twice, "id BIGINT, x BIGINT")
    assert sorted(r["x"] for r in got.collect()) == list(range(0, 20, 2))
    assert logs(tmp_path) == {p: ["open", "after batch", "close"] for p in "01"}


def test_resource_is_closed_after_an_error(spark, tmp_path):
    def fail(batches, log):
        next(batches)
        raise ValueError("no")
        yield

    with pytest.raises(Exception, match="no"):
        map_partitions(spark.range(0, 2, 1, 1), tracing(tmp_path), fail, "id BIGINT").collect()
    assert logs(tmp_path) == {"0": ["open", "close"]}


def test_partition_and_record_actions(spark, tmp_path):
    (tmp_path / "a").mkdir(), (tmp_path / "b").mkdir()
    df = spark.range(0, 4, 1, 2)

    def count(batches, log):
        log.write(f"{sum(b.num_rows for b in batches)}\n")

    foreach_partition(df, tracing(tmp_path / "a"), count)
    assert logs(tmp_path / "a") == {p: ["open", "2", "close"] for p in "01"}
    foreach(df, tracing(tmp_path / "b"), lambda record, log: log.write(f"{record}\n"))
    assert logs(tmp_path / "b")["1"] == ["open", "{'id': 2}", "{'id': 3}", "close"]


def write_part(batches, staged):
    for batch in batches:
        with pq.ParquetWriter(staged.new(), batch.schema, filesystem=staged.system) as writer:
            writer.write_batch(batch)
    return staged.receipt()


def write_part_but_fail_once(marker):
    """The first attempt of partition 1 writes its file and then fails."""

    def fn(batches, staged):
        receipt = write_part(batches, staged)
        if TaskContext.get().partitionId() == 1 and not os.path.exists(marker):
            open(marker, "w").close()
            raise OSError("lost")
        return receipt

    return fn


def ids(spark, outbox):
    return sorted(r["id"] for r in spark.read.parquet(outbox.sent).collect())


def test_only_what_counts_is_committed(spark, tmp_path):
    outbox = Outbox(f"file://{tmp_path}/out")
    df = spark.range(0, 20, 1, 4)
    with pytest.raises(Exception, match="lost"):
        foreach_partition(df, outbox, write_part_but_fail_once(f"{tmp_path}/failed"), outbox.commit, outbox.abort)
    assert not os.path.exists(f"{tmp_path}/out/sent")
    foreach_partition(df, outbox, write_part_but_fail_once(f"{tmp_path}/failed"), outbox.commit, outbox.abort)
    assert ids(spark, outbox) == list(range(20))
    foreach_partition(df, outbox, write_part, outbox.commit)
    assert ids(spark, outbox) == sorted([*range(20)] * 2)


def test_replayed_batches_and_other_sessions_leave_each_row_once(spark, tmp_path):
    source, checkpoint = f"{tmp_path}/in", f"{tmp_path}/cp"
    outbox = Outbox(qualified(spark, f"{tmp_path}/out"))

    def run(session):
        stream = session.readStream.schema("id BIGINT").parquet(source)
        query = stream_foreach_partition(stream, outbox, write_part, checkpoint, outbox.commit, outbox.abort)
        query.awaitTermination()
        return query.lastProgress

    spark.range(0, 30, 1, 3).write.parquet(source)
    run(spark)
    spark.range(30, 50, 1, 2).write.mode("append").parquet(source)
    run(spark.newSession())
    assert ids(spark, outbox) == list(range(50))
    # The session ends after a batch's work and before its entry in the log.
    os.remove(f"{checkpoint}/commits/1")
    for name in os.listdir(f"{checkpoint}/commits"):
        if name.startswith(".1."):
            os.remove(f"{checkpoint}/commits/{name}")
    assert run(spark.newSession())["batchId"] == 1
    assert ids(spark, outbox) == list(range(50))
    assert sorted(os.listdir(f"{tmp_path}/out/sent")) == ["batch_id=0", "batch_id=1"]


def test_a_failed_batch_shows_nothing(spark, tmp_path):
    spark.range(0, 8, 1, 4).write.parquet(f"{tmp_path}/in")
    outbox = Outbox(f"file://{tmp_path}/out")
    marker = f"{tmp_path}/failed"

    def run():
        stream = spark.readStream.schema("id BIGINT").parquet(f"{tmp_path}/in").repartition(3)
        stream_foreach_partition(stream, outbox, write_part_but_fail_once(marker), f"{tmp_path}/cp", outbox.commit, outbox.abort).awaitTermination()

    with pytest.raises(StreamingQueryException):
        run()
    assert not os.path.exists(f"{tmp_path}/out/sent")
    run()
    assert ids(spark, outbox) == list(range(8))


def test_record_actions_commit(spark, tmp_path):
    outbox = Outbox(f"file://{tmp_path}/out", ".txt")

    def write(record, staged):
        with staged.system.open_output_stream(staged.new()) as out:
            out.write(b"%d" % record["id"])

    foreach(spark.range(0, 5, 1, 2), outbox, write, lambda staged: staged.receipt(), outbox.commit)
    files = [f for _, _, names in os.walk(f"{tmp_path}/out/sent") for f in names]
    assert len(files) == 5 and not os.listdir(f"{tmp_path}/out/staged")


def test_paths_get_the_scheme_of_the_default_file_system(spark, tmp_path):
    assert qualified(spark, "s3a://b/x") == "s3a://b/x"
    assert qualified(spark, str(tmp_path)) == f"file://{tmp_path}"
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "hdfs://name:9000/")
    try:
        assert qualified(spark, "/a/b") == "hdfs://name:9000/a/b"
    finally:
        conf.set("fs.defaultFS", before)
