import pytest
from conftest import rows_of

from tickflow import schemas, settings
from tickflow.sources import kafka
from tickflow.streaming import sinks


def test_reader_options():
    assert kafka.kafka_options("host:1", "raw_trades") == {
        "kafka.bootstrap.servers": "host:1",
        "subscribe": "raw_trades",
        "startingOffsets": "latest",
    }


def test_reader_options_for_serving():
    options = kafka.kafka_options(
        "host:1",
        "alerts",
        group_id="dashboard",
        max_messages=50,
        min_partitions=64,
        extra={"security.protocol": "SSL"},
    )
    assert options["kafka.group.id"] == "dashboard"
    assert options["maxOffsetsPerTrigger"] == "50"
    assert options["minPartitions"] == "64"
    assert options["kafka.security.protocol"] == "SSL"


def test_writer_options():
    assert sinks.kafka_sink_options("host:1", "alerts", {"acks": "all"}) == {
        "kafka.bootstrap.servers": "host:1",
        "topic": "alerts",
        "kafka.acks": "all",
    }


class Recorder:
    """Stands in for a session's readers and keeps what was asked for."""

    def __init__(self):
        self.asked = {}

    readStream = read = property(lambda self: self)

    def format(self, name):
        self.asked["format"] = name
        return self

    def options(self, **options):
        self.asked.update(options)
        return self

    def option(self, name, value):
        self.asked[name] = value
        return self

    def load(self):
        return dict(self.asked)


def test_stream_and_batch_reads():
    stream = kafka.stream_messages(Recorder(), "host:1")
    assert (stream["format"], stream["subscribe"]) == ("kafka", "raw_trades")
    batch = kafka.read_messages(Recorder(), "host:1", "alerts", max_messages=5)
    assert (batch["startingOffsets"], batch["endingOffsets"]) == ("earliest", "latest")
    assert "maxOffsetsPerTrigger" not in batch


def test_serving_reads_are_bounded():
    recorder = Recorder()
    kafka.metrics_and_alerts(recorder, "host:1", 50, metrics_group="m", alerts_group="a")
    assert recorder.asked["kafka.group.id"] == "a"
    assert recorder.asked["maxOffsetsPerTrigger"] == "50"
    assert recorder.asked["subscribe"] == schemas.ALERTS_TOPIC


def test_defaults_and_environment(monkeypatch):
    for name in ("KAFKA_BOOTSTRAP_SERVERS", "VOLATILITY_WINDOW", "VOLATILITY_THRESHOLD"):
        monkeypatch.delenv(name, raising=False)
    default = settings.Settings()
    assert (default.servers, default.alert_length) == ("kafka:9092", "10 seconds")
    assert default.alert_threshold == 1.0
    assert (default.vwap_length, default.vwap_slide) == ("30 seconds", "10 seconds")
    assert default.delay == "1 minute"
    monkeypatch.setenv("VOLATILITY_WINDOW", "1 minute")
    monkeypatch.setenv("VOLATILITY_THRESHOLD", "2.5")
    changed = settings.Settings()
    assert (changed.alert_length, changed.alert_threshold) == ("1 minute", 2.5)


class Conf:
    def __init__(self, **values):
        self.values = {k.replace("__", "."): v for k, v in values.items()}
        self.conf = self

    def get(self, name, default=None):
        return self.values.get(name, default)


def test_checkpoints_go_to_the_shared_folder():
    cluster = Conf(spark__checkpoint__dir="hdfs:///shared/", spark__master="yarn")
    assert settings.shared_root(cluster) == "hdfs:///shared"
    path = settings.checkpoint_path(cluster, "alerts")
    assert path == "hdfs:///shared/tickflow/checkpoints/alerts"
    assert settings.scratch_path(cluster, "a") != settings.scratch_path(cluster, "a")


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        settings.shared_root(Conf(spark__master="spark://host:7077"))


def test_a_local_session_gets_one_folder(spark):
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        assert settings.shared_root(spark) == settings.shared_root(spark)


def test_files_have_the_shape_of_messages(spark, tmp_path):
    from tickflow.sources import messages_from_files

    path = str(tmp_path / "log")
    spark.createDataFrame([(b"k", b"v", "t", 0, 1, None, 0)], schemas.MESSAGE).write.parquet(path)
    read = messages_from_files(spark, path, glob="*.parquet")
    assert read.schema == schemas.MESSAGE
    assert rows_of(read, "offset") == [(1,)]


def test_job_arguments_reach_the_source(monkeypatch):
    from tickflow.streaming import job

    asked = {}
    monkeypatch.setattr(job, "build_session", lambda name: "session")
    monkeypatch.setattr(job, "stream_messages", lambda *a, **options: asked.update(options))
    monkeypatch.setattr(job, "start_job", lambda *a: asked.update(console=a[-1]))
    monkeypatch.setattr(job, "start_ingest", lambda *a: asked.update(ingest=True))
    monkeypatch.setattr(job, "start_serving", lambda *a: asked.update(serving=a))
    monkeypatch.setattr(job, "await_any", lambda session: asked.update(waited=session))
    job.main(["--max-messages", "1000", "--min-partitions", "64", "--console"])
    assert asked == {
        "starting": "latest",
        "max_messages": 1000,
        "min_partitions": 64,
        "console": True,
        "waited": "session",
    }

    asked.clear()
    job.main(["ingest", "--feed-topic", "trades_feed", "--starting", "earliest"])
    assert asked["ingest"] and asked["starting"] == "earliest"

    asked.clear()
    monkeypatch.setenv("KAFKA_DASHBOARD_GROUP_ID", "web")
    monkeypatch.setenv("KAFKA_ALERTS_GROUP_ID", "cli")
    topics = lambda *a, **options: asked.update(options) or ("m", "a")
    monkeypatch.setattr(job, "metrics_and_alerts", topics)
    job.main(["serving", "--path", "/shared/out", "--every", "10 seconds"])
    assert (asked["metrics_group"], asked["alerts_group"]) == ("web", "cli")
    assert asked["serving"] == ("m", "a", "/shared/out", "10 seconds")
    assert asked["max_messages"] is None
    with pytest.raises(SystemExit):
        job.main(["serving"])


def test_refresh_interval_reaches_the_sink(spark, monkeypatch):
    from tickflow.streaming import job

    asked = {}
    monkeypatch.setattr(job, "start_kafka", lambda *a, **options: asked.update(options))
    monkeypatch.setattr(job, "checkpoint_path", lambda spark, name: "/c")
    job.kafka_starter(spark, settings.Settings(), every="1 minute")("rows", "alerts")
    assert asked == {"every": "1 minute"}
