"""The runnable jobs end to end on small inputs (file streams stand in for
Kafka), plus the Kafka option wiring."""


import pytest

from basketflow import jobs
from basketflow.session import scratch_dir
from basketflow.sinks.writers import read_batches
from basketflow.sources.kafka import kafka_options
from tests.test_ml import CHURN_CSV, write_text_file
from tests.test_recommender import VIEW_LINES, golden


def test_batch_job_golden(spark):
    src = scratch_dir(spark, "views")
    write_text_file(spark, src, "\n".join(VIEW_LINES))
    out = jobs.batch_recommendations(spark, src, scratch_dir(spark, "recs"))
    got = {r.item: [(e.other, e.cnt) for e in r.recs] for r in out.collect()}
    assert got == golden()
    assert "(10,[(11,3), (12,2)])" in {r.payload for r in out.collect()}


def test_stateful_word_count_job(spark, capfd):
    src = scratch_dir(spark, "wc-in")
    write_text_file(spark, src, "x y\nx")
    out = scratch_dir(spark, "wc-out")
    lines = jobs.message_lines(spark, None, None, src)
    q = jobs.stateful_word_count(lines, scratch_dir(spark, "wc-ckpt"), out_path=out,
                                 interval="1 second")
    q.processAllAvailable()
    q.stop()
    got = {(r.word, r.cnt, r.payload) for r in read_batches(spark, out).collect()}
    assert got == {("x", 2, "(x,2)"), ("y", 1, "(y,1)")}
    assert "|x   |2  |" in capfd.readouterr().out


def test_stateful_word_count_initial_state(spark):
    src, out, ckpt = (scratch_dir(spark, n) for n in ("wc3-in", "wc3-out", "wc3-ckpt"))
    write_text_file(spark, src, "x y")
    seed = spark.createDataFrame([("x", 5)], "word string, cnt bigint")
    q = jobs.stateful_word_count(jobs.message_lines(spark, None, None, src), ckpt, out_path=out,
                                 interval="1 second", initial_state=seed)
    q.processAllAvailable()
    q.stop()
    assert {(r.word, r.cnt) for r in read_batches(spark, out).collect()} == {("x", 6), ("y", 1)}


def test_structured_word_count_job(spark):
    src = scratch_dir(spark, "wc2-in")
    write_text_file(spark, src, "a  b a")
    q = jobs.structured_word_count(jobs.message_lines(spark, None, None, src),
                                   scratch_dir(spark, "wc2-ckpt"), interval="1 second")
    q.processAllAvailable()
    # The JVM prints the table itself; its progress tells sink and rows (a, b
    # and the empty word between the two spaces).
    progress = next(p for p in q.recentProgress if p["numInputRows"])
    q.stop()
    assert "Console" in progress["sink"]["description"]
    assert progress["stateOperators"][0]["numRowsTotal"] == 3


def test_streaming_recommendation_job(spark):
    src = scratch_dir(spark, "reco-in")
    write_text_file(spark, src, "\n".join(VIEW_LINES))
    out = scratch_dir(spark, "reco-out")
    q = jobs.streaming_recommendations(spark, jobs.message_lines(spark, None, None, src),
                                       scratch_dir(spark, "reco-ckpt"), out_path=out,
                                       interval="1 second")
    q.processAllAvailable()
    q.stop()
    got = {r.item: r.payload for r in read_batches(spark, out).collect()}
    # the stream keeps support-1 pairs: (10,13) is seen once
    assert got["13"] == "(13,[(12,2), (10,1), (11,1)])"


def test_churn_job(spark):
    path = scratch_dir(spark, "churn-job")
    write_text_file(spark, path, CHURN_CSV)
    model = scratch_dir(spark, "churn-model")
    preds, value = jobs.churn_classification(spark, path, "rf", seed=3, model_out=model)
    rows = preds.select("prediction", "label").collect()
    assert 0 < len(rows) < 6 and {r.prediction for r in rows} <= {0.0, 1.0}
    labels = {r.label for r in rows}
    assert 0.0 <= value <= 1.0 if len(labels) == 2 else True
    from basketflow.ml.models import load_model
    from basketflow.sources.csv import CHURN_SCHEMA, read_csv_by_position
    again = load_model(model).transform(read_csv_by_position(spark, path, CHURN_SCHEMA))
    assert again.where("prediction is not null").count() == 6


def test_kafka_options():
    opts = kafka_options("b1:9092,b2:9092", ["t1", "t2"])
    assert opts == {"kafka.bootstrap.servers": "b1:9092,b2:9092", "subscribe": "t1,t2",
                    "startingOffsets": "latest"}


def test_kafka_source_needs_connector(spark):
    # the connector jar is not on this classpath; the reader must fail loudly
    from basketflow.sources.kafka import read_kafka_stream
    try:
        read_kafka_stream(spark, "localhost:1", "t")
    except Exception as exc:  # noqa: BLE001
        assert "kafka" in str(exc).lower()
    else:
        pytest.skip("Kafka connector present")


def test_cli_recommend_batch_and_churn(spark, capsys):
    src = scratch_dir(spark, "cli-views")
    write_text_file(spark, src, "\n".join(VIEW_LINES))
    out = scratch_dir(spark, "cli-out")
    jobs.main(["recommend-batch", "--views", src, "--out", out])
    got = {r.item: r.payload for r in spark.read.parquet(out).collect()}
    assert got["10"] == "(10,[(11,3), (12,2)])"
    csv = scratch_dir(spark, "cli-churn")
    write_text_file(spark, csv, CHURN_CSV)
    jobs.main(["churn", "--csv", csv, "--kind", "dt", "--seed", "5"])
    assert "prediction" in capsys.readouterr().out


def test_product_job(spark):
    from basketflow.sources.csv import PRODUCT_SCHEMA
    rows = []
    for i in range(60):
        chars = [f"c{(i + j) % 4}" if j < 4 else None for j in range(10)]
        rows.append((f"cat{i % 3}", float(100 + i), *chars, "True" if i % 2 else "False"))
    path = scratch_dir(spark, "products")
    spark.createDataFrame(rows, PRODUCT_SCHEMA).write.option("header", True).csv(path)
    out = jobs.product_classification(spark, path, seed=3)
    assert {"prediction", "probability", "label", "side"} <= set(out.columns)
    assert out.count() == 60 and {r.side for r in out.select("side").distinct().collect()} == {"train", "test"}


@pytest.mark.parametrize("job", ["recommend-stream", "word-count-stateful", "word-count-structured"])
def test_cli_stream_needs_checkpoint(spark, job):
    with pytest.raises(SystemExit):
        jobs.main([job, "--input-dir", "/nonexistent"])
