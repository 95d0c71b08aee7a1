import json
import math

import pytest
from pyspark.sql import functions as F

from goalpost.streaming import events as ev
from goalpost.streaming import ingest as ing
from goalpost.streaming import sources as src

SF = "/root/testdata/sf0.001"


def test_encode_non_finite_becomes_null(spark):
    df = spark.createDataFrame([("123", math.nan, math.inf)], "id_aluno string, proficiencia double, peso_aluno double")
    body = ev.encode(df, "id_aluno").first().body
    obj = json.loads(body)
    assert obj == {"id_aluno": "123", "proficiencia": None, "peso_aluno": None}
    assert "NaN" not in body and "Infinity" not in body


def test_encode_valid_round_trip(spark):
    df = spark.createDataFrame([(2024, "123", "1", 812.5)], "ano int, id_aluno string, alfabetizado string, proficiencia double")
    body = ev.encode(df, "id_aluno").first().body
    assert json.loads(body) == {"ano": 2024, "id_aluno": "123", "alfabetizado": "1", "proficiencia": 812.5}


CASES = ['{"a":1} x', '{"a":1}, {"b":2}', '{"a":1}] [', '', ' ', 'null', '1', '"s"', '[1]', "{'event_id':1}",
         '{"event_id":1,"user_id":0,"event_type":""}', '{"event_id":1,"user_id":false,"event_type":"x"}',
         '{"event_id":1,"user_id":null,"event_type":"x"}', '{"event_id":1,"event_type":"x"}',
         '{"event_id":1,"user_id":2,"event_type":"x","v":Infinity}', '{"event_id":1,"user_id":2,"event_type":"x","v":NaN}',
         '{"event_id":1,"user_id":2,"event_type":"x","v":-Infinity}', ' {"event_id":1,"user_id":2,"event_type":"x"} ',
         '\t{"event_id":1,"user_id":2,"event_type":"x"}\n', '{"event_id":1,"user_id":2,"event_type":"x"}}',
         '{"event_id":1,"event_id":2,"user_id":2,"event_type":"x"}', '{"event_id":1,"user_id":2,"event_type":"x",}',
         '{"event_id":01,"user_id":2,"event_type":"x"}', '{"event_id":"NaN","user_id":2,"event_type":"x"}',
         # trailing text that a plain from_json accepts
         '{"event_id":1,"user_id":2,"event_type":"x"}//c', '{"event_id":1,"user_id":2,"event_type":"x"}/*c*/',
         '{"event_id":1,"user_id":2,"event_type":"x"} {"b":2}', '{"event_id":1,"user_id":2,"event_type":"x"}#c',
         '{"event_id":1,"user_id":2,"event_type":"x","v":1e5}', '{"event_id":1,"user_id":2,"event_type":"x","v":.5}']


def _python_reason(body):
    def reject(x):
        raise ValueError(f"invalid constant {x}")
    try:
        obj = json.loads(body, parse_constant=reject)
    except ValueError as e:
        return ev.INVALID_CONSTANT if "invalid constant" in str(e) else ev.MALFORMED
    if not isinstance(obj, dict):
        return ev.NOT_OBJECT
    if any(obj.get(c) is None for c in src.REQUIRED):
        return ev.MISSING_FIELD
    return None


def test_strict_validation_matches_python_strict_parser(spark):
    df = spark.createDataFrame([(c,) for c in CASES], "body string")
    got = {r.body: r.motivo for r in ev.validate(df, src.REQUIRED).collect()}
    for c in CASES:
        assert got[c] == _python_reason(c), c


def test_fixture_messages_reasons(spark):
    v = ev.validate(src.messages(spark, SF), src.REQUIRED)
    bad = [r for r in v.collect() if r.motivo != _python_reason(r.body)]
    assert not bad


def _run(spark, scratch, mode="quarantine", ckpt_name="ck"):
    return ing.run_ingest(src.message_stream(spark, SF), f"{scratch}/out", f"{scratch}/{ckpt_name}",
                          src.REQUIRED, mode=mode)


def test_stream_dedup_quarantine_and_completeness(spark, scratch):
    m = _run(spark, scratch)
    t = m.totals()
    acc = spark.read.parquet(f"{scratch}/out/accepted")
    rej = spark.read.parquet(f"{scratch}/out/quarantine")
    n_events = spark.read.parquet(f"{SF}/events.parquet").count()
    assert t["lidos"] == n_events                             # redelivered copies collapsed
    assert acc.count() + rej.count() == n_events              # good + bad = input
    assert acc.select("message_id").distinct().count() == acc.count()
    assert set(r.motivo for r in rej.select("motivo").distinct().collect()) == {
        ev.MALFORMED, ev.NOT_OBJECT, ev.MISSING_FIELD, ev.INVALID_CONSTANT}
    assert acc.filter(F.col("dt_ingestao") != F.current_date()).count() == 0


def test_restart_from_checkpoint_writes_nothing_twice(spark, scratch):
    _run(spark, scratch)
    before = spark.read.parquet(f"{scratch}/out/accepted").count()
    again = _run(spark, scratch)             # same checkpoint: no new input
    assert again.totals()["lidos"] == 0
    assert spark.read.parquet(f"{scratch}/out/accepted").count() == before


def test_fail_mode_stops_before_writing_the_batch(spark, scratch):
    with pytest.raises(Exception):
        _run(spark, scratch, mode="fail")
    import os
    assert not os.path.exists(f"{scratch}/out/accepted")


def test_messages_without_id_are_kept_apart(spark, scratch):
    from pyspark.sql import functions as F
    msgs = spark.createDataFrame(
        [(None, '{"event_id":1,"user_id":2,"event_type":"x"}'), (None, '{"event_id":2,"user_id":2,"event_type":"y"}'),
         ("7", '{"event_id":7,"user_id":2,"event_type":"z"}'), ("7", '{"event_id":7,"user_id":2,"event_type":"z"}')],
        "message_id string, body string").withColumn("sent_ts", F.current_timestamp())
    msgs.write.parquet(f"{scratch}/in")
    stream = spark.readStream.schema(msgs.schema).parquet(f"{scratch}/in")
    m = ing.run_ingest(stream, f"{scratch}/out", f"{scratch}/ck", src.REQUIRED)
    acc = spark.read.parquet(f"{scratch}/out/accepted")
    assert m.totals()["gravados"] == 3 and acc.count() == 3
    assert acc.filter(F.col("message_id").isNull()).count() == 0


def test_replay_sample_streams_through_the_validator(spark, scratch):
    from goalpost.plans import analogue
    micro = analogue.micro(spark, SF).filter(F.col("ano") == 1998)
    path = src.write_replay(micro, "id_aluno", 20, f"{scratch}/replay")
    again = spark.read.parquet(path).select("message_id").collect()
    assert len(again) == 20
    # same seed, same sample
    src.write_replay(micro, "id_aluno", 20, f"{scratch}/replay2")
    assert sorted(r.message_id for r in again) == sorted(
        r.message_id for r in spark.read.parquet(f"{scratch}/replay2").select("message_id").collect())
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    m = ing.run_ingest(stream, f"{scratch}/out", f"{scratch}/ck", ["ano", "id_municipio", "id_aluno"])
    assert m.totals() == {"lidos": 20, "gravados": 20, "quarentena": 0}


def test_sample_is_exact_when_n_exceeds_rows(spark):
    from goalpost.operators.sampling import sample_exact
    df = spark.range(7).withColumn("k", F.col("id").cast("string"))
    assert sample_exact(df, 20, "k").count() == 7


def test_out_of_order_batches_lose_nothing(spark, scratch):
    """A later micro-batch with much older event times must not be dropped as late."""
    from pyspark.sql import functions as F
    body = '{"event_id":1,"user_id":2,"event_type":"x"}'
    new = spark.createDataFrame([(str(i), body) for i in range(5)], "message_id string, body string") \
        .withColumn("sent_ts", F.lit("2024-06-01 00:00:00").cast("timestamp"))
    old = spark.createDataFrame([(str(i), body) for i in range(5, 10)], "message_id string, body string") \
        .withColumn("sent_ts", F.lit("2020-01-01 00:00:00").cast("timestamp"))
    new.coalesce(1).write.parquet(f"{scratch}/in/a")
    old.coalesce(1).write.parquet(f"{scratch}/in/b")
    stream = (spark.readStream.schema(new.schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(f"{scratch}/in"))
    m = ing.run_ingest(stream, f"{scratch}/out", f"{scratch}/ck", src.REQUIRED)
    assert m.totals()["gravados"] == 10 and len([b for b in m.batches if b["lidos"]]) == 2


def test_stream_reads_a_folder_of_part_files(spark, scratch):
    events = spark.read.parquet(f"{SF}/events.parquet")
    events.repartition(4).write.parquet(f"{scratch}/in/events.parquet")
    m = ing.run_ingest(src.message_stream(spark, f"{scratch}/in"), f"{scratch}/out", f"{scratch}/ck", src.REQUIRED)
    assert m.totals()["lidos"] == events.count()


def test_replayed_batch_keeps_its_date(spark, scratch):
    batch = spark.sql("SELECT '1' AS message_id, '{}' AS body, true AS valido, CAST(null AS string) AS motivo, "
                      "timestamp'2024-01-31 23:59:59' AS __received")
    for _ in range(2):
        ing.batch_writer(f"{scratch}/out", "quarantine", ing.IngestMetrics())(batch, 7)
    got = spark.read.parquet(f"{scratch}/out/accepted").collect()
    assert [(r.message_id, str(r.dt_ingestao)) for r in got] == [("1", "2024-01-31")]


def _accepted(spark, scratch):
    return sorted((r.message_id, r.body) for r in ing.read_accepted(spark, f"{scratch}/out").collect())


def test_redelivery_to_a_new_checkpoint_adds_nothing(spark, scratch):
    _run(spark, scratch)
    before = _accepted(spark, scratch)
    m = _run(spark, scratch, ckpt_name="ck2")
    assert m.totals()["gravados"] == m.totals()["quarentena"] == 0 and m.totals()["lidos"] > 0
    assert _accepted(spark, scratch) == before
    c = ing.batch_counts(spark, f"{scratch}/out").collect()
    assert len({r.run for r in c}) == 2
    n = spark.read.parquet(f"{SF}/events.parquet").count()
    copies = src.messages(spark, SF).count() - n
    assert sum(r.recebidos for r in c) == 2 * (n + copies) and sum(r.duplicados for r in c) == n + 2 * copies
    assert sum(r.gravados + r.quarentena for r in c) == n


def test_counts_survive_a_restart(spark, scratch):
    _run(spark, scratch)
    one = ing.batch_counts(spark, f"{scratch}/out").orderBy("batch_id").collect()
    _run(spark, scratch)                                # the same checkpoint: nothing new
    again = ing.batch_counts(spark, f"{scratch}/out").where("recebidos > 0").orderBy("batch_id").collect()
    assert [r for r in again] == [r for r in one if r.recebidos]


def test_a_replayed_batch_does_not_meet_its_own_ids(spark, scratch):
    batch = spark.sql("SELECT '1' AS message_id, '{}' AS body, true AS valido, CAST(null AS string) AS motivo, "
                      "current_timestamp() AS __received")
    for run, batch_id in (("a", 0), ("a", 0), ("b", 0), ("b", 1)):
        ing.batch_writer(f"{scratch}/out", "quarantine", ing.IngestMetrics(), run)(batch, batch_id)
    assert _accepted(spark, scratch) == [("1", "{}")]


def test_ids_outside_the_lookback_are_ingested_again(spark, scratch):
    batch = spark.sql("SELECT '1' AS message_id, '{}' AS body, true AS valido, CAST(null AS string) AS motivo, "
                      "timestamp'2020-01-01 10:00:00' AS __received")
    for run in ("a", "b"):
        ing.batch_writer(f"{scratch}/out", "quarantine", ing.IngestMetrics(), run)(batch, 0)
    assert len(_accepted(spark, scratch)) == 2


def test_json_sink_and_compaction(spark, scratch):
    body = '{"event_id":1,\n "user_id":2,"event_type":"a\\nb","extra":[1,2]}'
    msgs = spark.createDataFrame([(str(i), body) for i in range(6)] + [("x", "{")], "message_id string, body string")
    msgs.repartition(3).write.parquet(f"{scratch}/in")
    stream = spark.readStream.schema(msgs.schema).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in")
    ing.run_ingest(stream, f"{scratch}/out", f"{scratch}/ck", src.REQUIRED, fmt="json")
    read = lambda: [json.loads(r.body) for r in ing.read_accepted(spark, f"{scratch}/out").collect()]
    assert read() == [json.loads(body)] * 6
    assert ing.compact(spark, f"{scratch}/out", before="2000-01-01") == [] and len(read()) == 6
    assert len(ing.compact(spark, f"{scratch}/out", before="9999-12-31")) == 1
    assert read() == [json.loads(body)] * 6
    assert ing.compact(spark, f"{scratch}/out", before="9999-12-31") == []
    names = [n for n in ing.files.data_files(spark, f"{scratch}/out/days")]
    assert len(names) == 1 and names[0].endswith(".txt")


def test_compaction_cut_short_shows_every_event_once(spark, scratch, monkeypatch):
    _run(spark, scratch)
    before = _accepted(spark, scratch)

    def lost(*a):
        raise RuntimeError("lost")
    for step in ("write_note", "remove"):
        with monkeypatch.context() as m:
            m.setattr(ing.files, step, lost)
            with pytest.raises(RuntimeError):
                ing.compact(spark, f"{scratch}/out", before="9999-12-31")
        assert _accepted(spark, scratch) == before
    ing.compact(spark, f"{scratch}/out", before="9999-12-31")
    assert _accepted(spark, scratch) == before


def test_a_valid_body_is_parsed_once(spark):
    df = spark.createDataFrame([(c,) for c in CASES], "body string")
    plan = ev.validate(df, src.REQUIRED)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parsejson") + plan.lower().count("parse_json") == 1


def test_compaction_of_a_large_date_is_several_tasks(spark, scratch):
    rows = spark.range(20_000).select(F.col("id").cast("string").alias("message_id"),
                                      F.concat(F.lit('{"event_id":1,"user_id":2,"event_type":"'), F.sha2(F.col("id").cast("string"), 256),
                                               F.lit('"}')).alias("body"))
    rows.write.parquet(f"{scratch}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{scratch}/in")
    ing.run_ingest(stream, f"{scratch}/out", f"{scratch}/ck", src.REQUIRED, fmt="json")
    sizes = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    for s in sizes:
        spark.conf.set(s, "100k")
    try:
        ing.compact(spark, f"{scratch}/out", before="9999-12-31")
    finally:
        for s in sizes:
            spark.conf.unset(s)
    assert len(list(ing.files.data_files(spark, f"{scratch}/out/days"))) > 3
    assert ing.read_accepted(spark, f"{scratch}/out").distinct().count() == 20_000
