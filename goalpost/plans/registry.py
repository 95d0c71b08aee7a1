"""Named queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator/job.

Each reads the shared test tables through ``analogue`` / ``chain`` so its
work grows with them.  The SQL oracle for each key is in ``sql_oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goalpost.functions.codes import CODEBOOKS, REDE_MUNICIPAL, decode_all
from goalpost.operators import quality as q
from goalpost.operators.aggregate import dedup_full, micro_rollup
from goalpost.operators.joins import lookup, salted_lookup
from goalpost.plans import analogue, analysis, chain, dashboard, integration, rollups, silver
from goalpost.plans import gold as _gold
from goalpost.session import fresh_path
from goalpost.sources import files
from goalpost.sources.ingest import Source, ingest
from goalpost.sources.layers import (materialize, profile, publish_layer, read_files, read_layer, union_by_name,
                                     write_layer)
from goalpost.streaming import events as _ev
from goalpost.streaming import ingest as _ing
from goalpost.streaming import sources as _src

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# --- S1 / P1-P3: scan, projection, predicates --------------------------------
MICRO_SCHEMA = T.StructType([
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_partkey", T.LongType()),
    T.StructField("l_suppkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_quantity", T.DoubleType()), T.StructField("l_extendedprice", T.DoubleType()),
    T.StructField("l_discount", T.DoubleType()), T.StructField("l_tax", T.DoubleType()),
    T.StructField("l_returnflag", T.StringType()), T.StructField("l_linestatus", T.StringType()),
    T.StructField("l_shipdate", T.TimestampNTZType()),
])


@query("scan_project")
def scan_project(spark, d):
    """Declared-schema scan; only the projected columns reach the Parquet reader."""
    li = spark.read.schema(MICRO_SCHEMA).parquet(f"{d}/lineitem.parquet")
    return li.select(F.col("l_suppkey").alias("id_municipio"), F.year("l_shipdate").alias("ano"),
                     F.col("l_returnflag"), F.col("l_quantity"))


@query("filter_code")
def filter_code(spark, d):
    """Equality filter on a string network code."""
    return analogue.micro(spark, d).filter(F.col("rede") == F.lit(REDE_MUNICIPAL)) \
        .select("id_aluno", "ano", "id_municipio", "rede", "proficiencia")


@query("null_predicates")
def null_predicates(spark, d):
    """Null / not-null predicates counted per year."""
    m = analogue.micro(spark, d)
    return m.groupBy("ano").agg(F.count_if(F.col("proficiencia").isNull()).alias("sem_prova"),
                                F.count_if(F.col("proficiencia").isNotNull()).alias("com_prova"))


# --- lookups, integration ----------------------------------------------------
@query("enrich_directory")
def enrich_directory(spark, d):
    """Micro (with orphan and null keys) ⟕ directory; unmatched rows keep null attributes."""
    geo = chain.silver_directory(spark, d).select("id_municipio", "nome", "sigla_uf")
    m = analogue.dirty_micro(spark, d).select("id_aluno", "ano", "id_municipio")
    return lookup(m, geo, "id_municipio", "left")


@query("lookup_salted")
def lookup_salted(spark, d):
    """J1 beyond the broadcast bound: hot keys from a frequent-items sketch are salted, null keys spread."""
    geo = chain.silver_directory(spark, d).select("id_municipio", "nome", "sigla_uf")
    m = analogue.dirty_micro(spark, d).select("id_aluno", "ano", "id_municipio")
    return salted_lookup(m, geo, "id_municipio")


@query("integrate_targets")
def integrate_targets(spark, d):
    return chain.integrated_fine(spark, d)


@query("integrate_targets_coarse")
def integrate_targets_coarse(spark, d):
    return chain.integrated_coarse(spark, d)


@query("integration_consistency")
def integration_consistency(spark, d):
    return integration.integrate_fine(chain.silver_fine(spark, d), chain.silver_target_fine(spark, d))[1]


@query("integration_consistency_coarse")
def integration_consistency_coarse(spark, d):
    """Q10 for the coarse level."""
    return integration.integrate_coarse(chain.silver_coarse(spark, d), chain.silver_target_coarse(spark, d))[1]


# --- aggregations ------------------------------------------------------------
@query("micro_rollup")
def micro_rollup_q(spark, d):
    return micro_rollup(analogue.micro(spark, d), ["id_municipio", "ano"])


@query("dedup_full")
def dedup_full_q(spark, d):
    return dedup_full(analogue.dirty_micro(spark, d))


@query("decode_codes")
def decode_codes(spark, d):
    """All five code books on micro with an injected unknown code."""
    m = analogue.dirty_micro(spark, d).select("id_aluno", "ano", *CODEBOOKS)
    return m.withColumns(decode_all(CODEBOOKS))


# --- quality rules on the dirty micro table ----------------------------------
def _dirty_rules(spark, d):
    geo = chain.silver_directory(spark, d)
    return [
        q.nulls("null key", ["ano", "id_municipio", "id_aluno"]),
        q.nulls("null required field", ["serie", "rede", "presenca", "preenchimento_caderno", "alfabetizado"]),
        q.duplicates("duplicate key", ["ano", "id_aluno"]),
        q.not_in("literate flag invalid", "alfabetizado", ["0", "1"]),
        q.orphans("territory missing from directory", "id_municipio", geo),
        q.out_of_range("score outside 0-1000", "proficiencia", 0, 1000),
        q.nulls("score missing", ["proficiencia"], severity=q.WARN),
    ]


def _one_rule(kind: str):
    def run(spark, d):
        rules = [r for r in _dirty_rules(spark, d) if r.kind == kind][:1]
        return q.evaluate(analogue.dirty_micro(spark, d), rules)
    return run


QUERIES["rule_nulls"] = _one_rule("nulls")
@query("rule_nulls_all")
def rule_nulls_all(spark, d):
    """Q1: every null rule of the set, warnings too."""
    return q.evaluate(analogue.dirty_micro(spark, d), [r for r in _dirty_rules(spark, d) if r.kind == "nulls"])


QUERIES["rule_duplicates"] = _one_rule("duplicates")
QUERIES["rule_range"] = _one_rule("range")
QUERIES["rule_domain"] = _one_rule("domain")


@query("quality_report")
def quality_report(spark, d):
    """Q1-Q9: the whole micro rule set on the dirty table, one action."""
    return q.evaluate(analogue.dirty_micro(spark, d), _dirty_rules(spark, d))


@query("silver_reports")
def silver_reports(spark, d):
    """Q8/Q9: every Silver table's own rule set (incl. the null-target exception), one action over one written rollup."""
    roll = materialize(analogue.fine_rollup(spark, d), "fine-rollup")
    geo = chain.silver_directory(spark, d)
    loaders = {"meta_brasil": analogue.target_country, "meta_uf": analogue.target_coarse,
               "meta_municipio": analogue.target_fine}
    built = [("diretorio_municipio", silver.directory(analogue.directory(spark, d))),
             ("uf", silver.indicator_coarse(analogue.indicator_coarse(spark, d, roll))),
             ("municipio", silver.indicator_fine(analogue.indicator_fine(spark, d, roll), geo)),
             *[(s.name, silver.targets(loaders[s.name](spark, d, roll), s)) for s in silver.TARGETS],
             ("alunos", silver.micro(analogue.micro(spark, d), geo))]
    return union_by_name([q.evaluate(df, rules).withColumn("tabela", F.lit(name)) for name, (df, rules) in built])


@query("orphan_keys")
def orphan_keys(spark, d):
    """Orphan rows of documents vs labels, and of dirty micro vs the directory."""
    docs = analogue.table(spark, d, "documents")
    labels = analogue.table(spark, d, "labels")
    a = q.evaluate(docs, [q.orphans("documents without label", "doc_id", labels)])
    b = q.evaluate(analogue.dirty_micro(spark, d),
                   [q.orphans("students without directory entry", "id_municipio", chain.silver_directory(spark, d))])
    return a.unionByName(b).select("rule", "violations")


# --- Silver jobs ---------------------------------------------------------------
QUERIES["silver_directory"] = chain.silver_directory
QUERIES["silver_indicator_fine"] = chain.silver_fine
QUERIES["silver_indicator_coarse"] = chain.silver_coarse


@query("silver_targets")
def silver_targets(spark, d):
    """C4: the three target tables, each cleaned, stacked with their name; the micro table is rolled up once."""
    roll = materialize(analogue.fine_rollup(spark, d), "fine-rollup")
    loaders = {"meta_brasil": analogue.target_country, "meta_uf": analogue.target_coarse,
               "meta_municipio": analogue.target_fine}
    frames = [silver.targets(loaders[s.name](spark, d, roll), s)[0].withColumn("tabela", F.lit(s.name))
              for s in silver.TARGETS]
    return union_by_name(frames)


@query("silver_micro")
def silver_micro(spark, d):
    return chain.silver_micro(spark, d)


@query("silver_publish")
def silver_publish(spark, d):
    """A version is published, the next fails its gate, and readers still get the first, whole."""
    path, geo = fresh_path(spark, "silver-alunos"), chain.silver_directory(spark, d)
    refused = False
    for source in (analogue.micro(spark, d), analogue.dirty_micro(spark, d)):
        df, rules = silver.micro(source, geo, by_period=True)
        try:
            publish_layer(df, path, "ano", lambda rows, rules=rules: q.check("silver_alunos", rows, rules), cluster=False)
        except q.QualityError:
            refused = True
    return read_layer(spark, path).withColumn("recusada", F.lit(refused))


# --- Gold ------------------------------------------------------------------------
QUERIES["gold_indicator_rank"] = chain.gold_indicator
QUERIES["gold_attainment"] = chain.gold_attainment
QUERIES["gold_evolution"] = chain.gold_evolution


# --- analysis ----------------------------------------------------------------------
QUERIES["missing_target_base"] = chain.analysis_base
for _name, _fn in {
    "missing_target_coverage": analysis.coverage,
    "orphan_persistence": analysis.persistence,
    "participation_pattern": analysis.participation_pattern,
    "orphan_rate_by_band": analysis.orphan_rate_by_band,
    "missing_target_counterexamples": analysis.counterexamples,
    "denominator_check": analysis.denominator_check,
}.items():
    QUERIES[_name] = (lambda fn: lambda spark, d: fn(chain.analysis_base(spark, d)))(_fn)


@query("missing_target_incremental")
def missing_target_incremental(spark, d):
    """C10 on the stored rollup: one year is ingested again (its untested students gone) and only that year rolled up."""
    base, store = fresh_path(spark, "bronze"), fresh_path(spark, "rollup")
    source = lambda keep: Source("alunos", lambda s: analogue.micro(s, d).where(keep), "ano")
    ingest(spark, [source(F.lit(True))], base)
    rollups.refresh(spark, read_layer(spark, f"{base}/alunos"), store)
    again = ingest(spark, [source((F.col("ano") == 1996) & F.col("proficiencia").isNotNull())], base)
    rollups.refresh(spark, read_layer(spark, f"{base}/alunos"), store, again["alunos"].partitions)
    return analysis.base_from_rollup(chain.silver_fine(spark, d), chain.silver_target_fine(spark, d),
                                     rollups.read(spark, store))


# --- dashboard marts -------------------------------------------------------------
# The dashboard reads the Gold layer: each mart query first writes the Gold
# table(s) it needs (once), then aggregates the files -- the latest-period
# self-join never recomputes the upstream plan.
def _gold_tables(spark, d, *names):
    gold = _gold
    out = {}
    if {"attainment", "evolution"} & set(names):
        # both coarse marts are cheap projections of one written integrated table
        coarse = materialize(chain.integrated_coarse(spark, d), "silver-uf-integrado")
        out["attainment"], out["evolution"] = gold.attainment(coarse), gold.evolution(coarse)
    if "gap" in names:
        out["gap"] = materialize(chain.gold_gap(spark, d), "gold-indicador")
    res = [out[n] for n in names]
    return res[0] if len(res) == 1 else res


@query("latest_period")
def latest_period(spark, d):
    return dashboard.latest_period(*_gold_tables(spark, d, "attainment", "evolution"))


@query("rank_latest")
def rank_latest(spark, d):
    return dashboard.rank_latest(_gold_tables(spark, d, "attainment"))


@query("target_vs_result")
def target_vs_result(spark, d):
    return dashboard.target_vs_result(_gold_tables(spark, d, "attainment"))


@query("trend_direction")
def trend_direction(spark, d):
    return dashboard.trend_direction(_gold_tables(spark, d, "evolution"))


@query("topk_gap")
def topk_gap(spark, d):
    """C18 at the latest year of the attainment mart (as the dashboard takes it)."""
    att, gap = _gold_tables(spark, d, "attainment", "gap")
    return dashboard.topk_gap(gap, latest=dashboard.latest_of(att))


@query("kpi_latest")
def kpi_latest(spark, d):
    return dashboard.kpis(*_gold_tables(spark, d, "attainment", "evolution", "gap"))


# --- profile, union --------------------------------------------------------------
@query("table_profile")
def table_profile(spark, d):
    """Row count and rows without a parent, on Silver micro built from the dirty table."""
    return profile(chain.silver_micro(spark, d, dirty=True))[0]


@query("table_preview")
def table_preview(spark, d):
    """L4: first rows by key of the wanted columns that exist."""
    return profile(chain.silver_fine(spark, d), order_by=["id_municipio", "ano", "rede"])[1]


@query("union_by_name")
def union_by_name_q(spark, d):
    """Bag union by column name; columns missing on one side become null."""
    c = analogue.table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("nome"),
        F.col("c_nationkey").alias("nacao"), F.col("c_mktsegment").alias("segmento"))
    s = analogue.table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("nome"),
        F.col("s_nationkey").alias("nacao"), F.col("s_acctbal").alias("saldo"))
    return union_by_name([c, s])


# --- layered storage round trips (S2-S5, S8-S11, A14) ----------------------------


def _bronze(spark, d, sources):
    base = fresh_path(spark, "bronze")
    ingest(spark, sources, base)
    return base


@query("bronze_ingest")
def bronze_ingest(spark, d):
    """Registry ingest (one partitioned, one plain source), read back with partition discovery."""
    base = _bronze(spark, d, [Source("alunos", lambda s: analogue.micro(s, d), "ano"),
                              Source("diretorio_municipio", lambda s: analogue.directory(s, d), None)])
    return read_layer(spark, f"{base}/alunos")


@query("bronze_plain")
def bronze_plain(spark, d):
    """The unpartitioned source read back, beside the sorted period values that the other source's ingest
    reported."""
    base = fresh_path(spark, "bronze")
    done = ingest(spark, [Source("alunos", lambda s: analogue.micro(s, d), "ano"),
                          Source("diretorio_municipio", lambda s: analogue.directory(s, d), None)], base)
    periods = ",".join(map(str, done["alunos"].partitions))
    return read_layer(spark, f"{base}/diretorio_municipio").withColumn("periodos", F.lit(periods))


@query("mixed_layout")
def mixed_layout(spark, d):
    """One table of three layouts -- year only in the folder, year in folder and file, year only in the file and in
    no folder, one of them with a column more -- read as one."""
    path, m = fresh_path(spark, "mixed"), analogue.micro(spark, d).select("ano", "id_aluno", "proficiencia")
    write_layer(m.where(F.col("ano") <= 1996), path, "ano")
    late = m.where((F.col("ano") > 1996) & (F.col("ano") <= 1998)).withColumn("origem", F.lit("arquivo"))
    write_layer(late.withColumn("dir", F.col("ano")), f"{path}/lote=2", "dir")
    m.where(F.col("ano") > 1998).write.parquet(f"{path}/resto")
    return read_files(spark, path, ["ano", "lote"])


@query("bronze_reingest")
def bronze_reingest(spark, d):
    """Re-ingest one year with dynamic partition overwrite; the other years stay."""
    base = _bronze(spark, d, [Source("alunos", lambda s: analogue.micro(s, d), "ano")])
    again = Source("alunos", lambda s: analogue.micro(s, d).filter(F.col("ano") == 1998)
                   .withColumn("peso_aluno", F.lit(2.0)), "ano")
    ingest(spark, [again], base)
    return read_layer(spark, f"{base}/alunos")


@query("bronze_null_period")
def bronze_null_period(spark, d):
    """S3: rows with a null period are not written -- and are counted, not hidden."""
    src = analogue.micro(spark, d).withColumn(
        "ano", F.when(F.col("id_escola") % 113 == 0, F.lit(None).cast("int")).otherwise(F.col("ano")))
    path = fresh_path(spark, "bronze-null")
    res = write_layer(src, path, "ano")
    back = read_layer(spark, path)
    return back.agg(F.count(F.lit(1)).alias("lidos")).select(
        F.lit(res.rows).cast("bigint").alias("escritos"),
        F.lit(res.dropped_null_partition).cast("bigint").alias("descartados"), "lidos")


@query("partition_prune")
def partition_prune(spark, d):
    """A filter on the partition column becomes a PartitionFilter of the scan."""
    base = _bronze(spark, d, [Source("alunos", lambda s: analogue.micro(s, d), "ano")])
    return read_layer(spark, f"{base}/alunos").filter(F.col("ano") == 1998)


@query("gold_roundtrip")
def gold_roundtrip(spark, d):
    """Gold mart written partitioned by year and read back."""
    path = fresh_path(spark, "gold-indicador")
    write_layer(_gold.indicator_rank(chain.integrated_fine(spark, d)), path, "ano")
    return read_layer(spark, path)


# --- streaming (T1-T8, S12) -----------------------------------------------------------

_PARSED = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                        T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()),
                        T.StructField("props", T.StringType()), T.StructField("ts", T.TimestampNTZType())])


def _fields(body: str = "body") -> list:
    """The event's fields parsed back from a body; the time as text, so that both engines compare the same value."""
    p = F.from_json(body, _PARSED)
    return [F.date_format(p["ts"], "yyyy-MM-dd HH:mm:ss").alias("ts") if f.name == "ts" else p[f.name].alias(f.name)
            for f in _PARSED.fields]


@query("event_encode")
def event_encode(spark, d):
    """Rows -> JSON bodies (non-finite -> null), parsed back for the round-trip check."""
    e = analogue.table(spark, d, "events")
    k = F.col("event_id") % 40
    e = e.withColumn("value", F.when(k == 7, F.lit(float("nan"))).when(k == 9, F.lit(float("inf")))
                     .otherwise(F.col("value")))
    enc = _ev.encode(e, "event_id")
    return enc.select("message_id", *_fields(),
                      F.col("body").rlike("NaN|Infinity").alias("has_non_finite_text"))


@query("event_validate")
def event_validate(spark, d):
    """Strict JSON object check and required fields, one reason per rejected message."""
    v = _ev.validate(_src.messages(spark, d), _src.REQUIRED)
    return v.select("message_id", "event_id", "motivo", "valido")


def _stream_run(spark, d, mode="quarantine", out=None, fmt="parquet"):
    out, ckpt = out or fresh_path(spark, "stream-out"), fresh_path(spark, "stream-ckpt")
    metrics = _ing.run_ingest(_src.message_stream(spark, d), out, ckpt, _src.REQUIRED, mode=mode, fmt=fmt)
    return out, metrics


def _read_or_empty(spark, path, schema):
    """A sink table that may not exist yet (no rejected event at all) reads as empty; any other fault is raised."""
    return spark.read.schema(schema).parquet(path) if files.exists(spark, path) else spark.createDataFrame([], schema)


_Q_SCHEMA = "message_id string, body string, motivo string, dt_ingestao date, run string, batch_id int"


@query("stream_ingest")
def stream_ingest(spark, d):
    """Accepted events written by ingestion date, read back (fields parsed from the kept raw body)."""
    out, _ = _stream_run(spark, d)
    acc = spark.read.parquet(f"{out}/accepted")
    return acc.select("message_id", *_fields(), (F.col("dt_ingestao") == F.current_date()).alias("ingerido_hoje"))


@query("stream_dedup")
def stream_dedup(spark, d):
    """T5: a redelivered message id is written once (accepted or quarantined)."""
    out, _ = _stream_run(spark, d)
    acc = spark.read.parquet(f"{out}/accepted").select("message_id", F.lit("accepted").alias("destino"))
    rej = _read_or_empty(spark, f"{out}/quarantine", _Q_SCHEMA).select(
        "message_id", F.lit("quarantine").alias("destino"))
    return acc.unionByName(rej).groupBy("message_id", "destino").agg(F.count(F.lit(1)).alias("copias"))


@query("stream_redelivery")
def stream_redelivery(spark, d):
    """T5: the whole stream is delivered again to a run that starts over with a new checkpoint; no id is written twice."""
    out, _ = _stream_run(spark, d)
    _stream_run(spark, d, out=out)
    acc = spark.read.parquet(f"{out}/accepted").select("message_id", F.lit("accepted").alias("destino"))
    rej = _read_or_empty(spark, f"{out}/quarantine", _Q_SCHEMA).select("message_id", F.lit("quarantine").alias("destino"))
    return acc.unionByName(rej).groupBy("message_id", "destino").agg(F.count(F.lit(1)).alias("copias"))


@query("stream_counts")
def stream_counts(spark, d):
    """Received, duplicate, accepted and rejected messages of two runs, from the written counts of their batches."""
    out, _ = _stream_run(spark, d)
    _stream_run(spark, d, out=out)
    c = _ing.batch_counts(spark, out)
    return c.agg(*[F.sum(k).alias(k) for k in ("recebidos", "duplicados", "gravados", "quarentena")])


@query("stream_json")
def stream_json(spark, d):
    """Accepted events as JSON files, one object a line, their batch folders joined, read back."""
    out, _ = _stream_run(spark, d, fmt="json")
    _ing.compact(spark, out, before="9999-12-31")
    return _ing.read_accepted(spark, out).select(*_fields())


@query("stream_quarantine")
def stream_quarantine(spark, d):
    """Rejected events land in the quarantine table with their reason."""
    out, _ = _stream_run(spark, d)
    return _read_or_empty(spark, f"{out}/quarantine", _Q_SCHEMA).select("message_id", "motivo")


@query("stream_metrics")
def stream_metrics(spark, d):
    """Read / written / quarantined counts, from the batch aggregates, checked against the sinks."""
    out, metrics = _stream_run(spark, d)
    t = metrics.totals()
    acc = spark.read.parquet(f"{out}/accepted").agg(F.count(F.lit(1)).alias("no_destino"))
    return acc.select(F.lit(t["lidos"]).cast("bigint").alias("lidos"),
                      F.lit(t["gravados"]).cast("bigint").alias("gravados"),
                      F.lit(t["quarentena"]).cast("bigint").alias("quarentena"), "no_destino")


# --- sampling and run records ----------------------------------------------------------------
@query("sample_n")
def sample_n(spark, d, n: int = 20, seed: int = 42):
    """Exactly ``min(n, rows)`` rows of the latest year, seeded, encoded as events
    (fields parsed back from the bodies for the round-trip check)."""
    from goalpost.operators.sampling import sample_exact
    latest = dashboard.at_latest(analogue.micro(spark, d))
    enc = _ev.encode(sample_exact(latest, n, "id_aluno", seed), "id_aluno")
    schema = T.StructType([T.StructField("ano", T.LongType()), T.StructField("id_municipio", T.LongType()),
                           T.StructField("id_aluno", T.StringType()), T.StructField("alfabetizado", T.StringType()),
                           T.StructField("proficiencia", T.DoubleType())])
    p = F.from_json("body", schema)
    return enc.select("message_id", *[p[f.name].alias(f.name) for f in schema.fields])


@query("run_metrics")
def run_metrics(spark, d):
    """M1: stage records of a small gated run (ingest + Silver directory)."""
    from goalpost.runs import RunLog, Stage
    log = RunLog()
    base = fresh_path(spark, "runs")
    with Stage("bronze_diretorio", log, camada="bronze") as st:
        st.linhas = write_layer(analogue.directory(spark, d), f"{base}/bronze").rows
    with Stage("silver_diretorio_municipio", log, camada="silver") as st:
        df, rules = silver.directory(read_layer(spark, f"{base}/bronze"))
        q.check("silver_diretorio_municipio", df, rules)
        st.linhas = write_layer(df, f"{base}/silver").rows
    return log.to_df(spark).select("etapa", "status", "linhas", "contexto", "erro")
