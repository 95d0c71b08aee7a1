"""The batch pipeline: Bronze ingest -> Silver (gated) -> Integration -> Gold.

Every job reads its input layer from files and writes its output layer, so a
job never recomputes its upstream.  A gated job computes its table once: the
rows are written as a new version (the write counts them by ``Observation``),
the rules run on the written columns, and the version is published only if
they pass (``sources.snapshots``); a failed gate leaves the old version readable.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goalpost.operators import quality as q
from goalpost.plans import analogue, dashboard, gold, integration, silver
from goalpost.runs import RunLog, Stage, StageState
from goalpost.sources.ingest import Source, ingest, select_sources
from goalpost.sources.layers import materialize, publish_layer, read_layer
from goalpost.sources.schemas import check_schema

log = logging.getLogger("goalpost.pipeline")


@dataclass(frozen=True)
class Layout:
    base: str

    def path(self, layer: str, name: str) -> str:
        return f"{self.base.rstrip('/')}/{layer}/{name}"


def analogue_sources(sf_dir: str) -> list[Source]:
    """The seven Bronze sources, derived from the shared test tables.

    The five indicator/target sources all derive from the fine rollup of the
    micro table; it is written once to the shared folder (on first use) and
    read by all five, so the micro table is rolled up once, not five times.
    """
    shared: dict[str, DataFrame] = {}

    def roll(s: SparkSession) -> DataFrame:
        if "roll" not in shared:
            shared["roll"] = materialize(analogue.fine_rollup(s, sf_dir), "fine-rollup")
        return shared["roll"]

    return [
        Source("alunos", lambda s: analogue.micro(s, sf_dir), "ano"),
        Source("municipio", lambda s: analogue.indicator_fine(s, sf_dir, roll(s)), "ano"),
        Source("uf", lambda s: analogue.indicator_coarse(s, sf_dir, roll(s)), "ano"),
        Source("meta_brasil", lambda s: analogue.target_country(s, sf_dir, roll(s)), "ano"),
        Source("meta_uf", lambda s: analogue.target_coarse(s, sf_dir, roll(s)), "ano"),
        Source("meta_municipio", lambda s: analogue.target_fine(s, sf_dir, roll(s)), "ano"),
        Source("diretorio_municipio", lambda s: analogue.directory(s, sf_dir), None),
    ]


def _gated_write(name: str, df: DataFrame, rules: Sequence[q.Rule] | DataFrame, path: str,
                 partition_by: str | None, runlog: RunLog, layer: str) -> None:
    """Write a new version, check the written rows, publish.  Rules given as a report (the consistency of a job's two
    inputs) are gated before anything is written."""
    with Stage(name, runlog, camada=layer) as st:
        audit = None
        if isinstance(rules, DataFrame):
            q.gate(name, rules)
        else:
            def audit(written: DataFrame) -> None:
                q.check(name, written, rules)
        _record(st, publish_layer(df, path, partition_by, audit))


def _record(st: StageState, res) -> None:
    """Rows written, and -- never silently -- rows dropped for a null period."""
    st.linhas = res.rows
    if res.dropped_null_partition:
        st.contexto["descartados_periodo_nulo"] = res.dropped_null_partition
        log.warning("%s: %d rows with a null period not written", st.nome, res.dropped_null_partition)


def run_silver(spark: SparkSession, lay: Layout, runlog: RunLog) -> None:
    rd = lambda n: check_schema(read_layer(spark, lay.path("bronze", n)), n)
    d, rules = silver.directory(rd("diretorio_municipio"))
    _gated_write("silver_diretorio_municipio", d, rules, lay.path("silver", "diretorio_municipio"), None, runlog, "silver")
    directory = read_layer(spark, lay.path("silver", "diretorio_municipio"))
    df, rules = silver.indicator_coarse(rd("uf"))
    _gated_write("silver_uf", df, rules, lay.path("silver", "uf"), "ano", runlog, "silver")
    df, rules = silver.indicator_fine(rd("municipio"), directory)
    _gated_write("silver_municipio", df, rules, lay.path("silver", "municipio"), "ano", runlog, "silver")
    for spec in silver.TARGETS:
        df, rules = silver.targets(rd(spec.name), spec)
        _gated_write(f"silver_{spec.name}", df, rules, lay.path("silver", spec.name), "ano", runlog, "silver")
    df, rules = silver.micro(rd("alunos"), directory)
    _gated_write("silver_alunos", df, rules, lay.path("silver", "alunos"), "ano", runlog, "silver")


def run_integration(spark: SparkSession, lay: Layout, runlog: RunLog) -> None:
    rs = lambda n: read_layer(spark, lay.path("silver", n))
    df, report = integration.integrate_fine(rs("municipio"), rs("meta_municipio"))
    _gated_write("silver_integracao_municipio", df, report, lay.path("silver", "municipio_integrado"), "ano", runlog, "silver")
    df, report = integration.integrate_coarse(rs("uf"), rs("meta_uf"))
    _gated_write("silver_integracao_uf", df, report, lay.path("silver", "uf_integrado"), "ano", runlog, "silver")


def run_gold(spark: SparkSession, lay: Layout, runlog: RunLog) -> None:
    rs = lambda n: read_layer(spark, lay.path("silver", n))
    with Stage("gold_indicador_municipio", runlog, camada="gold") as st:
        _record(st, publish_layer(gold.indicator_rank(rs("municipio_integrado")),
                                  lay.path("gold", "indicador_municipio"), "ano"))
    with Stage("gold_metas_vs_resultados_uf", runlog, camada="gold") as st:
        _record(st, publish_layer(gold.attainment(rs("uf_integrado")),
                                  lay.path("gold", "metas_vs_resultados_uf"), "ano"))
    with Stage("gold_evolucao_uf", runlog, camada="gold") as st:
        _record(st, publish_layer(gold.evolution(rs("uf_integrado")), lay.path("gold", "evolucao_uf")))


def run(spark: SparkSession, sources: str | Sequence[Source], base: str, only: Sequence[str] | None = None) -> RunLog:
    """Whole batch path over any registry of sources (a folder of test tables stands for its seven).

    With ``only``, the named sources are ingested and nothing after Bronze runs; without a match nothing runs.
    Returns the stage records and appends them to ``ops/pipeline_runs`` (also when a stage fails: the records up to
    the failure are kept)."""
    lay = Layout(base)
    if isinstance(sources, str):
        sources = analogue_sources(sources)
    if only and not select_sources(sources, only):
        return RunLog()
    runlog = RunLog()
    try:
        with Stage("bronze_ingestion", runlog, camada="bronze") as st:
            res = ingest(spark, sources, lay.path("bronze", ""), only=only)
            st.linhas = sum(r.rows for r in res.values())
        if only:
            return runlog
        run_silver(spark, lay, runlog)
        run_integration(spark, lay, runlog)
        run_gold(spark, lay, runlog)
    finally:
        if runlog.records:
            runs = runlog.to_df(spark).withColumn("registrado_em", F.current_timestamp())
            runs.write.mode("append").parquet(lay.path("ops", "pipeline_runs"))
    return runlog


def gold_tables(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    lay = Layout(base)
    return {n: read_layer(spark, lay.path("gold", n))
            for n in ("indicador_municipio", "metas_vs_resultados_uf", "evolucao_uf")}


def run_dashboard(spark: SparkSession, base: str) -> RunLog:
    """Every dashboard mart computed from the published Gold tables and published as ``gold/painel_<mart>``."""
    lay, runlog, g = Layout(base), RunLog(), gold_tables(spark, base)
    attained, evolved, ranked = g["metas_vs_resultados_uf"], g["evolucao_uf"], g["indicador_municipio"]
    marts = {
        "ranking_uf": dashboard.rank_latest(attained),
        "meta_vs_realizado": dashboard.target_vs_result(attained),
        "evolucao": dashboard.trend_direction(evolved),
        "top_municipios": dashboard.topk_gap(ranked, latest=dashboard.latest_of(attained)),
        "kpis": dashboard.kpis(attained, evolved, ranked),
    }
    for name, df in marts.items():
        with Stage(f"painel_{name}", runlog, camada="gold") as st:
            _record(st, publish_layer(df, lay.path("gold", f"painel_{name}")))
    return runlog
