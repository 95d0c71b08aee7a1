"""Command line: run the pipeline jobs the way the reference runs its scripts.

    python -m goalpost all       --sf /root/testdata/sf0.1 --base /shared/lake
    python -m goalpost ingest    --sf ... --base ... [--only alunos uf]
    python -m goalpost silver    --base ...
    python -m goalpost integrate --base ...
    python -m goalpost gold      --base ...
    python -m goalpost analysis  --base ...
    python -m goalpost profile   --base ... [--layer silver] [table]
    python -m goalpost dashboard --base ...                  # the five marts, from the Gold layer, to gold/painel_*
    python -m goalpost replay    --base ... [--n 20] [--seed 42] [--year 2024]
    python -m goalpost stream    --base ... (--sf ... | --messages FOLDER) [--mode fail|quarantine] [--sink parquet|json]
    python -m goalpost compact   --base ... [--before 2025-01-31]

``all`` and ``ingest`` read the seven sources derived from the test tables of ``--sf``, or your own:
``--source NAME=PATH[@PERIOD_COLUMN]`` (repeatable; Parquet, or ``csv:PATH`` / ``json:PATH`` / ``orc:PATH``).

The session comes from ``SparkSession.builder.getOrCreate()`` (spark-submit
decides master and settings); ``--local N`` starts a local session instead.
"""

from __future__ import annotations

import argparse
import json
import logging

from pyspark.sql import SparkSession


def _session(local: str | None) -> SparkSession:
    if local:
        from goalpost.session import local_session
        return local_session(local)
    return SparkSession.builder.appName("goalpost").getOrCreate()


def own_source(text: str):
    """A Bronze source from ``NAME=[FORMAT:]PATH[@PERIOD_COLUMN]``."""
    from goalpost.sources.ingest import Source
    name, _, rest = text.partition("=")
    kind, sep, path = rest.partition(":")
    if not sep or kind not in ("parquet", "csv", "json", "orc"):
        kind, path = "parquet", rest
    path, _, period = path.partition("@")
    if not name or not path:
        raise SystemExit(f"not NAME=[FORMAT:]PATH[@PERIOD_COLUMN]: {text}")

    def load(spark: SparkSession):
        reader = spark.read.format(kind)
        return (reader.option("header", "true").option("inferSchema", "true") if kind == "csv" else reader).load(path)
    return Source(name, load, period or None)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="goalpost")
    ap.add_argument("job", choices=["all", "ingest", "silver", "integrate", "gold", "analysis", "profile", "dashboard",
                                    "replay", "stream", "compact"])
    ap.add_argument("table", nargs="?", default="municipio")
    ap.add_argument("--sf", default="/root/testdata/sf0.1", help="folder of the source tables")
    ap.add_argument("--base", required=True, help="lake root (bronze/silver/gold below it)")
    ap.add_argument("--only", nargs="*", help="ingest only these sources")
    ap.add_argument("--layer", default="silver")
    ap.add_argument("--mode", default="quarantine", choices=["fail", "quarantine"])
    ap.add_argument("--source", action="append", default=[], help="NAME=[FORMAT:]PATH[@PERIOD_COLUMN]")
    ap.add_argument("--messages", help="folder of (message_id, body) Parquet files to stream, e.g. a replay's")
    ap.add_argument("--sink", default="parquet", choices=["parquet", "json"])
    ap.add_argument("--required", nargs="*", help="fields a message must have")
    ap.add_argument("--before", help="compact ingestion dates before this one (default: today)")
    ap.add_argument("--n", type=int, default=20)
    ap.add_argument("--seed", type=int, default=42)
    ap.add_argument("--year", type=int)
    ap.add_argument("--local", help="run on local[N] instead of the submitted session")
    a = ap.parse_intermixed_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(message)s")
    spark = _session(a.local)
    from goalpost.plans import pipeline
    from goalpost.runs import RunLog, Stage
    lay, log = pipeline.Layout(a.base), RunLog()
    sources = [own_source(x) for x in a.source] or a.sf
    if a.job in ("all",):
        log = pipeline.run(spark, sources, a.base, only=a.only)
    elif a.job == "ingest":
        from goalpost.sources.ingest import ingest
        with Stage("bronze_ingestion", log, camada="bronze") as st:
            res = ingest(spark, pipeline.analogue_sources(sources) if isinstance(sources, str) else sources, lay.path("bronze", ""), only=a.only)
            st.linhas = sum(r.rows for r in res.values())
    elif a.job == "silver":
        pipeline.run_silver(spark, lay, log)
    elif a.job == "integrate":
        pipeline.run_integration(spark, lay, log)
    elif a.job == "gold":
        pipeline.run_gold(spark, lay, log)
    elif a.job == "analysis":
        from goalpost.plans import analysis
        from goalpost.sources.layers import read_layer
        rs = lambda n: read_layer(spark, lay.path("silver", n))
        out = analysis.run_all(rs("municipio"), rs("meta_municipio"), rs("alunos"))
        print(json.dumps(out, ensure_ascii=False, default=str, indent=1))
    elif a.job == "profile":
        from goalpost.sources.layers import profile, read_layer
        counts, preview = profile(read_layer(spark, lay.path(a.layer, a.table)))
        print(json.dumps(counts.first().asDict()))
        preview.show(truncate=False)
    elif a.job == "dashboard":
        log = pipeline.run_dashboard(spark, a.base)
    elif a.job == "replay":
        from goalpost.plans.dashboard import at_latest
        from goalpost.sources.layers import read_layer
        from goalpost.streaming import sources as src
        students = read_layer(spark, lay.path("bronze", "alunos"))
        students = at_latest(students) if a.year is None else students.where(students["ano"] == a.year)
        print(src.write_replay(students, "id_aluno", a.n, lay.path("replay", "alunos"), a.seed))
    elif a.job == "stream":
        from goalpost.streaming import ingest as ing
        from goalpost.streaming import sources as src
        if a.messages:
            known = spark.read.parquet(a.messages).schema
            stream = spark.readStream.schema(known).option("maxFilesPerTrigger", 100).parquet(a.messages)
        else:
            stream = src.message_stream(spark, a.sf)
        required = a.required or (src.STUDENT_REQUIRED if a.messages else src.REQUIRED)
        m = ing.run_ingest(stream, lay.path("bronze", "streaming"), lay.path("_checkpoints", "streaming"), required,
                           mode=a.mode, fmt=a.sink)
        print(json.dumps(m.totals()))
    elif a.job == "compact":
        from datetime import date
        from goalpost.streaming import ingest as ing
        print(json.dumps(ing.compact(spark, lay.path("bronze", "streaming"), a.before or date.today().isoformat())))
    for r in log.records:
        print(json.dumps(r, ensure_ascii=False, default=str))
    return 0 if all(r["status"] == "sucesso" for r in log.records) else 1


if __name__ == "__main__":
    raise SystemExit(main())
