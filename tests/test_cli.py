import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(*args):
    return subprocess.run([sys.executable, "-m", "goalpost", *args, "--local", "2"], cwd=ROOT,
                          capture_output=True, text=True, timeout=900)


def test_cli_pipeline_then_profile(tmp_path):
    base = str(tmp_path / "lake")
    r = _run("all", "--sf", "/root/testdata/sf0.001", "--base", base)
    assert r.returncode == 0, r.stderr[-2000:]
    records = [json.loads(ln) for ln in r.stdout.splitlines() if ln.startswith('{"etapa"')]
    assert len(records) >= 13 and all(x["status"] == "sucesso" for x in records)
    p = _run("profile", "municipio", "--base", base)
    assert p.returncode == 0, p.stderr[-2000:]
    counts = json.loads(p.stdout.splitlines()[0])
    assert counts["total_linhas"] > 0 and counts["linhas_sem_pai"] == 0


def test_own_sources_dashboard_replay_and_stream(tmp_path, spark, capsys, monkeypatch):
    """In this process: the jobs take the running session."""
    from goalpost import __main__ as cli
    from goalpost.plans import analogue, chain, dashboard, pipeline
    from goalpost.sources.layers import read_layer
    from goalpost.streaming import ingest as ing
    monkeypatch.setattr(cli, "_session", lambda local: spark)
    sf, base = "/root/testdata/sf0.001", str(tmp_path / "lake")
    args = []
    for s in pipeline.analogue_sources(sf):
        path = str(tmp_path / "own" / s.name)
        s.loader(spark).write.parquet(path)
        args += ["--source", f"{s.name}={path}" + (f"@{s.partition}" if s.partition else "")]
    assert cli.main(["all", "--base", base, *args]) == 0
    assert cli.main(["dashboard", "--base", base]) == 0
    same = lambda a, b: a.exceptAll(b.select(a.columns)).isEmpty() and b.select(a.columns).exceptAll(a).isEmpty()
    mart = lambda n: read_layer(spark, f"{base}/gold/painel_{n}")
    att, evo = chain.gold_attainment(spark, sf), chain.gold_evolution(spark, sf)
    assert same(mart("ranking_uf"), dashboard.rank_latest(att)) and same(mart("evolucao"), dashboard.trend_direction(evo))
    assert mart("kpis").count() == 1 and 0 < mart("top_municipios").count() <= 20
    assert cli.main(["replay", "--base", base, "--n", "7", "--year", "1998"]) == 0
    assert cli.main(["stream", "--base", base, "--messages", f"{base}/replay/alunos", "--sink", "json"]) == 0
    out = f"{base}/bronze/streaming"
    assert cli.main(["compact", "--base", base, "--before", "9999-12-31"]) == 0
    got = [json.loads(r.body) for r in ing.read_accepted(spark, out).collect()]
    assert len(got) == 7 and {g["ano"] for g in got} == {1998}
    known = {r.id_aluno for r in analogue.micro(spark, sf).select("id_aluno").collect()}
    assert {g["id_aluno"] for g in got} <= known


def test_source_text():
    import pytest
    from goalpost.__main__ import own_source
    assert (own_source("a=/x/y@ano").name, own_source("a=/x/y@ano").partition) == ("a", "ano")
    assert own_source("b=csv:s3a://bucket/x").partition is None
    with pytest.raises(SystemExit):
        own_source("nothing")
