"""DuckDB oracle SQL for the registered queries.

The analogue recipe of ``goalpost.plans.analogue`` written independently as
SQL CTEs.  Conventions that keep both engines bit-equal (SURVEY §7.5):
integers are BIGINT, rounding goes through the decimal text of the double
(``R``), ratios divide by ``NULLIF(d, 0)``, windows spell out NULLS order.
"""

from __future__ import annotations

# --- fixed values: the assessment dictionary, written out here once more so that a wrong description shows ---
REDE = {"0": "Total (Federal, Estadual, Municipal e Privada)", "1": "Federal", "2": "Estadual", "3": "Municipal",
        "4": "Privada", "5": "Publica (Estadual e Municipal)", "6": "Publica (Federal, Estadual e Municipal)"}
SERIE = {"2": "2o ano do Ensino Fundamental"}
PRESENCA = {"0": "Ausente", "1": "Presente"}
PREENCHIMENTO_CADERNO = {"0": "Prova nao preenchida", "1": "Prova preenchida"}
ALFABETIZADO = {"0": "Nao", "1": "Sim"}
# ---------------------------------------------------------------------------------------------------------------


def R(x: str, n: int) -> str:
    """Spark-compatible half-up rounding of a double."""
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


def PCT(n: str, d: str, s: int) -> str:
    return R(f"CAST({n} AS DOUBLE) / NULLIF(CAST({d} AS DOUBLE), 0) * 100", s)


def DECODE(col: str, book: dict) -> str:
    whens = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in book.items())
    return f"CASE {whens} ELSE CAST(NULL AS VARCHAR) END"


def LEVELS(m: str) -> str:
    return (f"greatest({m} - 15.0::DOUBLE, 0.0::DOUBLE) AS meta_alfabetizacao_2024, "
            f"greatest({m} - 10.0::DOUBLE, 0.0::DOUBLE) AS meta_alfabetizacao_2026, "
            f"greatest({m} - 5.0::DOUBLE, 0.0::DOUBLE) AS meta_alfabetizacao_2028, "
            f"{m} AS meta_alfabetizacao_2030")


CTES: dict[str, str] = {}
DEPS: dict[str, list[str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = body
    DEPS[name] = deps


cte("micro_src", [], f"""
  SELECT year(l_shipdate) AS ano, l_suppkey AS id_municipio, l_partkey AS id_escola,
         concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR),
                   CAST(l_suppkey AS VARCHAR), CAST(dayofyear(l_shipdate) AS VARCHAR)) AS id_aluno, '2' AS serie,
         CASE WHEN l_tax = 0.08::DOUBLE THEN '2' ELSE '3' END AS rede,
         CASE WHEN l_discount > 0.02::DOUBLE THEN '1' ELSE '0' END AS presenca,
         CASE WHEN l_discount > 0.02::DOUBLE THEN '1' ELSE '0' END AS preenchimento_caderno,
         CASE WHEN l_discount > 0.02::DOUBLE AND l_returnflag = 'R' THEN '1' ELSE '0' END AS alfabetizado,
         CASE WHEN l_discount > 0.02::DOUBLE THEN l_quantity * 20 END AS proficiencia,
         1.0::DOUBLE AS peso_aluno,
         l_orderkey AS ok_, l_partkey AS pk_
  FROM lineitem""")

cte("micro", ["micro_src"], "SELECT * EXCLUDE (ok_, pk_) FROM micro_src")

cte("directory", [], """
  SELECT s_suppkey AS id_municipio, s_name AS nome, n_name AS sigla_uf, n_name AS nome_uf,
         r_name AS nome_regiao, CAST(s_suppkey % 100 = 0 AS BIGINT) AS capital_uf,
         CAST(n_regionkey = 1 AS BIGINT) AS amazonia_legal
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")

cte("roll_fine", ["micro"], """
  SELECT id_municipio, ano, rede, serie, count(*) AS n_matric, count(proficiencia) AS n_prova,
         count_if(alfabetizado = '1') AS n_alfab, sum(proficiencia) AS soma_proficiencia
  FROM micro GROUP BY id_municipio, ano, rede, serie""")

cte("ind_fine", ["roll_fine"], f"""
  SELECT ano, id_municipio, serie, rede, {PCT('n_alfab', 'n_prova', 2)} AS taxa_alfabetizacao,
         {R('soma_proficiencia / NULLIF(CAST(n_prova AS DOUBLE), 0)', 2)} AS media_portugues
  FROM roll_fine WHERE n_prova > 0""")

cte("roll_coarse", ["roll_fine", "directory"], """
  SELECT d.sigla_uf, r.ano, r.rede, r.serie, CAST(sum(r.n_matric) AS BIGINT) AS n_matric,
         CAST(sum(r.n_prova) AS BIGINT) AS n_prova, CAST(sum(r.n_alfab) AS BIGINT) AS n_alfab,
         sum(r.soma_proficiencia) AS soma_proficiencia
  FROM roll_fine r JOIN directory d ON r.id_municipio = d.id_municipio
  GROUP BY d.sigla_uf, r.ano, r.rede, r.serie""")

cte("ind_coarse", ["roll_coarse"], f"""
  SELECT ano, sigla_uf, serie, rede, {PCT('n_alfab', 'n_prova', 2)} AS taxa_alfabetizacao,
         {R('soma_proficiencia / NULLIF(CAST(n_prova AS DOUBLE), 0)', 2)} AS media_portugues
  FROM roll_coarse WHERE n_prova > 0""")

cte("target_fine", ["roll_fine"], f"""
  SELECT ano, rede, id_municipio, {PCT('n_alfab', 'n_prova', 2)} AS taxa_alfabetizacao, {LEVELS('m')}
  FROM (SELECT *, CASE WHEN id_municipio % 50 = 49 THEN 0.0::DOUBLE
                       ELSE CAST(25 + 5 * (id_municipio % 5) AS DOUBLE) END AS m
        FROM roll_fine WHERE rede = '3') t
  WHERE {PCT('n_prova', 'n_matric', 1)} >= 70""")

cte("target_coarse", ["ind_coarse"], f"""
  SELECT ano, rede, sigla_uf, taxa_alfabetizacao, {LEVELS('m')}
  FROM (SELECT i.*, CASE WHEN n_nationkey % 9 = 4 THEN CAST(NULL AS DOUBLE)
                         WHEN n_nationkey = 24 THEN 0.0::DOUBLE
                         ELSE CAST(30 + 2 * (n_nationkey % 4) AS DOUBLE) END AS m
        FROM ind_coarse i JOIN nation ON i.sigla_uf = n_name
        WHERE i.rede = '3' AND n_nationkey % 11 <> 0) t""")

cte("target_country", ["roll_fine"], f"""
  SELECT ano, rede, {PCT('n_alfab', 'n_prova', 2)} AS taxa_alfabetizacao, {LEVELS('60.0::DOUBLE')}
  FROM (SELECT ano, rede, sum(n_prova) AS n_prova, sum(n_alfab) AS n_alfab FROM roll_fine GROUP BY ano, rede) t""")

cte("silver_fine", ["ind_fine", "directory"], f"""
  SELECT i.*, d.nome, d.sigla_uf, {DECODE('i.rede', REDE)} AS rede_desc, {DECODE('i.serie', SERIE)} AS serie_desc
  FROM (SELECT DISTINCT * FROM ind_fine) i LEFT JOIN directory d ON i.id_municipio = d.id_municipio""")

cte("silver_coarse", ["ind_coarse"], f"""
  SELECT i.*, {DECODE('rede', REDE)} AS rede_desc, {DECODE('serie', SERIE)} AS serie_desc
  FROM (SELECT DISTINCT * FROM ind_coarse) i""")

cte("integ_fine", ["silver_fine", "target_fine"], """
  SELECT i.id_municipio, i.ano, i.nome, i.sigla_uf, i.taxa_alfabetizacao, i.media_portugues,
         t.meta_alfabetizacao_2024, t.meta_alfabetizacao_2026, t.meta_alfabetizacao_2028, t.meta_alfabetizacao_2030
  FROM silver_fine i LEFT JOIN target_fine t ON i.id_municipio = t.id_municipio AND i.ano = t.ano
  WHERE i.rede = '3'""")

cte("integ_coarse", ["silver_coarse", "target_coarse"], """
  SELECT i.sigla_uf, i.ano, i.taxa_alfabetizacao, i.media_portugues,
         t.meta_alfabetizacao_2024, t.meta_alfabetizacao_2026, t.meta_alfabetizacao_2028, t.meta_alfabetizacao_2030
  FROM silver_coarse i LEFT JOIN target_coarse t ON i.sigla_uf = t.sigla_uf AND i.ano = t.ano
  WHERE i.rede = '3'""")

cte("gold_fine", ["integ_fine"], f"""
  SELECT *, {R('meta_alfabetizacao_2030 - taxa_alfabetizacao', 2)} AS gap_para_meta_2030,
         row_number() OVER (PARTITION BY sigla_uf, ano
                            ORDER BY taxa_alfabetizacao DESC NULLS LAST, id_municipio ASC NULLS LAST) AS ranking_na_uf
  FROM integ_fine""")

cte("gold_attain", ["integ_coarse"], f"""
  SELECT *, {PCT('taxa_alfabetizacao', 'meta_alfabetizacao_2030', 2)} AS atingimento_meta_2030_pct FROM integ_coarse""")

cte("gold_evol", ["integ_coarse"], f"""
  SELECT sigla_uf, ano, taxa_alfabetizacao,
         lag(taxa_alfabetizacao) OVER (PARTITION BY sigla_uf ORDER BY ano) AS taxa_ano_anterior,
         {R('taxa_alfabetizacao - lag(taxa_alfabetizacao) OVER (PARTITION BY sigla_uf ORDER BY ano)', 2)} AS variacao_pp
  FROM integ_coarse""")



cte("dirty_base", ["micro_src"], """
  SELECT ano,
         CASE WHEN ok_ % 97 = 0 THEN CAST(NULL AS BIGINT) WHEN pk_ % 89 = 0 THEN id_municipio + 1000000
              ELSE id_municipio END AS id_municipio,
         id_escola, id_aluno, serie, rede, presenca, preenchimento_caderno,
         CASE WHEN ok_ % 107 = 0 THEN 'X' ELSE alfabetizado END AS alfabetizado,
         CASE WHEN ok_ % 103 = 0 THEN 1500.0::DOUBLE ELSE proficiencia END AS proficiencia,
         peso_aluno, ok_
  FROM micro_src""")

cte("dirty", ["dirty_base"], """
  SELECT * EXCLUDE (ok_) FROM dirty_base
  UNION ALL SELECT * EXCLUDE (ok_) FROM dirty_base WHERE ok_ % 101 = 0""")

_BOOKS = {"rede": REDE, "serie": SERIE, "presenca": PRESENCA,
          "preenchimento_caderno": PREENCHIMENTO_CADERNO, "alfabetizado": ALFABETIZADO}
_DECODES = ", ".join(f"{DECODE('m.' + c, b)} AS {c}_desc" for c, b in _BOOKS.items())

cte("silver_micro", ["micro", "directory"], f"""
  SELECT m.*, {_DECODES}, d.nome, d.sigla_uf
  FROM (SELECT DISTINCT * FROM micro) m LEFT JOIN directory d ON m.id_municipio = d.id_municipio""")

cte("silver_micro_dirty", ["dirty", "directory"], f"""
  SELECT m.*, {_DECODES}, d.nome, d.sigla_uf
  FROM (SELECT DISTINCT * FROM dirty) m LEFT JOIN directory d ON m.id_municipio = d.id_municipio""")

cte("an_base", ["silver_fine", "target_fine", "silver_micro"], f"""
  SELECT i.id_municipio, i.ano, i.nome, i.sigla_uf, i.taxa_alfabetizacao AS taxa_oficial,
         (t.id_municipio IS NULL) AS orfao, c.n_matric, c.n_prova, c.n_alfab,
         {PCT('c.n_prova', 'c.n_matric', 1)} AS participacao
  FROM silver_fine i
  LEFT JOIN (SELECT DISTINCT id_municipio, ano FROM target_fine) t
         ON i.id_municipio = t.id_municipio AND i.ano = t.ano
  LEFT JOIN (SELECT id_municipio, ano, count(*) AS n_matric, count(proficiencia) AS n_prova,
                    count_if(alfabetizado = '1') AS n_alfab
             FROM silver_micro WHERE rede = '3' GROUP BY id_municipio, ano) c
         ON i.id_municipio = c.id_municipio AND i.ano = c.ano
  WHERE i.rede = '3'""")

cte("gold_gap", ["integ_fine"], f"""
  SELECT *, {R('meta_alfabetizacao_2030 - taxa_alfabetizacao', 2)} AS gap_para_meta_2030 FROM integ_fine""")


def REPORT(entries: list[tuple[int, str, str, str]], extra: str = "") -> str:
    parts = []
    for pos, rule, sev, expr in entries:
        v = f"CAST(COALESCE(({expr}), 0) AS BIGINT)"
        parts.append(f"SELECT CAST({pos} AS BIGINT) AS position, '{rule}' AS rule, '{sev}' AS severity, "
                     f"{v} AS violations, ('{sev}' = 'error' AND {v} > 0) AS failed{extra}")
    return "\nUNION ALL ".join(parts)


def DUPS(table: str, cols: str) -> str:
    return f"(SELECT count(*) FROM {table}) - (SELECT count(*) FROM (SELECT DISTINCT {cols} FROM {table}) x)"


def ORPH(table: str, ref: str, cols: list[str]) -> str:
    cond = " AND ".join(f"r.{c} = t.{c}" for c in cols)
    return f"SELECT count(*) FROM {table} t WHERE NOT EXISTS (SELECT 1 FROM {ref} r WHERE {cond})"


DIRTY_RULES = {
    "nulls": (0, "null key", "error",
              "SELECT count_if(ano IS NULL OR id_municipio IS NULL OR id_aluno IS NULL) FROM dirty"),
    "nulls2": (1, "null required field", "error",
               "SELECT count_if(serie IS NULL OR rede IS NULL OR presenca IS NULL OR preenchimento_caderno IS NULL "
               "OR alfabetizado IS NULL) FROM dirty"),
    "duplicates": (2, "duplicate key", "error", DUPS("dirty", "ano, id_aluno")),
    "domain": (3, "literate flag invalid", "error", "SELECT count_if(NOT (alfabetizado IN ('0', '1'))) FROM dirty"),
    "orphans": (4, "territory missing from directory", "error", ORPH("dirty", "directory", ["id_municipio"])),
    "range": (5, "score outside 0-1000", "error",
              "SELECT count_if(proficiencia < 0 OR proficiencia > 1000) FROM dirty"),
    "warn": (6, "score missing", "warn", "SELECT count_if(proficiencia IS NULL) FROM dirty"),
}


def with_ctes(*names: str) -> str:
    """``WITH`` clause holding ``names`` and everything they depend on, in order."""
    if not names:
        return ""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in DEPS[n]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in order) + "\n"


def sql(names: list[str] | str, select: str) -> str:
    names = [names] if isinstance(names, str) else names
    head = with_ctes(*names)
    if select.lstrip().startswith(","):  # extra CTEs continue the WITH clause
        return head.rstrip("\n") + select
    return head + select


ORACLE: dict[str, str] = {}


def _count_if_to_filter(text: str) -> str:
    """DuckDB's count_if is HUGEINT; ``count(*) FILTER (WHERE ...)`` is BIGINT."""
    out, i = [], 0
    while True:
        j = text.find("count_if(", i)
        if j < 0:
            out.append(text[i:])
            return "".join(out)
        out.append(text[i:j])
        k, depth = j + len("count_if("), 1
        while depth:
            depth += {"(": 1, ")": -1}.get(text[k], 0)
            k += 1
        out.append(f"count(*) FILTER (WHERE {text[j + len('count_if('):k - 1]})")
        i = k


def register(key: str, names: list[str] | str, select: str) -> None:
    ORACLE[key] = _count_if_to_filter(sql(names, select))


register("gold_indicator_rank", "gold_fine", "SELECT * FROM gold_fine")
register("gold_attainment", "gold_attain", "SELECT * FROM gold_attain")
register("gold_evolution", "gold_evol", "SELECT * FROM gold_evol")


# --- S1 / P1-P3 --------------------------------------------------------------
register("scan_project", [], """
SELECT l_suppkey AS id_municipio, year(l_shipdate) AS ano, l_returnflag, l_quantity FROM lineitem""")
register("filter_code", "micro", "SELECT id_aluno, ano, id_municipio, rede, proficiencia FROM micro WHERE rede = '3'")
register("null_predicates", "micro", """
SELECT ano, count_if(proficiencia IS NULL) AS sem_prova, count_if(proficiencia IS NOT NULL) AS com_prova
FROM micro GROUP BY ano""")

# --- lookups, integration ------------------------------------------------------
register("enrich_directory", ["dirty", "directory"], """
SELECT m.id_aluno, m.ano, m.id_municipio, d.nome, d.sigla_uf
FROM dirty m LEFT JOIN (SELECT DISTINCT * FROM directory) d ON m.id_municipio = d.id_municipio""")
register("lookup_salted", ["dirty", "directory"], """
SELECT m.id_aluno, m.ano, m.id_municipio, d.nome, d.sigla_uf
FROM dirty m LEFT JOIN (SELECT DISTINCT * FROM directory) d ON m.id_municipio = d.id_municipio""")
register("integrate_targets", "integ_fine", "SELECT * FROM integ_fine")
register("integrate_targets_coarse", "integ_coarse", "SELECT * FROM integ_coarse")
register("integration_consistency", ["silver_fine", "target_fine"], """,
ind AS (SELECT id_municipio, nome, sigla_uf, ano, taxa_alfabetizacao, media_portugues FROM silver_fine WHERE rede = '3'),
meta AS (SELECT id_municipio, ano, meta_alfabetizacao_2030 FROM (SELECT DISTINCT * FROM target_fine) x)
""" + REPORT([(0, "null indicator key", "error", "SELECT count_if(id_municipio IS NULL OR ano IS NULL) FROM ind"),
              (1, "territory-years without target", "warn", ORPH("ind", "meta", ["id_municipio", "ano"]))],
             ", 'indicator' AS side") + "\nUNION ALL " +
    REPORT([(10, "null target key", "error", "SELECT count_if(id_municipio IS NULL OR ano IS NULL) FROM meta"),
            (11, "target not unique on join key", "error", DUPS("meta", "id_municipio, ano"))],
           ", 'target' AS side"))

register("integration_consistency_coarse", ["silver_coarse", "target_coarse"], """,
ind AS (SELECT sigla_uf, ano FROM silver_coarse WHERE rede = '3'),
meta AS (SELECT sigla_uf, ano FROM (SELECT DISTINCT * FROM target_coarse) x)
""" + REPORT([(0, "null indicator key", "error", "SELECT count_if(sigla_uf IS NULL OR ano IS NULL) FROM ind"),
              (1, "territory-years without target", "warn", ORPH("ind", "meta", ["sigla_uf", "ano"]))],
             ", 'indicator' AS side") + "\nUNION ALL " +
    REPORT([(10, "null target key", "error", "SELECT count_if(sigla_uf IS NULL OR ano IS NULL) FROM meta"),
            (11, "target not unique on join key", "error", DUPS("meta", "sigla_uf, ano"))],
           ", 'target' AS side"))

# --- aggregations ----------------------------------------------------------------
register("micro_rollup", "micro", """
SELECT id_municipio, ano, count(*) AS n_matric, count(proficiencia) AS n_prova,
       count_if(alfabetizado = '1') AS n_alfab, sum(proficiencia) AS soma_proficiencia
FROM micro GROUP BY id_municipio, ano""")
register("dedup_full", "dirty", "SELECT DISTINCT * FROM dirty")
register("decode_codes", "dirty", f"""
SELECT id_aluno, ano, rede, serie, presenca, preenchimento_caderno, alfabetizado, {_DECODES}
FROM dirty m""")

# --- quality rules -----------------------------------------------------------------
for _key, _kind in {"rule_nulls": "nulls", "rule_duplicates": "duplicates", "rule_range": "range",
                    "rule_domain": "domain"}.items():
    _pos, _rule, _sev, _expr = DIRTY_RULES[_kind]
    register(_key, ["dirty", "directory"], REPORT([(0, _rule, _sev, _expr)]))
register("quality_report", ["dirty", "directory"], REPORT(list(DIRTY_RULES.values())))
register("orphan_keys", ["dirty", "directory"], f"""
SELECT 'documents without label' AS rule, CAST(({ORPH("documents", "labels", ["doc_id"])}) AS BIGINT) AS violations
UNION ALL
SELECT 'students without directory entry' AS rule,
       CAST(({ORPH("dirty", "directory", ["id_municipio"])}) AS BIGINT) AS violations""")

# --- Silver --------------------------------------------------------------------------
register("silver_directory", "directory", """
SELECT DISTINCT id_municipio, nome, sigla_uf, nome_uf, nome_regiao, capital_uf, amazonia_legal FROM directory""")
register("silver_indicator_fine", "silver_fine", "SELECT * FROM silver_fine")
register("silver_indicator_coarse", "silver_coarse", "SELECT * FROM silver_coarse")
register("silver_targets", ["target_country", "target_coarse", "target_fine"], """
SELECT *, 'meta_brasil' AS tabela FROM (SELECT DISTINCT * FROM target_country) a
UNION ALL BY NAME SELECT *, 'meta_uf' AS tabela FROM (SELECT DISTINCT * FROM target_coarse) b
UNION ALL BY NAME SELECT *, 'meta_municipio' AS tabela FROM (SELECT DISTINCT * FROM target_fine) c""")
register("silver_micro", "silver_micro", "SELECT * FROM silver_micro")
register("silver_publish", "silver_micro", "SELECT *, true AS recusada FROM silver_micro")
register("rule_nulls_all", ["dirty"], REPORT([
    (i, *DIRTY_RULES[k][1:]) for i, k in enumerate(("nulls", "nulls2", "warn"))]))

# --- analysis ------------------------------------------------------------------------
_BANDS = ("CASE WHEN participacao < 60 THEN '1: <60%' WHEN participacao < 70 THEN '2: 60-70%' "
          "WHEN participacao < 80 THEN '3: 70-80%' WHEN participacao < 90 THEN '4: 80-90%' ELSE '5: >=90%' END")


def XAVG(x: str) -> str:
    """Mean of the unrounded values, summed as decimals of their shortest text."""
    return (f"CAST(sum(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18))) AS DOUBLE)"
            f" / NULLIF(CAST(count({x}) AS DOUBLE), 0)")


register("missing_target_base", "an_base", "SELECT * FROM an_base")
register("missing_target_incremental", "an_base", f""",
again AS (SELECT id_municipio, ano, count(*) AS m, count(proficiencia) AS p, count_if(alfabetizado = '1') AS a
          FROM silver_micro WHERE rede = '3' AND (ano <> 1996 OR proficiencia IS NOT NULL) GROUP BY id_municipio, ano)
SELECT b.id_municipio, b.ano, nome, sigla_uf, taxa_oficial, orfao, m AS n_matric, p AS n_prova, a AS n_alfab,
       {PCT('p', 'm', 1)} AS participacao
FROM an_base b LEFT JOIN again g ON g.id_municipio = b.id_municipio AND g.ano = b.ano""")
register("missing_target_coverage", "an_base", """
SELECT count(*) AS municipio_anos, count_if(orfao) AS municipio_anos_orfaos,
       CAST(count(DISTINCT CASE WHEN orfao THEN id_municipio END)
            + max(CASE WHEN orfao AND id_municipio IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS municipios_orfaos
FROM an_base""")
register("orphan_persistence", "an_base", """
SELECT anos_como_orfao, count(*) AS count
FROM (SELECT id_municipio, count(*) AS anos_como_orfao FROM an_base WHERE orfao GROUP BY id_municipio) x
GROUP BY anos_como_orfao""")
register("participation_pattern", "an_base", f"""
SELECT orfao, {R(XAVG('participacao'), 1)} AS media_pct, quantile_disc(participacao, 0.5) AS mediana_pct,
       {R(XAVG('taxa_oficial'), 1)} AS media_taxa_oficial
FROM an_base GROUP BY orfao""")
register("orphan_rate_by_band", "an_base", f"""
SELECT faixa, count(*) AS total, CAST(sum(CAST(orfao AS INTEGER)) AS BIGINT) AS orfaos,
       {R('avg(CAST(orfao AS INTEGER)) * 100', 1)} AS pct_orfao
FROM (SELECT *, {_BANDS} AS faixa FROM an_base WHERE participacao IS NOT NULL) x GROUP BY faixa""")
register("missing_target_counterexamples", "an_base", """
SELECT id_municipio, nome, sigla_uf, ano, n_matric, n_prova, taxa_oficial, participacao
FROM an_base WHERE orfao AND n_prova >= 50 ORDER BY n_prova DESC, id_municipio, ano LIMIT 15""")
register("denominator_check", "an_base", f"""
SELECT id_municipio, nome, sigla_uf, ano, taxa_oficial, {PCT('n_alfab', 'n_prova', 1)} AS taxa_sobre_prova,
       {PCT('n_alfab', 'n_matric', 1)} AS taxa_sobre_matric
FROM an_base WHERE NOT orfao AND n_prova > 0""")

# --- dashboard marts -------------------------------------------------------------------
register("latest_period", ["gold_attain", "gold_evol"], """
SELECT (SELECT max(ano) FROM gold_attain) AS ano_max, (SELECT min(ano) FROM gold_evol) AS ano_min""")
register("rank_latest", "gold_attain", """
SELECT sigla_uf, ano, taxa_alfabetizacao, atingimento_meta_2030_pct FROM gold_attain
WHERE ano = (SELECT max(ano) FROM gold_attain)""")
register("target_vs_result", "gold_attain", """
SELECT sigla_uf, ano, taxa_alfabetizacao, meta_alfabetizacao_2030 FROM gold_attain
WHERE ano = (SELECT max(ano) FROM gold_attain)""")
register("trend_direction", "gold_evol", """
SELECT e.sigla_uf, e.ano, e.taxa_alfabetizacao, e.variacao_pp,
       CASE WHEN coalesce(l.v, 0) >= 0 THEN 'Subiu' ELSE 'Caiu' END AS tendencia
FROM gold_evol e LEFT JOIN (SELECT sigla_uf, arg_max(variacao_pp, ano) FILTER (WHERE variacao_pp IS NOT NULL) AS v
                            FROM gold_evol GROUP BY sigla_uf) l ON e.sigla_uf = l.sigla_uf""")
register("topk_gap", ["gold_gap", "gold_attain"], """
SELECT id_municipio, nome, sigla_uf, ano, gap_para_meta_2030 FROM gold_gap
WHERE ano = (SELECT max(ano) FROM gold_attain) AND gap_para_meta_2030 IS NOT NULL
ORDER BY gap_para_meta_2030 DESC, id_municipio LIMIT 20""")


def BR(x: str, dec: int) -> str:
    return f"translate(format('{{:,.{dec}f}}', CAST({x} AS DOUBLE)), ',.', '.,')"


register("kpi_latest", ["gold_attain", "gold_evol", "gold_gap"], f""",
lat AS (SELECT * FROM gold_attain WHERE ano = (SELECT max(ano) FROM gold_attain)),
best AS (SELECT sigla_uf, taxa_alfabetizacao FROM lat WHERE taxa_alfabetizacao IS NOT NULL
         ORDER BY taxa_alfabetizacao DESC, sigla_uf LIMIT 1),
rise AS (SELECT sigla_uf, variacao_pp FROM gold_evol WHERE variacao_pp IS NOT NULL
         ORDER BY variacao_pp DESC, sigla_uf LIMIT 1),
k AS (SELECT (SELECT max(ano) FROM lat) AS ano, (SELECT count_if(atingimento_meta_2030_pct >= 100) FROM lat) AS ufs_atingiram,
             (SELECT count(DISTINCT sigla_uf) FROM lat) AS ufs,
             (SELECT sigla_uf FROM best) AS melhor_uf, (SELECT taxa_alfabetizacao FROM best) AS melhor_taxa,
             (SELECT sigla_uf FROM rise) AS maior_alta_uf, (SELECT variacao_pp FROM rise) AS maior_alta_pp,
             (SELECT count(DISTINCT id_municipio) FROM gold_gap WHERE ano = (SELECT max(ano) FROM lat)) AS municipios)
SELECT *, concat(CAST(ufs_atingiram AS VARCHAR), ' de ', CAST(ufs AS VARCHAR)) AS cartao_meta,
       {BR('melhor_taxa', 2)} AS cartao_melhor_taxa, {BR('maior_alta_pp', 2)} AS cartao_maior_alta,
       {BR('municipios', 0)} AS cartao_municipios
FROM k""")

# --- profile, union ----------------------------------------------------------------------
register("table_profile", "silver_micro_dirty", """
SELECT count(*) AS total_linhas, count_if(sigla_uf IS NULL) AS linhas_sem_pai FROM silver_micro_dirty""")
register("table_preview", "silver_fine", """
SELECT id_municipio, nome, sigla_uf, rede, rede_desc, taxa_alfabetizacao FROM silver_fine
ORDER BY id_municipio, ano, rede LIMIT 5""")
register("union_by_name", [], """
SELECT c_custkey AS id, c_name AS nome, CAST(c_nationkey AS BIGINT) AS nacao, c_mktsegment AS segmento FROM customer
UNION ALL BY NAME
SELECT s_suppkey AS id, s_name AS nome, CAST(s_nationkey AS BIGINT) AS nacao, s_acctbal AS saldo FROM supplier""")

# --- storage round trips ------------------------------------------------------------------
register("bronze_ingest", "micro", "SELECT * FROM micro")
register("bronze_plain", ["directory", "micro"], """
SELECT *, (SELECT string_agg(CAST(ano AS VARCHAR), ',' ORDER BY ano) FROM (SELECT DISTINCT ano FROM micro) y) AS periodos
FROM directory""")
register("mixed_layout", "micro", """
SELECT id_aluno, proficiencia, ano, CASE WHEN ano IN (1997, 1998) THEN CAST(2 AS BIGINT) END AS lote,
       CASE WHEN ano IN (1997, 1998) THEN 'arquivo' END AS origem
FROM micro""")
register("bronze_reingest", "micro", """
SELECT * REPLACE (CASE WHEN ano = 1998 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS peso_aluno) FROM micro""")
register("bronze_null_period", "micro", """
SELECT count_if(id_escola % 113 <> 0) AS escritos, count_if(id_escola % 113 = 0) AS descartados,
       count_if(id_escola % 113 <> 0) AS lidos FROM micro""")
register("partition_prune", "micro", "SELECT * FROM micro WHERE ano = 1998")
register("gold_roundtrip", "gold_fine", "SELECT * FROM gold_fine")

# --- events -------------------------------------------------------------------------------
_MSGS = """
SELECT event_id FROM events UNION ALL SELECT event_id FROM events WHERE event_id % 20 = 5"""
_REASON = ("CASE event_id % 50 WHEN 0 THEN 'malformed' WHEN 1 THEN 'not an object' "
           "WHEN 2 THEN 'missing field' WHEN 3 THEN 'invalid constant' END")
register("event_encode", [], """
SELECT CAST(event_id AS VARCHAR) AS message_id, event_id, user_id, event_type,
       CASE WHEN event_id % 40 IN (7, 9) THEN CAST(NULL AS DOUBLE) ELSE value END AS value, props,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, false AS has_non_finite_text
FROM events""")
register("event_validate", [], f"""
SELECT CAST(event_id AS VARCHAR) AS message_id, event_id, {_REASON} AS motivo, (event_id % 50 > 3) AS valido
FROM ({_MSGS}) m""")
register("stream_ingest", [], """
SELECT CAST(event_id AS VARCHAR) AS message_id, event_id, user_id, event_type, value, props,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, true AS ingerido_hoje
FROM events WHERE event_id % 50 > 3""")
register("stream_json", [], """
SELECT event_id, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts
FROM events WHERE event_id % 50 > 3""")
register("stream_redelivery", [], """
SELECT CAST(event_id AS VARCHAR) AS message_id,
       CASE WHEN event_id % 50 > 3 THEN 'accepted' ELSE 'quarantine' END AS destino, CAST(1 AS BIGINT) AS copias
FROM events""")
register("stream_counts", [], """
SELECT 2 * (count(*) + count(*) FILTER (WHERE event_id % 20 = 5)) AS recebidos,
       count(*) + 2 * count(*) FILTER (WHERE event_id % 20 = 5) AS duplicados,
       count(*) FILTER (WHERE event_id % 50 > 3) AS gravados, count(*) FILTER (WHERE event_id % 50 <= 3) AS quarentena
FROM events""")
register("stream_dedup", [], """
SELECT CAST(event_id AS VARCHAR) AS message_id,
       CASE WHEN event_id % 50 > 3 THEN 'accepted' ELSE 'quarantine' END AS destino, CAST(1 AS BIGINT) AS copias
FROM events""")
register("stream_quarantine", [], f"""
SELECT CAST(event_id AS VARCHAR) AS message_id, {_REASON} AS motivo FROM events WHERE event_id % 50 <= 3""")
register("stream_metrics", [], """
SELECT count(*) AS lidos, count_if(event_id % 50 > 3) AS gravados, count_if(event_id % 50 <= 3) AS quarentena,
       count_if(event_id % 50 > 3) AS no_destino FROM events""")

register("sample_n", "micro", """
SELECT id_aluno AS message_id, ano, id_municipio, id_aluno, alfabetizado, proficiencia
FROM micro WHERE ano = (SELECT max(ano) FROM micro)
ORDER BY md5(id_aluno || ':42'), id_aluno LIMIT 20""")
register("run_metrics", "directory", """
SELECT 'bronze_diretorio' AS etapa, 'sucesso' AS status, count(*) AS linhas, '{"camada": "bronze"}' AS contexto,
       CAST(NULL AS VARCHAR) AS erro FROM directory
UNION ALL
SELECT 'silver_diretorio_municipio', 'sucesso', count(*), '{"camada": "silver"}', CAST(NULL AS VARCHAR)
FROM (SELECT DISTINCT * FROM directory) d""")


# --- Q8/Q9: every Silver table's rule set ------------------------------------------------------
def _nulls(t, cols):
    return f"SELECT count_if({' OR '.join(c + ' IS NULL' for c in cols)}) FROM {t}"


def _range(t, c, lo, hi):
    return f"SELECT count_if({c} < {lo} OR {c} > {hi}) FROM {t}"


def _target_rules(t, key, null_error):
    return [(0, "null key", "error", _nulls(t, key)), (1, "duplicate key", "error", DUPS(t, ", ".join(key))),
            (2, "rate outside 0-100", "error", _range(t, "taxa_alfabetizacao", 0, 100)),
            (3, "2030 target outside 0-100", "error", _range(t, "meta_alfabetizacao_2030", 0, 100)),
            (4, "rate missing at source", "warn", _nulls(t, ["taxa_alfabetizacao"])),
            (5, "null 2030 target", "error" if null_error else "warn", _nulls(t, ["meta_alfabetizacao_2030"]))]


_SR = {
    "diretorio_municipio": [(0, "null key", "error", _nulls("s_dir", ["id_municipio"])),
                            (1, "null required field", "error", _nulls("s_dir", ["nome", "sigla_uf"])),
                            (2, "duplicate key", "error", DUPS("s_dir", "id_municipio"))],
    "uf": [(0, "null key", "error", _nulls("s_uf", ["ano", "sigla_uf", "rede"])),
           (1, "null required field", "error", _nulls("s_uf", ["serie", "taxa_alfabetizacao"])),
           (2, "duplicate key", "error", DUPS("s_uf", "ano, sigla_uf, rede")),
           (3, "rate outside 0-100", "error", _range("s_uf", "taxa_alfabetizacao", 0, 100))],
    "municipio": [(0, "null key", "error", _nulls("s_mun", ["ano", "id_municipio", "rede"])),
                  (1, "null required field", "error", _nulls("s_mun", ["serie", "taxa_alfabetizacao"])),
                  (2, "duplicate key", "error", DUPS("s_mun", "ano, id_municipio, rede")),
                  (3, "rate outside 0-100", "error", _range("s_mun", "taxa_alfabetizacao", 0, 100)),
                  (4, "territory without parent", "error", _nulls("s_mun", ["sigla_uf"])),
                  (5, "territory missing from directory", "error", ORPH("s_mun", "s_dir", ["id_municipio"]))],
    "meta_brasil": _target_rules("s_mb", ["ano", "rede"], True),
    "meta_uf": _target_rules("s_muf", ["ano", "rede", "sigla_uf"], False),
    "meta_municipio": _target_rules("s_mm", ["ano", "rede", "id_municipio"], True),
    "alunos": [(0, "null key", "error", _nulls("s_al", ["ano", "id_municipio", "id_aluno"])),
               (1, "null required field", "error",
                _nulls("s_al", ["serie", "rede", "presenca", "preenchimento_caderno", "alfabetizado"])),
               (2, "duplicate key", "error", DUPS("s_al", "ano, id_aluno")),
               (3, "literate flag invalid", "error", "SELECT count_if(NOT (alfabetizado IN ('0', '1'))) FROM s_al"),
               (4, "territory missing from directory", "error", ORPH("s_al", "s_dir", ["id_municipio"]))],
}
register("silver_reports", ["directory", "silver_coarse", "silver_fine", "target_country", "target_coarse",
                            "target_fine", "silver_micro"], """,
s_dir AS (SELECT DISTINCT id_municipio, nome, sigla_uf, nome_uf, nome_regiao, capital_uf, amazonia_legal FROM directory),
s_uf AS (SELECT * FROM silver_coarse), s_mun AS (SELECT * FROM silver_fine),
s_mb AS (SELECT DISTINCT * FROM target_country), s_muf AS (SELECT DISTINCT * FROM target_coarse),
s_mm AS (SELECT DISTINCT * FROM target_fine), s_al AS (SELECT * FROM silver_micro)
""" + "\nUNION ALL ".join(REPORT(entries, f", '{name}' AS tabela") for name, entries in _SR.items()))
