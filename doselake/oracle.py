"""ANSI SQL for every registered query, over the same test tables.

Each statement is a chain of named steps; ``_with`` prepends the steps a query
needs, in dependency order. Rates are rounded and dates cast to text as in
``registry.comparable``.
"""

from __future__ import annotations

from .functions.calendar import MONTH_ABBREVIATIONS, MONTH_NAMES
from .operators.quality import ERROR
from .plans import checks, pipeline
from .plans.facts import RELATIONS
from .registry import (
    BROKEN_MONTH,
    D08_MONTH,
    RATE_DIGITS,
    RELOADED_YEAR,
    SECONDS_BANDS_SQL,
    UNEVEN_MONTH,
    WHOLE_OR_NULL,
)
from .sources import derived, seeds
from .sources.tables import BRONZE_COLUMNS


def _literal(value) -> str:
    if value is None:
        return "NULL"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else repr(value)


def _values(rows: list[tuple], columns: str) -> str:
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({columns})"


_RAW = ", ".join(BRONZE_COLUMNS)
_TIES = ", ".join(
    f"{c} DESC NULLS LAST" for c in BRONZE_COLUMNS if c not in ("co_documento", "dt_deletado_rnds")
)
_MONTHS = ", ".join(_literal(n) for n in MONTH_NAMES)
_SHORT = ", ".join(_literal(a) for a in MONTH_ABBREVIATIONS)

# Which of the two places a row is judged by, then what that place says.
_PLACED = """
SELECT r.*, u.sg_uf AS uf_derivada,
  CASE origem_local WHEN 'SEM_PAIS' THEN 'SEM INFORMACAO' WHEN 'EXTERIOR' THEN 'ESTRANGEIRO'
    ELSE coalesce(uf_direta, u.sg_uf, 'SEM INFORMACAO') END AS uf_cobertura
FROM (
  SELECT q.*,
    nullif(CASE origem_local WHEN 'RESIDENCIA' THEN co_municipio_paciente
                             WHEN 'APLICACAO' THEN co_municipio_estabelecimento END, '999999') AS municipio_cobertura,
    nullif(CASE origem_local WHEN 'RESIDENCIA' THEN sg_uf_paciente
                             WHEN 'APLICACAO' THEN sg_uf_estabelecimento END, 'XX') AS uf_direta
  FROM (
    SELECT b.*,
      CASE WHEN coalesce(co_pais_paciente, '') = '' THEN 'SEM_PAIS'
           WHEN co_pais_paciente <> '10' THEN 'EXTERIOR'
           WHEN coalesce(co_municipio_paciente, '') IN ('', '999999') THEN 'APLICACAO'
           ELSE 'RESIDENCIA' END AS origem_local
    FROM {source} b
  ) q
) r LEFT JOIN uf_ibge u ON substr(r.municipio_cobertura, 1, 2) = CAST(u.co_uf AS VARCHAR)
"""

_STEPS: dict[str, tuple[tuple[str, ...], str]] = {
    "bronze": ((), derived.BRONZE_SQL),
    "diretorio": ((), derived.DIRECTORY_SQL),
    "populacao": (
        ("diretorio",),
        "SELECT id_municipio, CAST(ano AS BIGINT) AS ano, CAST(populacao AS BIGINT) AS populacao"
        f" FROM ({derived.POPULATION_SQL_ANSI}) p",
    ),
    "uf_ibge": ((), _values(seeds.UF_ROWS, "co_uf, sg_uf, nome_uf")),
    "faixa_etaria": (
        (),
        _values(seeds.AGE_BAND_ROWS, "ordem, idade_min, idade_max, nome_faixa_etaria"),
    ),
    "meta_vacinal": (
        (),
        "SELECT ordem, vacina, dose, CAST(meta_cobertura AS DOUBLE) AS meta_cobertura FROM ("
        + _values(seeds.TARGET_ROWS, "ordem, vacina, dose, meta_cobertura")
        + ") m",
    ),
    "vivos": (
        ("bronze",),
        f"""SELECT {_RAW} FROM (
              SELECT *, row_number() OVER (PARTITION BY co_documento
                ORDER BY TRY_CAST(dt_entrada_rnds AS TIMESTAMP) DESC NULLS LAST, {_TIES}) AS posicao
              FROM bronze WHERE dt_deletado_rnds IS NULL) x
            WHERE posicao = 1""",
    ),
    "bronze_local": (("bronze", "uf_ibge"), _PLACED.format(source="bronze")),
    "vivos_local": (("vivos", "uf_ibge"), _PLACED.format(source="vivos")),
    "silver": (
        ("vivos_local",),
        """SELECT co_documento AS codigo_documento, dt_deletado_rnds AS data_deletado_rnds,
             ds_nome AS nome_vacina_bruto, ds_tipo_dose AS nome_dose_bruto,
             no_estrategia AS nome_estrategia_bruto,
             co_municipio_estabelecimento, co_municipio_paciente, co_pais_paciente, co_vacina,
             co_dose_vacina, co_estrategia_vacinacao, sg_uf_paciente, sg_uf_estabelecimento,
             co_raca_cor_paciente, no_raca_cor_paciente, tp_sexo_paciente,
             TRY_CAST(dt_vacina AS DATE) AS data_vacina,
             TRY_CAST(dt_entrada_rnds AS TIMESTAMP) AS data_entrada_rnds,
             TRY_CAST(nu_idade_paciente AS BIGINT) AS idade_paciente,
             municipio_cobertura, uf_cobertura,
             coalesce(co_raca_cor_paciente, '99') AS raca_cor_cobertura,
             coalesce(no_raca_cor_paciente, 'SEM INFORMACAO') AS nome_raca_cor_cobertura,
             CASE WHEN tp_sexo_paciente IN ('F', 'M') THEN tp_sexo_paciente
                  ELSE 'SEM INFORMACAO' END AS sexo_cobertura,
             coalesce(co_estrategia_vacinacao, 'SEM INFORMACAO') AS estrategia_cobertura,
             coalesce(ds_nome, 'SEM INFORMACAO') AS nome_vacina_cobertura,
             coalesce(ds_tipo_dose, 'SEM INFORMACAO') AS nome_dose_cobertura,
             coalesce(no_estrategia, 'SEM INFORMACAO') AS nome_estrategia_cobertura,
             origem_local
           FROM vivos_local""",
    ),
    "populacao_recente": (
        ("populacao",),
        """SELECT id_municipio, ano, populacao FROM (
             SELECT *, row_number() OVER (PARTITION BY id_municipio
                                          ORDER BY ano DESC, populacao DESC) AS posicao
             FROM populacao WHERE populacao IS NOT NULL AND ano <= 2025) x
           WHERE posicao = 1""",
    ),
    "municipios": (
        ("diretorio", "populacao_recente"),
        """SELECT d.id_municipio, substr(d.id_municipio, 1, 6) AS id_municipio_6d,
             d.nome AS nome_municipio, d.sigla_uf, d.nome_regiao, p.populacao, p.ano AS ano_populacao
           FROM diretorio d LEFT JOIN populacao_recente p ON p.id_municipio = d.id_municipio""",
    ),
    "dim_tempo": (
        (),
        f"""SELECT CAST(m AS DATE) AS mes, CAST(year(m) AS BIGINT) AS ano,
             CAST(month(m) AS BIGINT) AS mes_numero,
             list_extract([{_MONTHS}], CAST(month(m) AS INTEGER)) AS nome_mes,
             CAST(quarter(m) AS BIGINT) AS trimestre
           FROM (SELECT unnest(generate_series(DATE '{derived.CALENDAR_START}',
                                               DATE '{derived.CALENDAR_END}',
                                               INTERVAL 1 MONTH)) AS m) s""",
    ),
    # Members by class: towns of the directory, districts that stand for the capital, others.
    "membros": (
        ("silver", "municipios"),
        """SELECT codigo, uf, uf IN ('SEM INFORMACAO', 'ESTRANGEIRO') AS especial,
             CASE WHEN codigo IN (SELECT id_municipio_6d FROM municipios) THEN 'listado'
                  WHEN codigo LIKE '53%' AND '530010' IN (SELECT id_municipio_6d FROM municipios) THEN 'distrito'
                  ELSE 'outro' END AS classe
           FROM (SELECT municipio_cobertura AS codigo, uf_cobertura AS uf FROM silver GROUP BY ALL) s""",
    ),
    "dim_municipio": (
        ("membros", "municipios"),
        """SELECT coalesce(codigo, uf) AS chave_municipio, codigo AS codigo_ibge, uf, nome_municipio,
             nome_regiao, populacao, ano_populacao,
             CASE uf WHEN 'SEM INFORMACAO' THEN 'Sem informação' WHEN 'ESTRANGEIRO' THEN 'Estrangeiro'
               ELSE tipo END AS tipo_registro
           FROM (
             SELECT codigo, uf, nome_municipio, nome_regiao, populacao, ano_populacao, 'Município válido' AS tipo
             FROM membros, municipios WHERE classe = 'listado' AND id_municipio_6d = codigo
             UNION ALL
             SELECT codigo, uf, nome_municipio, nome_regiao, populacao, ano_populacao,
               'Região administrativa do DF (aprox. Brasília)'
             FROM membros, municipios WHERE classe = 'distrito' AND id_municipio_6d = '530010'
             UNION ALL
             SELECT codigo, uf, NULL, CASE WHEN regiao IS NOT NULL THEN regiao WHEN especial THEN uf END, NULL, NULL,
               CASE WHEN regiao IS NOT NULL AND codigo LIKE '%0000' THEN 'UF sem município específico'
                    ELSE 'Município válido' END
             FROM (SELECT *, (SELECT max(nome_regiao) FROM municipios WHERE sigla_uf = uf) AS regiao
                   FROM membros WHERE classe = 'outro') o
           ) c""",
    ),
    "dim_vacina": (
        ("silver",),
        """SELECT DISTINCT co_vacina || '-' || co_dose_vacina AS chave_vacina, co_vacina, co_dose_vacina,
             nome_vacina_cobertura AS nome_vacina, nome_dose_cobertura AS nome_dose FROM silver""",
    ),
    "dim_perfil": (
        ("silver",),
        """SELECT DISTINCT raca_cor_cobertura || '-' || sexo_cobertura AS chave_perfil,
             raca_cor_cobertura AS codigo_raca_cor, nome_raca_cor_cobertura AS nome_raca_cor,
             sexo_cobertura AS sexo,
             CASE sexo_cobertura WHEN 'F' THEN 'Feminino' WHEN 'M' THEN 'Masculino'
                  ELSE 'Sem informação' END AS nome_sexo FROM silver""",
    ),
    "dim_estrategia": (
        ("silver",),
        """SELECT DISTINCT estrategia_cobertura AS chave_estrategia,
             nome_estrategia_cobertura AS nome_estrategia FROM silver""",
    ),
    "chaves": (
        ("silver", "faixa_etaria"),
        """SELECT CAST(date_trunc('month', s.data_vacina) AS DATE) AS mes_vacina,
             coalesce(s.municipio_cobertura, s.uf_cobertura) AS chave_municipio,
             s.co_vacina || '-' || s.co_dose_vacina AS chave_vacina,
             coalesce(f.ordem, 0) AS chave_faixa_etaria,
             s.raca_cor_cobertura || '-' || s.sexo_cobertura AS chave_perfil,
             s.estrategia_cobertura AS chave_estrategia
           FROM silver s LEFT JOIN faixa_etaria f
             ON s.idade_paciente >= f.idade_min AND s.idade_paciente <= f.idade_max""",
    ),
    "fato": (("chaves",), "SELECT *, count(*) AS qtd_doses FROM chaves GROUP BY ALL"),
    "resumo": (
        ("fato",),
        """SELECT mes_vacina, chave_municipio, chave_vacina, chave_faixa_etaria,
             CAST(sum(qtd_doses) AS BIGINT) AS qtd_doses FROM fato GROUP BY ALL""",
    ),
    # Fact rows with the columns of the place dimension the measures slice by.
    "fato_local": (
        ("fato", "dim_municipio"),
        """SELECT f.*, m.uf, m.nome_regiao, m.tipo_registro, m.populacao
           FROM fato f LEFT JOIN dim_municipio m ON m.chave_municipio = f.chave_municipio""",
    ),
    "taxa_uf": (
        ("fato_local", "dim_municipio"),
        """SELECT d.uf, d.doses / nullif(p.populacao, 0) AS taxa
           FROM (SELECT uf, CAST(sum(qtd_doses) AS DOUBLE) AS doses FROM fato_local GROUP BY uf) d
           LEFT JOIN (SELECT uf, sum(populacao) AS populacao FROM dim_municipio GROUP BY uf) p
             ON p.uf IS NOT DISTINCT FROM d.uf""",
    ),
    "taxa_municipio": (
        ("fato", "dim_municipio"),
        """SELECT m.chave_municipio, m.nome_regiao, m.tipo_registro,
             CAST(d.doses AS DOUBLE) / nullif(m.populacao, 0) AS taxa
           FROM dim_municipio m
           LEFT JOIN (SELECT chave_municipio, sum(qtd_doses) AS doses FROM fato GROUP BY 1) d
             ON d.chave_municipio = m.chave_municipio""",
    ),
    "meta": (("meta_vacinal",), "SELECT avg(meta_cobertura) AS meta FROM meta_vacinal"),
    "serie": (
        ("fato", "dim_tempo"),
        """SELECT t.mes, t.ano, d.doses FROM dim_tempo t
           LEFT JOIN (SELECT mes_vacina, sum(qtd_doses) AS doses FROM fato GROUP BY 1) d
             ON d.mes_vacina = t.mes""",
    ),
    "nomes_arquivo": (
        ("bronze",),
        f"""SELECT mes_referencia, linhas, mes_num, ano, lpad(CAST(mes_num AS VARCHAR), 2, '0') AS mm,
             list_extract([{_SHORT}], mes_num) AS abrev
           FROM (SELECT mes_referencia, count(*) AS linhas,
                   CAST(substr(mes_referencia, 6, 2) AS INTEGER) AS mes_num,
                   CAST(CAST(substr(mes_referencia, 1, 4) AS INTEGER) + {derived.YEAR_SHIFT} AS VARCHAR) AS ano
                 FROM bronze GROUP BY mes_referencia) x""",
    ),
}


def _with(needs: tuple[str, ...] | list[str], body: str) -> str:
    ordered: list[str] = []

    def visit(step: str) -> None:
        if step not in ordered:
            for parent in _STEPS[step][0]:
                visit(parent)
            ordered.append(step)

    for need in needs:
        visit(need)
    steps = ",\n".join(f"{s} AS ({_STEPS[s][1]})" for s in ordered)
    return f"WITH {steps}\n{body}"


def _rate(expression: str) -> str:
    return f"round({expression}, {RATE_DIGITS})"


def _text(column: str) -> str:
    return f"CAST({column} AS VARCHAR)"


# --- marts ------------------------------------------------------------------------------

_TABLE_OF = {
    "tempo": "dim_tempo",
    "municipio": "dim_municipio",
    "vacina": "dim_vacina",
    "faixa": "faixa_etaria",
    "perfil": "dim_perfil",
    "estrategia": "dim_estrategia",
}


def _mart(source: str, tables: list[str]) -> str:
    columns, joins = [], []
    for r in (r for r in RELATIONS if r.table in tables):
        key = f"f.{r.fact_key}"
        columns.append(f"{_text(key)} AS {r.fact_key}" if r.table == "tempo" else key)
        columns += [f"{r.table}.{c}" for c in r.attributes]
        joins.append(f"LEFT JOIN {_TABLE_OF[r.table]} {r.table} ON {r.table}.{r.key} = {key}")
    body = f"SELECT {', '.join(columns)}, f.qtd_doses FROM {source} f {' '.join(joins)}"
    return _with([source, *[_TABLE_OF[t] for t in tables]], body)


# --- measures -----------------------------------------------------------------------------


def _share(key: str, name: str) -> str:
    return _with(
        ["fato_local"],
        f"""SELECT p.uf, p.{key}, {_rate('CAST(p.doses AS DOUBLE) / t.doses')} AS {name}
            FROM (SELECT uf, {key}, sum(qtd_doses) AS doses FROM fato_local GROUP BY uf, {key}) p
            JOIN (SELECT uf, sum(qtd_doses) AS doses FROM fato_local GROUP BY uf) t
              ON t.uf IS NOT DISTINCT FROM p.uf""",
    )


def _by_region(value: str, name: str) -> str:
    return _with(
        ["taxa_municipio"],
        f"SELECT nome_regiao, {_rate(value)} AS {name} FROM taxa_municipio GROUP BY nome_regiao",
    )


_REAL = "('Município válido', 'Região administrativa do DF (aprox. Brasília)')"
_SERIES_BEFORE = "SELECT *, lag(doses) OVER (ORDER BY mes) AS antes FROM serie"
_RANKED = """SELECT chave_municipio,
               rank() OVER (ORDER BY coalesce(taxa, 0)) AS ranking FROM taxa_municipio"""

_MEASURES = {
    "d01": _with(
        ["fato_local"],
        "SELECT uf, CAST(sum(qtd_doses) AS BIGINT) AS total_doses FROM fato_local GROUP BY uf",
    ),
    "d02": _with(
        ["dim_municipio"],
        "SELECT uf, CAST(sum(populacao) AS BIGINT) AS populacao_coberta FROM dim_municipio GROUP BY uf",
    ),
    "d02_dedup": _with(
        ["dim_municipio"],
        """SELECT uf, CAST(sum(populacao) AS BIGINT) AS populacao_coberta
           FROM (SELECT DISTINCT uf, nome_municipio, populacao FROM dim_municipio) u GROUP BY uf""",
    ),
    "d03": _with(
        ["dim_municipio"],
        f"""SELECT count(DISTINCT chave_municipio) AS total_municipios
            FROM dim_municipio WHERE tipo_registro IN {_REAL}""",
    ),
    "d04": _with(
        ["dim_vacina"], "SELECT count(DISTINCT chave_vacina) AS total_vacinas FROM dim_vacina"
    ),
    "d05": _with(["taxa_uf"], f"SELECT uf, {_rate('taxa')} AS taxa_cobertura FROM taxa_uf"),
    "d05_uf_month": _with(
        ["fato_local", "dim_municipio"],
        f"""SELECT d.uf, {_text('d.mes')} AS mes,
              {_rate('d.doses / nullif(p.populacao, 0)')} AS taxa_cobertura
            FROM (SELECT uf, mes_vacina AS mes, CAST(sum(qtd_doses) AS DOUBLE) AS doses
                  FROM fato_local WHERE chave_faixa_etaria IN (1, 2, 3) GROUP BY 1, 2) d
            LEFT JOIN (SELECT uf, sum(populacao) AS populacao FROM dim_municipio GROUP BY uf) p
              ON p.uf IS NOT DISTINCT FROM d.uf""",
    ),
    "d06": _with(
        ["taxa_uf"], f"SELECT uf, {_rate('taxa * 100000')} AS cobertura_100mil FROM taxa_uf"
    ),
    "d07": _with(
        ["dim_municipio", "meta"],
        f"""SELECT DISTINCT nome_regiao, {_rate('meta')} AS meta_oficial
            FROM dim_municipio, meta""",
    ),
    "d08": _with(
        ["taxa_uf", "meta"],
        f"""SELECT uf, {_rate('(coalesce(taxa, 0) - meta) * 100')} AS gap_meta_pp
            FROM taxa_uf, meta""",
    ),
    "d09": _with(
        ["serie"],
        f"""SELECT {_text('mes')} AS mes, CAST(antes AS BIGINT) AS doses_mes_anterior
            FROM ({_SERIES_BEFORE}) s""",
    ),
    "d10": _with(
        ["serie"],
        f"""SELECT {_text('mes')} AS mes,
              {_rate('CAST(coalesce(doses, 0) - antes AS DOUBLE) / nullif(antes, 0)')} AS variacao_mom
            FROM ({_SERIES_BEFORE}) s""",
    ),
    "d10_region_2000": _with(
        ["fato_local", "dim_tempo"],
        f"""SELECT nome_regiao, {_text('mes')} AS mes,
              {_rate('CAST(coalesce(doses, 0) - antes AS DOUBLE) / nullif(antes, 0)')} AS variacao_mom
            FROM (SELECT *, lag(doses) OVER (PARTITION BY nome_regiao ORDER BY mes) AS antes
                  FROM (SELECT g.nome_regiao, g.mes, d.doses
                        FROM (SELECT * FROM (SELECT DISTINCT nome_regiao FROM fato_local) r,
                                            (SELECT mes FROM dim_tempo) t) g
                        LEFT JOIN (SELECT nome_regiao, mes_vacina, sum(qtd_doses) AS doses
                                   FROM fato_local GROUP BY 1, 2) d
                          ON d.nome_regiao IS NOT DISTINCT FROM g.nome_regiao
                         AND d.mes_vacina = g.mes) x) y
            WHERE year(mes) = 2000""",
    ),
    "d11": _with(
        ["serie"],
        f"""SELECT {_text('mes')} AS mes,
              CAST(sum(doses) OVER (PARTITION BY ano ORDER BY mes) AS BIGINT) AS doses_ytd FROM serie""",
    ),
    "d12": _by_region("avg(taxa)", "cobertura_media"),
    "d13": _by_region("stddev_pop(taxa)", "desvio_padrao"),
    "d14": _by_region("stddev_pop(taxa) / nullif(avg(taxa), 0)", "coef_variacao"),
    "d15": _with(["taxa_municipio"], _RANKED),
    "d15_worst": _with(
        ["taxa_municipio"], f"SELECT * FROM ({_RANKED}) r ORDER BY ranking, chave_municipio LIMIT 20"
    ),
    "d16": _with(
        ["taxa_municipio", "meta"],
        f"""SELECT nome_regiao, {_rate(
            "CAST(nullif(count(DISTINCT CASE WHEN coalesce(taxa, 0) < meta THEN chave_municipio END), 0) AS DOUBLE)"
            f" / nullif(count(DISTINCT CASE WHEN tipo_registro IN {_REAL} THEN chave_municipio END), 0)"
        )} AS pct_abaixo_meta FROM taxa_municipio, meta GROUP BY nome_regiao""",
    ),
    "d17": _with(
        ["fato_local"],
        f"""SELECT {_rate(
            "CAST(sum(CASE WHEN coalesce(tipo_registro, '') <> 'Município válido' THEN qtd_doses END) AS DOUBLE)"
            " / sum(qtd_doses)"
        )} AS pct_nao_municipio_valido FROM fato_local""",
    ),
    # The same measures under other slicers.
    "d02_mes": _with(
        ["fato", "dim_tempo", "dim_municipio"],
        f"""SELECT {_text('mes')} AS mes,
              (SELECT CAST(sum(populacao) AS BIGINT) FROM dim_municipio) AS populacao_coberta
            FROM (SELECT mes FROM dim_tempo UNION SELECT mes_vacina FROM fato) x""",
    ),
    "d03_faixa": _with(
        ["fato", "faixa_etaria", "dim_municipio"],
        f"""SELECT chave_faixa_etaria,
              (SELECT count(DISTINCT chave_municipio) FROM dim_municipio
               WHERE tipo_registro IN {_REAL}) AS total_municipios
            FROM (SELECT ordem AS chave_faixa_etaria FROM faixa_etaria
                  UNION SELECT chave_faixa_etaria FROM fato) x""",
    ),
    "d04_dose": _with(
        ["dim_vacina"],
        """SELECT nome_dose, count(DISTINCT chave_vacina) AS total_vacinas
           FROM dim_vacina GROUP BY nome_dose""",
    ),
    "d08_uf_vacina": _with(
        ["fato_local", "dim_municipio", "meta_vacinal"],
        f"""SELECT p.uf, {_rate('(coalesce(d.doses / nullif(p.populacao, 0), 0) - m.meta) * 100')} AS gap_meta_pp
            FROM (SELECT uf, sum(populacao) AS populacao FROM dim_municipio GROUP BY uf) p
            LEFT JOIN (SELECT uf, CAST(sum(qtd_doses) AS DOUBLE) AS doses FROM fato_local
                       WHERE mes_vacina = DATE '{D08_MONTH}' AND chave_faixa_etaria = 1
                       GROUP BY uf) d ON d.uf IS NOT DISTINCT FROM p.uf,
              (SELECT avg(meta_cobertura) AS meta FROM meta_vacinal WHERE vacina = 'BCG') m""",
    ),
    "d09_trimestre": _with(
        ["serie"],
        f"""SELECT CAST(quarter(mes) AS BIGINT) AS trimestre,
              CAST(sum(antes) AS BIGINT) AS doses_mes_anterior
            FROM ({_SERIES_BEFORE}) s GROUP BY 1""",
    ),
    "d10_ano": _with(
        ["serie"],
        f"""SELECT ano, {_rate(
            'CAST(coalesce(sum(doses), 0) - sum(antes) AS DOUBLE) / nullif(sum(antes), 0)'
        )} AS variacao_mom FROM ({_SERIES_BEFORE}) s GROUP BY ano""",
    ),
    "d11_ano": _with(
        ["serie"],
        "SELECT ano, CAST(sum(doses) AS BIGINT) AS doses_ytd FROM serie GROUP BY ano",
    ),
    "d11_total": _with(
        ["serie"],
        """SELECT CAST(sum(doses) AS BIGINT) AS doses_ytd FROM serie
           WHERE ano = (SELECT max(ano) FROM serie)""",
    ),
    "d15_uf_ano": _with(
        ["fato", "dim_tempo", "dim_municipio"],
        """SELECT g.chave_municipio, g.uf, g.ano, rank() OVER (PARTITION BY g.uf, g.ano
               ORDER BY coalesce(d.doses / nullif(g.populacao, 0), 0)) AS ranking
           FROM (SELECT m.chave_municipio, m.uf, m.populacao, a.ano
                 FROM dim_municipio m, (SELECT DISTINCT ano FROM dim_tempo) a
                 UNION
                 SELECT m.chave_municipio, m.uf, m.populacao, t.ano FROM fato f
                 LEFT JOIN dim_tempo t ON t.mes = f.mes_vacina
                 LEFT JOIN dim_municipio m ON m.chave_municipio = f.chave_municipio) g
           LEFT JOIN (SELECT f.chave_municipio, t.ano, CAST(sum(qtd_doses) AS DOUBLE) AS doses
                      FROM fato f LEFT JOIN dim_tempo t ON t.mes = f.mes_vacina GROUP BY 1, 2) d
             ON d.chave_municipio = g.chave_municipio AND d.ano IS NOT DISTINCT FROM g.ano""",
    ),
    "d16_region_mes": _with(
        ["fato_local", "dim_tempo", "dim_municipio", "meta"],
        f"""SELECT g.nome_regiao, {_text('g.mes')} AS mes, {_rate(
            "CAST(nullif(count(DISTINCT CASE WHEN coalesce(d.doses / nullif(m.populacao, 0), 0) < meta"
            " THEN m.chave_municipio END), 0) AS DOUBLE)"
            f" / nullif(count(DISTINCT CASE WHEN m.tipo_registro IN {_REAL} THEN m.chave_municipio END), 0)"
        )} AS pct_abaixo_meta
            FROM (SELECT r.nome_regiao, t.mes
                  FROM (SELECT DISTINCT nome_regiao FROM dim_municipio) r, dim_tempo t
                  UNION SELECT nome_regiao, mes_vacina FROM fato_local) g
            JOIN dim_municipio m ON m.nome_regiao IS NOT DISTINCT FROM g.nome_regiao
            LEFT JOIN (SELECT chave_municipio, mes_vacina, CAST(sum(qtd_doses) AS DOUBLE) AS doses
                       FROM fato GROUP BY 1, 2) d
              ON d.chave_municipio = m.chave_municipio AND d.mes_vacina IS NOT DISTINCT FROM g.mes,
              meta
            GROUP BY 1, 2""",
    ),
    "d17_uf": _with(
        ["fato_local"],
        f"""SELECT uf, {_rate(
            "CAST(sum(CASE WHEN coalesce(tipo_registro, '') <> 'Município válido' THEN qtd_doses END) AS DOUBLE)"
            " / sum(qtd_doses)"
        )} AS pct_nao_municipio_valido FROM fato_local GROUP BY uf""",
    ),
    "d18": _share("chave_faixa_etaria", "pct_faixa_etaria"),
    "d19": _share("chave_estrategia", "pct_estrategia"),
    "d20": _share("chave_perfil", "pct_perfil"),
}


# --- quality ---------------------------------------------------------------------------------

_STEP_OF = {
    checks.DOSES: "silver",
    checks.MUNICIPALITIES: "municipios",
    checks.FACT: "fato",
    "dim_perfil_paciente": "dim_perfil",
    "dim_estrategia_vacinacao": "dim_estrategia",
}


def _step(table: str) -> str:
    return _STEP_OF.get(table, table)


def _failures(c: checks.Check) -> str:
    source = f"(SELECT * FROM {_step(c.table)} WHERE {c.where or 'true'}) t"
    if c.kind == checks.UNIQUE:
        return (
            f"SELECT count(*) FROM (SELECT {c.column} FROM {source} WHERE {c.column} IS NOT NULL"
            f" GROUP BY {c.column} HAVING count(*) > 1) x"
        )
    if c.kind == checks.NOT_NULL:
        return f"SELECT count(*) FROM {source} WHERE {c.column} IS NULL"
    if c.kind == checks.ACCEPTED:
        accepted = ", ".join(_literal(v) for v in c.values)
        return f"SELECT count(DISTINCT {c.column}) FROM {source} WHERE {c.column} NOT IN ({accepted})"
    return (
        f"SELECT count(*) FROM {source} WHERE {c.column} IS NOT NULL AND NOT EXISTS"
        f" (SELECT 1 FROM {_step(c.parent)} p WHERE p.{c.parent_key} = t.{c.column})"
    )


def _checks(kind: str) -> str:
    chosen = checks.checks_by_kind(kind)
    needs = [_step(t) for c in chosen for t in (c.table, c.parent) if t]
    rows = " UNION ALL ".join(
        f"SELECT '{c.table}' AS \"table\", '{c.column}' AS \"column\", '{c.kind}' AS \"check\","
        f" '{c.severity}' AS severity, ({_failures(c)}) AS failures"
        for c in chosen
    )
    return _with(needs, f"SELECT *, failures = 0 AS passed FROM ({rows}) r")


def _skipped() -> str:
    """`q7_skipped`: the municipalities checked with one state's towns repeated, the rest as it is."""
    needs = pipeline.dependencies(None)
    pairs = [(m, p) for m, parents in needs.items() for p in (parents or (None,))]
    checked = _checks(checks.UNIQUE)
    return f"""WITH RECURSIVE
      verificado AS ({checked}),
      municipios AS ({_with(["municipios"], "SELECT * FROM municipios")}),
      failed AS (
        SELECT "table" AS tabela FROM verificado WHERE NOT passed AND severity = '{ERROR}'
        UNION
        SELECT '{checks.MUNICIPALITIES}' FROM (
          SELECT id_municipio FROM (
            SELECT id_municipio FROM municipios
            UNION ALL SELECT id_municipio FROM municipios WHERE sigla_uf = 'SP') t
          GROUP BY id_municipio HAVING count(*) > 1) d),
      edges AS ({_values(pairs, "modelo, depende_de")}),
      below(origem, modelo) AS (
        SELECT tabela, tabela FROM failed
        UNION SELECT b.origem, e.modelo FROM below b JOIN edges e ON e.depende_de = b.modelo),
      reasons AS (
        SELECT modelo, string_agg(DISTINCT origem, ', ' ORDER BY origem) AS motivo
        FROM below WHERE origem <> modelo GROUP BY modelo)
    SELECT m.modelo, CASE WHEN motivo IS NOT NULL THEN 'pulado' WHEN m.modelo IN (SELECT tabela FROM failed)
             THEN 'falhou' ELSE 'construido' END AS situacao, motivo
    FROM (SELECT DISTINCT modelo FROM edges) m LEFT JOIN reasons r ON r.modelo = m.modelo"""


# --- profiles -----------------------------------------------------------------------------------


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _cast_profile(column: str, kind: str) -> str:
    return (
        f"SELECT '{column}' AS coluna, count({column}) AS preenchidos,"
        f" count(CASE WHEN {column} IS NOT NULL AND TRY_CAST({column} AS {kind}) IS NULL"
        f" THEN 1 END) AS invalidos FROM bronze"
    )


def _dependency(code: str, name: str) -> str:
    return (
        f"SELECT '{code}' AS codigo, count(*) AS valores,"
        f" count(CASE WHEN nomes > 1 THEN 1 END) AS com_varios_nomes"
        f" FROM (SELECT {code}, count(DISTINCT {name}) AS nomes FROM bronze"
        f" WHERE {code} IS NOT NULL GROUP BY {code}) x"
    )


_DROP = "'vacinacao_' || abrev || '_' || ano || '.csv'"
_DROP_FORMAT = """CASE WHEN mes_num % 2 = 1 THEN 'ISO-8859-1' ELSE 'utf-8-sig' END AS encoding,
                  CASE WHEN mes_num % 2 = 1 THEN ';' ELSE ',' END AS delimitador,
                  {columns} AS colunas"""
_SHIFTED = derived.shifted_month_sql()

_COLUMNS = len(BRONZE_COLUMNS)
_LAST = BRONZE_COLUMNS[-1]
_FIELD = "CASE WHEN {0} IS NULL THEN 0 WHEN {0} = '' THEN 2 ELSE length({0}) END"
_ROW_BYTES = " + ".join(_FIELD.format(c) for c in BRONZE_COLUMNS) + f" + {_COLUMNS}"
_UNEVEN = f"(({derived.SHORT_SQL}) OR ({derived.LONG_SQL}))"

# Every row of every load of `registry.Lake.reloads`, with the lines and bytes it takes up.
_STEPS["entregas"] = (
    ("bronze", "nomes_arquivo"),
    f"""SELECT e.*, {_SHIFTED.replace('mes_referencia', 'e.mes_referencia')} AS mes,
          'vacinacao_' || n.abrev || '_' || n.ano || '.csv' AS remessa,
          CASE WHEN n.mes_num % 2 = 1 THEN 'ISO-8859-1' ELSE 'utf-8-sig' END AS encoding,
          CASE WHEN n.mes_num % 2 = 1 THEN ';' ELSE ',' END AS delimitador,
          versao = 2 AND e.mes_referencia IN ('{BROKEN_MONTH}', '{UNEVEN_MONTH}') AS falha,
          CASE WHEN versao = 2 AND e.mes_referencia = '{BROKEN_MONTH}'
               THEN length(ds_nome) - length(replace(ds_nome, ' ', '')) ELSE 0 END AS quebras,
          versao = 2 AND e.mes_referencia = '{UNEVEN_MONTH}' AND {_UNEVEN} AS desigual
        FROM (
          SELECT 1 AS versao, * FROM bronze
          UNION ALL SELECT 2, * FROM bronze
            WHERE mes_referencia LIKE '{RELOADED_YEAR}-%' AND dt_deletado_rnds IS NULL
          UNION ALL SELECT 3, * FROM bronze
            WHERE mes_referencia IN ('{BROKEN_MONTH}', '{UNEVEN_MONTH}') AND dt_deletado_rnds IS NULL
        ) e JOIN nomes_arquivo n ON n.mes_referencia = e.mes_referencia""",
)
_LINES = "CAST(count(*) + sum(coalesce(quebras, 0)) AS BIGINT)"
_LOADED = "CAST(count(*) - sum(CAST(desigual AS INTEGER)) AS BIGINT)"


_OTHERS = {
    "s1_csv_load": _with(
        ["bronze"], f"SELECT {_RAW}, {_SHIFTED} AS mes_referencia FROM bronze"
    ),
    "s1_quoted_newlines": _with(
        ["bronze"],
        f"""SELECT {_RAW}, {_SHIFTED} AS mes_referencia
            FROM (SELECT * REPLACE (replace(ds_nome, ' ', chr(10) || '"') AS ds_nome) FROM bronze) b""",
    ),
    "s1_quarantine": _with(
        ["entregas"],
        f"""SELECT mes AS mes_referencia, motivo, campos, CAST({_COLUMNS} AS BIGINT) AS colunas, count(*) AS linhas
            FROM (SELECT mes, CASE WHEN {derived.SHORT_SQL} THEN 'colunas a menos' ELSE 'colunas a mais' END AS motivo,
                    CAST(CASE WHEN {derived.SHORT_SQL} THEN {_COLUMNS - 1} ELSE {_COLUMNS + 1} END AS BIGINT) AS campos
                  FROM entregas WHERE desigual) d
            GROUP BY ALL""",
    ),
    "s2_manifest": _with(
        ["entregas"],
        f"""SELECT CAST(versao AS BIGINT) AS versao, remessa, mes AS mes_referencia, encoding, delimitador,
              CAST({_COLUMNS} AS INTEGER) AS colunas, {_LINES} AS linhas_no_csv,
              CAST(max(coalesce(quebras, 0)) > 0 AS INTEGER) AS quebra_em_aspas
            FROM entregas GROUP BY ALL""",
    ),
    "s3_sniff": _with(
        ["nomes_arquivo"],
        f"""SELECT {_DROP} AS remessa, ano || '-' || mm AS mes_referencia,
              {_DROP_FORMAT.format(columns=f'CAST({len(BRONZE_COLUMNS)} AS INTEGER)')},
              linhas AS linhas_no_csv, 0 AS quebra_em_aspas FROM nomes_arquivo""",
    ),
    "s5_month_from_name": _with(
        ["nomes_arquivo"],
        """SELECT arquivo, CASE WHEN arquivo NOT LIKE '%20__%' THEN NULL ELSE mes END AS mes,
             CAST(sum(linhas) AS BIGINT) AS linhas
           FROM (SELECT unnest(['pni_' || ano || '_' || mm || '.csv', 'PNI' || ano || mm || '.CSV',
                                'doses.' || mm || '-' || ano || '.csv',
                                'Vacinacao_' || abrev || '_' || ano || '.csv', ano || abrev || '.csv',
                                'vacinacao_' || substr(ano, 3, 2) || '.csv']) AS arquivo,
                        CASE WHEN unnest([1, 2, 3, 4, 5, 6]) = 6 THEN NULL ELSE ano || '-' || mm END AS mes,
                        linhas FROM nomes_arquivo) x
           GROUP BY 1, 2""",
    ),
    "s7_hash": _with(
        ["bronze", "nomes_arquivo"],
        f"""SELECT remessa, CAST(strlen(conteudo) AS BIGINT) AS bytes, sha256(conteudo) AS arquivo_sha256
            FROM (SELECT {_DROP} AS remessa, 'co_documento;dt_vacina' || chr(10)
                    || string_agg(co_documento || ';' || dt_vacina || chr(10), '' ORDER BY co_documento, dt_vacina)
                    AS conteudo
                  FROM bronze JOIN nomes_arquivo USING (mes_referencia) GROUP BY ALL) c""",
    ),
    "k6_view": _with(
        ["silver"],
        "SELECT uf_cobertura, sexo_cobertura, count(*) AS doses FROM silver GROUP BY ALL",
    ),
    "k8_publication": _with(
        ["fato"],
        f"""SELECT count(*) AS linhas, CAST({len(RELATIONS) + sum(len(r.attributes) for r in RELATIONS) + 1}
              AS BIGINT) AS colunas, CAST(1 AS INTEGER) AS publicado FROM fato""",
    ),
    "q9_altered_fact": _with(
        ["fato"],
        f"""SELECT count(*) AS diferencas FROM fato
            WHERE chave_faixa_etaria = 1 OR mes_vacina >= DATE '{D08_MONTH}'""",
    ),
    "q9_digest": _with(
        ["fato"],
        f"""SELECT count(*) AS diferencas FROM fato
            WHERE chave_faixa_etaria = 1 OR mes_vacina >= DATE '{D08_MONTH}'""",
    ),
    "q7_skipped": _skipped(),
    "a8_sketch": _with(
        ["silver"],
        _union(
            [
                f"SELECT '{c}' AS coluna, uf_cobertura AS uf, count(DISTINCT {c}) AS distintos,"
                f" CAST(1 AS INTEGER) AS proximo FROM silver GROUP BY uf_cobertura HAVING count({c}) > 0"
                for c in ("codigo_documento", "municipio_cobertura")
            ]
        ),
    ),
    "a17_top_values": _with(
        ["bronze"],
        _union(
            [
                f"SELECT '{c}' AS coluna, {c} AS valor, count(*) AS linhas FROM bronze WHERE {c} IS NOT NULL"
                f" GROUP BY {c} HAVING count(*) * 100 >= (SELECT count(*) FROM bronze)"
                for c in BRONZE_COLUMNS
            ]
        ),
    ),
    "j6_seconds_bands": _with(
        ["silver"],
        f"""SELECT b.ordem AS faixa, count(*) AS linhas, count(entrada) AS com_entrada
            FROM (SELECT CAST(epoch(data_entrada_rnds) AS BIGINT) AS entrada FROM silver) s
            LEFT JOIN ({SECONDS_BANDS_SQL.format(numbers='CAST(co_vacina AS INT) % 40', source='silver')}) b
              ON entrada BETWEEN b.inicio AND b.fim GROUP BY 1""",
    ),
    "w1_incremental": _with(
        ["bronze"],
        f"""SELECT co_documento, {', '.join(c for c in BRONZE_COLUMNS if c not in ('co_documento', 'dt_deletado_rnds'))}
            FROM (
              SELECT *, row_number() OVER (PARTITION BY co_documento
                ORDER BY TRY_CAST(dt_entrada_rnds AS TIMESTAMP) DESC NULLS LAST, {_TIES}) AS posicao
              FROM (SELECT * REPLACE (string_split(co_documento, '-')[1] AS co_documento) FROM bronze
                    WHERE dt_deletado_rnds IS NULL
                      AND NOT (mes_referencia LIKE '{RELOADED_YEAR}-%' AND co_dose_vacina = '1')) b
            ) x WHERE posicao = 1""",
    ),
    "s9_seed_bands": _with(
        ["faixa_etaria", "chaves"],
        """SELECT f.ordem, f.idade_min, f.idade_max, f.nome_faixa_etaria, d.doses
           FROM faixa_etaria f
           LEFT JOIN (SELECT chave_faixa_etaria, count(*) AS doses FROM chaves GROUP BY 1) d
             ON d.chave_faixa_etaria = f.ordem""",
    ),
    "s9_seed_uf": _with(
        ["uf_ibge", "silver"],
        """SELECT u.co_uf, u.sg_uf, u.nome_uf, d.doses FROM uf_ibge u
           LEFT JOIN (SELECT uf_cobertura, count(*) AS doses FROM silver GROUP BY 1) d
             ON d.uf_cobertura = u.sg_uf""",
    ),
    "k1_partition_replace": _with(
        ["bronze"],
        f"""SELECT {_SHIFTED} AS mes_referencia, count(*) AS linhas,
              count(dt_deletado_rnds) AS excluidas
            FROM bronze WHERE substr(mes_referencia, 1, 4) <> '1998' OR dt_deletado_rnds IS NULL
            GROUP BY mes_referencia""",
    ),
    "k1_commit": _with(
        ["bronze", "entregas"],
        f"""SELECT h.*, l.linhas_recebidas, l.reconciliado
            FROM (SELECT {_SHIFTED} AS mes_referencia, count(*) AS linhas, count(dt_deletado_rnds) AS excluidas
                  FROM bronze
                  WHERE mes_referencia NOT LIKE '{RELOADED_YEAR}-%' OR dt_deletado_rnds IS NULL
                     OR mes_referencia IN ('{BROKEN_MONTH}', '{UNEVEN_MONTH}')
                  GROUP BY mes_referencia) h
            LEFT JOIN (SELECT mes, {_LOADED} AS linhas_recebidas, min(CASE WHEN falha THEN 0 ELSE 1 END) AS reconciliado
                       FROM entregas WHERE versao = 2 GROUP BY mes) l ON l.mes = h.mes_referencia""",
    ),
    "k2_load_log": _with(
        ["entregas"],
        f"""SELECT CAST(versao AS BIGINT) AS versao, mes || '-01' AS mes_referencia, remessa, encoding, delimitador,
              CAST({_COLUMNS} AS BIGINT) AS colunas, {_LINES} AS linhas_no_csv, {_LOADED} AS linhas_carregadas,
              CAST(min(CASE WHEN falha THEN 0 ELSE 1 END) AS INTEGER) AS reconciliado,
              CAST(sum({_ROW_BYTES} + CASE WHEN quebras > 0 THEN 2 ELSE 0 END
                + CASE WHEN NOT desigual THEN 0 WHEN {derived.SHORT_SQL} THEN -1 - ({_FIELD.format(_LAST)}) ELSE 2 END)
                AS BIGINT) AS bytes_das_linhas,
              CAST(0 AS BIGINT) AS resumos_repetidos
            FROM entregas GROUP BY versao, mes, remessa, encoding, delimitador""",
    ),
    "k3_reconcile": _with(
        ["bronze", "entregas"],
        f"""SELECT remessa, CAST(sum(linhas) AS BIGINT) AS linhas_no_csv,
              CAST(sum(gravadas) AS BIGINT) AS linhas_carregadas,
              CAST(min(CASE WHEN falha THEN 0 ELSE 1 END) AS INTEGER) AS reconciliado
            FROM (SELECT remessa, falha, count(*) + sum(coalesce(quebras, 0)) AS linhas,
                    count(CASE WHEN NOT falha THEN 1 END) AS gravadas
                  FROM entregas WHERE versao = 2 GROUP BY remessa, falha
                  UNION ALL
                  SELECT remessa, true, 0, count(*) FROM entregas
                  WHERE versao = 1 AND mes_referencia IN ('{BROKEN_MONTH}', '{UNEVEN_MONTH}') GROUP BY remessa) x
            GROUP BY remessa""",
    ),
    "k5_schema_drift": _with(
        ["nomes_arquivo"],
        """SELECT coluna, situacao, count(*) AS remessas FROM nomes_arquivo,
             (VALUES ('no_estrategia', 'falta na tabela'), ('st_documento', 'falta no csv'))
               AS v(coluna, situacao)
           GROUP BY ALL""",
    ),
    "p2_safe_cast_profile": _with(
        ["bronze"],
        _union(
            [
                _cast_profile("dt_vacina", "DATE"),
                _cast_profile("dt_entrada_rnds", "TIMESTAMP"),
                _cast_profile("nu_idade_paciente", "BIGINT"),
            ]
        ),
    ),
    "p4_geography_resolution": _with(
        ["bronze_local"],
        """SELECT origem_local, municipio_cobertura, uf_direta, count(*) AS linhas
           FROM bronze_local GROUP BY ALL""",
    ),
    "p6_uf_fallback": _with(
        ["bronze_local"],
        """SELECT origem_local, uf_direta, uf_derivada, uf_cobertura, count(*) AS linhas
           FROM bronze_local GROUP BY ALL""",
    ),
    "p8_sex_clamp": _with(
        ["bronze"],
        """SELECT tp_sexo_paciente,
             CASE WHEN tp_sexo_paciente IN ('F', 'M') THEN tp_sexo_paciente
                  ELSE 'SEM INFORMACAO' END AS sexo_cobertura, count(*) AS linhas
           FROM bronze GROUP BY ALL""",
    ),
    "w1_latest_document": _with(["vivos"], f"SELECT {_RAW} FROM vivos"),
    "w2_latest_population": _with(
        ["populacao_recente"],
        "SELECT id_municipio, ano, populacao FROM populacao_recente",
    ),
    "m1_silver": _with(
        ["silver"],
        f"""SELECT * EXCLUDE (origem_local) REPLACE ({_text('data_vacina')} AS data_vacina,
              {_text('data_entrada_rnds')} AS data_entrada_rnds) FROM silver""",
    ),
    "m2_municipalities": _with(["municipios"], "SELECT * FROM municipios"),
    "m3_dim_municipality": _with(["dim_municipio"], "SELECT * FROM dim_municipio"),
    "m4_dim_vaccine": _with(["dim_vacina"], "SELECT * FROM dim_vacina"),
    "m4_dim_profile": _with(["dim_perfil"], "SELECT * FROM dim_perfil"),
    "m4_dim_strategy": _with(["dim_estrategia"], "SELECT * FROM dim_estrategia"),
    "m5_calendar": _with(
        ["dim_tempo", "fato"],
        f"""SELECT t.* REPLACE ({_text('t.mes')} AS mes), CAST(d.doses AS BIGINT) AS doses
            FROM dim_tempo t
            LEFT JOIN (SELECT mes_vacina, sum(qtd_doses) AS doses FROM fato GROUP BY 1) d
              ON d.mes_vacina = t.mes""",
    ),
    "j6_age_band_counts": _with(
        ["silver", "faixa_etaria"],
        """SELECT s.idade_paciente, f.ordem AS faixa, count(*) AS linhas
           FROM silver s LEFT JOIN faixa_etaria f
             ON s.idade_paciente BETWEEN f.idade_min AND f.idade_max GROUP BY ALL""",
    ),
    "m6_fact": _with(
        ["fato"], f"SELECT * REPLACE ({_text('mes_vacina')} AS mes_vacina) FROM fato"
    ),
    "m7_mart": _mart("fato", list(_TABLE_OF)),
    "m8_mart_summary": _mart("resumo", ["tempo", "municipio", "vacina", "faixa"]),
    "q9_layer_reconciliation": _with(
        ["bronze", "silver", "fato", "resumo"],
        """SELECT 'bronze' AS camada, count(DISTINCT co_documento)
                  + CAST(max(CASE WHEN co_documento IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS doses
           FROM bronze WHERE dt_deletado_rnds IS NULL
           UNION ALL SELECT 'silver', count(*) FROM silver
           UNION ALL SELECT 'fato', CAST(sum(qtd_doses) AS BIGINT) FROM fato
           UNION ALL SELECT 'resumo', CAST(sum(qtd_doses) AS BIGINT) FROM resumo""",
    ),
    "q9_unreconciled_keys": _with(
        ["fato", "silver"],
        """SELECT (SELECT count(*) FROM silver)
                  - (SELECT CAST(sum(qtd_doses) AS BIGINT) FROM fato) AS diferencas""",
    ),
    "q10_missing_information": _with(
        ["silver"],
        """SELECT origem_local, count(*) AS doses,
             count(CASE WHEN uf_cobertura = '' THEN 1 END) AS uf_vazia,
             count(CASE WHEN municipio_cobertura IS NULL THEN 1 END) AS sem_municipio
           FROM silver GROUP BY origem_local""",
    ),
    "a16_functional_dependency": _with(
        ["bronze"],
        _union(
            [
                _dependency("co_vacina", "ds_nome"),
                _dependency("co_dose_vacina", "ds_tipo_dose"),
                _dependency("co_estrategia_vacinacao", "no_estrategia"),
                _dependency("co_raca_cor_paciente", "no_raca_cor_paciente"),
                _dependency("co_documento", "dt_vacina"),
            ]
        ),
    ),
    "a17_profile": _with(
        ["bronze"],
        _union(
            [
                f"SELECT '{c}' AS coluna, count(*) AS linhas, count(*) - count({c}) AS nulos,"
                f" count(CASE WHEN {c} = '' THEN 1 END) AS vazios FROM bronze"
                for c in BRONZE_COLUMNS
            ]
        ),
    ),
    "a17_value_frequency": _with(
        ["bronze"],
        _union(
            [
                f"SELECT '{c}' AS coluna, {c} AS valor, count(*) AS linhas FROM bronze GROUP BY {c}"
                for c in ("tp_sexo_paciente", "co_raca_cor_paciente", "co_pais_paciente")
            ]
        ),
    ),
    "a18_unmatched_keys": _with(
        ["dim_municipio", "municipios"],
        """SELECT padrao, count(*) AS membros, count(DISTINCT uf) AS ufs
           FROM (SELECT uf, CASE
                   WHEN codigo_ibge IS NOT NULL AND starts_with(codigo_ibge, '53') THEN 'regiao do DF'
                   WHEN codigo_ibge IS NOT NULL AND codigo_ibge LIKE '%0000' THEN 'UF + 0000'
                   WHEN codigo_ibge IS NOT NULL THEN 'residual'
                   WHEN uf IN ('SEM INFORMACAO', 'ESTRANGEIRO') THEN 'membro especial'
                   ELSE 'UF sem codigo' END AS padrao
                 FROM dim_municipio d
                 WHERE NOT EXISTS (SELECT 1 FROM municipios m
                                   WHERE m.nome_municipio IS NOT NULL
                                     AND m.id_municipio_6d = d.codigo_ibge)) x
           GROUP BY padrao""",
    ),
    "a19_source_lag": _with(
        ["silver"],
        f"""SELECT {_text("CAST(date_trunc('month', data_vacina) AS DATE)")} AS mes, count(*) AS doses,
              {_rate('CAST(sum(epoch(data_entrada_rnds) - epoch(CAST(data_vacina AS TIMESTAMP))) AS DOUBLE)'
                     ' / count(*) / 86400')} AS dias_medio,
              CAST(quantile_disc(date_diff('day', data_vacina, CAST(data_entrada_rnds AS DATE)), 0.5) AS BIGINT)
                AS dias_mediana,
              CAST(max(date_diff('day', data_vacina, CAST(data_entrada_rnds AS DATE))) AS BIGINT)
                AS dias_maximo
            FROM silver WHERE data_entrada_rnds IS NOT NULL AND data_vacina IS NOT NULL
            GROUP BY date_trunc('month', data_vacina)""",
    ),
}

_QUALITY = {
    "q1_unique": checks.UNIQUE,
    "q2_not_null": checks.NOT_NULL,
    "q3_accepted_values": checks.ACCEPTED,
    "q4_relationships": checks.RELATED,
}


def _as_doubles(sql: str, columns: tuple[str, ...]) -> str:
    if not columns:
        return sql
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)
    return f"SELECT * REPLACE ({casts}) FROM (\n{sql}\n) q"


def statements() -> dict[str, str]:
    plain = {
        **_OTHERS,
        **_MEASURES,
        **{name: _checks(kind) for name, kind in _QUALITY.items()},
    }
    return {name: _as_doubles(sql, WHOLE_OR_NULL.get(name, ())) for name, sql in plain.items()}
