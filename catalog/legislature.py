"""The legislative marts over the driver's tables.

Customers stand in for members, part brands for caucuses, orders for
events, line items for attendance, expenses and votes, suppliers for
committees of inquiry. Each stand-in has the columns of the landed record
it replaces. The oracles say the same in SQL, step by step.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import functions as F

from catalog.registry import exact_mean, half_up, query, table
from martloom.operators import Dim, star_join
from martloom.plans.legislative import gold as G
from martloom.plans.legislative import silver as L
from martloom.operators.calendar import Period
from martloom.session import checkpointed

AS_OF = dt.date(2001, 10, 15)


def _ingested():
    return F.lit(dt.datetime(2024, 3, 15, 12, 0)).cast("timestamp").alias("ingested_at")


# --- stand-ins for the landed records ------------------------------------------

def deputados(spark, d):
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"),
        F.concat(F.lit("/deputados/"), "c_custkey").alias("uri"),
        F.col("c_name").alias("nome"),
        F.col("c_mktsegment").alias("siglaPartido"),
        F.concat(F.lit("/partidos/"), "c_nationkey").alias("uriPartido"),
        F.concat(F.lit("UF"), "c_nationkey").alias("siglaUf"),
        F.lit(57).alias("idLegislatura"),
        F.lit(None).cast("string").alias("urlFoto"),
        F.lit(None).cast("string").alias("email"),
        _ingested(),
    )


def frentes(spark, d):
    number = F.regexp_extract("p_brand", r"(\d+)", 1).cast("bigint")
    return table(spark, d, "part").select(
        number.alias("id"),
        F.lit(57).alias("idLegislatura"),
        F.col("p_brand").alias("titulo"),
        F.concat(F.lit("/frentes/"), number).alias("uri"),
        _ingested(),
    )


def _lines(spark, d, *columns):
    orders = table(spark, d, "orders")
    lines = table(spark, d, "lineitem").select("l_orderkey", *columns)
    return star_join(lines, Dim(orders, [("l_orderkey", "o_orderkey")], ["o_custkey"]))


def frentes_membros(spark, d):
    part = Dim(table(spark, d, "part"), [("l_partkey", "p_partkey")], ["p_brand"])
    return star_join(_lines(spark, d, "l_partkey"), part).select(
        F.regexp_extract("p_brand", r"(\d+)", 1).cast("bigint").alias("id_frente"),
        F.col("o_custkey").alias("id"),
        F.concat(F.lit("landed "), "o_custkey").alias("nome"),
        F.lit("XX").alias("siglaPartido"),
        F.lit("YY").alias("siglaUf"),
        F.lit(57).alias("idLegislatura"),
        _ingested(),
    )


def eventos(spark, d):
    kind = F.substring("o_orderpriority", 1, 1)
    main = (F.year("o_orderdate") * 10 + kind.cast("int")).alias("id")
    both = F.array(
        F.struct(main, F.concat(F.lit("C"), kind).alias("sigla"), F.lit("main").alias("nome")),
        F.struct(
            F.when(F.col("o_orderstatus") != "P", F.month("o_orderdate")).alias("id"),
            F.lit("M").alias("sigla"),
            F.lit("monthly").alias("nome"),
        ),
    )
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("/eventos/"), "o_orderkey").alias("uri"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm").alias("dataHoraInicio"),
        F.lit("").alias("dataHoraFim"),
        F.col("o_orderstatus").alias("situacao"),
        F.concat(F.lit(" "), F.lower("o_orderpriority")).alias("descricaoTipo"),
        F.concat(F.lit("event "), "o_orderkey").alias("descricao"),
        F.lit(None).cast("string").alias("localExterno"),
        F.to_json(F.struct(F.concat(F.lit("Hall "), kind).alias("nome"))).alias("localCamara"),
        F.lit(None).cast("string").alias("urlRegistro"),
        F.to_json(both).alias("orgaos"),
        F.lit("{}").alias("raw_payload"),
        _ingested(),
    )


def tipo_evento(spark, d):
    code = F.substring("o_orderpriority", 1, 1)
    return table(spark, d, "orders").select(
        code.alias("cod"),
        F.lit(None).cast("string").alias("sigla"),
        F.col("o_orderpriority").alias("nome"),
        F.when(code != "3", F.concat(F.lit("Tipo "), "o_orderpriority")).alias("descricao"),
        _ingested(),
    )


def presenca(spark, d):
    return table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("id"), F.col("l_orderkey").alias("id_evento")
    )


def despesas_landed(spark, d):
    lines = _lines(
        spark, d, "l_partkey", "l_suppkey", "l_linenumber", "l_linestatus", "l_extendedprice", "l_shipdate"
    )
    wide = star_join(
        lines,
        Dim(table(spark, d, "part"), [("l_partkey", "p_partkey")], ["p_type"]),
        Dim(table(spark, d, "supplier"), [("l_suppkey", "s_suppkey")], ["s_name", "s_nationkey"]),
    )
    tax_id = (
        F.when(F.col("s_nationkey") < 5, F.lit(""))
        .when(F.col("s_nationkey") < 15, F.concat(F.lpad(F.col("l_suppkey").cast("string"), 12, "0"), F.lit("/-99")))
        .otherwise(F.lpad(F.col("l_suppkey").cast("string"), 11, "0"))
    )
    return wide.select(
        F.col("o_custkey").alias("nk_deputado"),
        F.year("l_shipdate").alias("ano"),
        F.month("l_shipdate").alias("mes"),
        F.col("p_type").alias("tipoDespesa"),
        F.col("l_orderkey").alias("codDocumento"),
        F.col("l_linestatus").alias("tipoDocumento"),
        F.lit(1).alias("codTipoDocumento"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("dataDocumento"),
        F.col("l_linenumber").cast("string").alias("numDocumento"),
        F.col("l_extendedprice").alias("valorDocumento"),
        F.col("l_extendedprice").alias("valorLiquido"),
        F.lit(0.0).alias("valorGlosa"),
        F.lit(None).cast("string").alias("urlDocumento"),
        F.col("s_name").alias("nomeFornecedor"),
        tax_id.alias("cnpjCpfFornecedor"),
        F.col("l_partkey").alias("codLote"),
        F.col("l_linenumber").alias("parcela"),
        _ingested(),
    )


def orgaos(spark, d):
    nation = Dim(table(spark, d, "nation"), [("s_nationkey", "n_nationkey")], ["n_name", "n_regionkey"])
    return star_join(table(spark, d, "supplier"), nation).select(
        F.col("s_suppkey").cast("string").alias("id"),
        F.concat(F.lit("S"), "s_suppkey").alias("sigla"),
        F.col("s_name").alias("nome"),
        F.col("n_name").alias("tipoOrgao"),
        F.col("n_regionkey").cast("string").alias("codTipoOrgao"),
        _ingested(),
    )


def orgaos_detalhe(spark, d):
    day = F.to_date("l_shipdate")
    spans = table(spark, d, "lineitem").groupBy("l_suppkey").agg(
        F.min(day).cast("string").alias("dataInicio"), F.max(day).cast("string").alias("dataFim")
    )
    return spans.select(
        F.col("l_suppkey").cast("string").alias("id_orgao"),
        "dataInicio",
        "dataFim",
        F.lit(None).cast("string").alias("dataInstalacao"),
        F.lit("").alias("dataFimOriginal"),
        F.concat(F.lit("/site/"), "l_suppkey").alias("urlWebsite"),
        F.concat(F.lit("/orgaos/"), "l_suppkey").alias("uri"),
        _ingested(),
    )


def votacoes(spark, d):
    month = F.date_format("l_shipdate", "yyyy-MM")
    return table(spark, d, "lineitem").select(
        month.alias("id"),
        F.concat(F.lit("/eventos/"), F.date_format("l_shipdate", "yyyyMM")).alias("uriEvento"),
        F.lit(1).alias("aprovacao"),
        F.concat(F.lit("ballot of "), month).alias("descricao"),
        F.lit("PLEN").alias("siglaOrgao"),
        _ingested(),
    )


def votos_landed(spark, d):
    kind = F.when(F.col("l_returnflag") == "A", "Sim").when(F.col("l_returnflag") == "N", "Não")
    return _lines(spark, d, "l_shipdate", "l_returnflag").select(
        F.date_format("l_shipdate", "yyyy-MM").alias("id_votacao"),
        F.struct(F.col("o_custkey").alias("id")).alias("deputado_"),
        kind.otherwise("Abstenção").alias("tipoVoto"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("dataRegistroVoto"),
        _ingested(),
    )


# --- silver, where a step that several others read is stored first ----------------

def dim_deputado(spark, d):
    return L.dim_deputado(deputados(spark, d), AS_OF)


def dim_frente(spark, d):
    return L.dim_frente(frentes(spark, d))


def bridge_frente_deputado(spark, d):
    return L.bridge_frente_deputado(
        frentes_membros(spark, d), dim_frente(spark, d), dim_deputado(spark, d)
    )


def dim_tipo_evento(spark, d):
    return L.dim_tipo_evento(tipo_evento(spark, d))


def dim_evento(spark, d):
    return L.dim_evento(eventos(spark, d), dim_tipo_evento(spark, d))


def stored_events(spark, d):
    """Events, committees and their bridge."""
    events = checkpointed(dim_evento(spark, d))
    committees = L.dim_orgao(events)
    return events, committees, L.bridge_evento_orgao(events, committees)


PERIODS = [Period(dt.date(1998, 8, 1), dt.date(1998, 10, 31), "Período eleitoral 1998")]


def dim_data(spark, d):
    """The calendar over the days of the stand-in events."""
    return L.dim_data(table(spark, d, "orders"), "o_orderdate", PERIODS)


def despesas(spark, d):
    return L.despesas(despesas_landed(spark, d))



def dim_cpi(spark, d):
    return L.dim_cpi(orgaos(spark, d), orgaos_detalhe(spark, d), AS_OF)


def votos(spark, d):
    return L.dim_votos_votacoes(votos_landed(spark, d), votacoes(spark, d))


def fat_despesas(spark, d):
    spent = checkpointed(despesas(spark, d))
    return G.fat_despesas(
        spent, dim_deputado(spark, d), L.dim_fornecedor(spent), L.dim_categoria_despesa(spent)
    )


def roster(spark, d):
    return G.frentes_membros(
        bridge_frente_deputado(spark, d), dim_frente(spark, d), dim_deputado(spark, d)
    )


def gold_eventos(spark, d):
    events, committees, bridge = stored_events(spark, d)
    return G.eventos(events, bridge, committees, dim_tipo_evento(spark, d), dim_data(spark, d))


def frentes_votacoes(spark, d):
    seats = checkpointed(bridge_frente_deputado(spark, d))
    return G.frentes_votacoes(seats, dim_frente(spark, d), checkpointed(votos(spark, d)))


def engajamento(spark, d):
    return G.engajamento_deputado(dim_deputado(spark, d), presenca(spark, d), votos(spark, d))


# --- the same in SQL -------------------------------------------------------------

STEPS = {
    "dim_deputado": """
        SELECT row_number() OVER (ORDER BY c_custkey) AS sk_deputado, c_custkey AS nk_deputado,
               '/deputados/' || c_custkey AS uri_deputado, c_name AS nome_deputado,
               c_mktsegment AS sigla_partido, CAST(c_nationkey AS BIGINT) AS id_partido,
               'UF' || c_nationkey AS sigla_uf, CAST(57 AS INTEGER) AS id_legislatura,
               NULL::VARCHAR AS url_foto, NULL::VARCHAR AS email, DATE '2001-10-15' AS valid_from,
               NULL::DATE AS valid_to, true AS is_current
        FROM customer""",
    "dim_frente": """
        SELECT row_number() OVER (ORDER BY nk_frente) AS sk_frente, nk_frente,
               CAST(57 AS INTEGER) AS id_legislatura, titulo_frente, '/frentes/' || nk_frente AS uri_frente
        FROM (SELECT DISTINCT CAST(regexp_extract(p_brand, '[0-9]+') AS BIGINT) AS nk_frente,
                     p_brand AS titulo_frente FROM part) b""",
    "bridge_frente_deputado": """
        SELECT sk_frente, sk_deputado, m.nk_frente, m.nk_deputado,
               coalesce(nome_deputado, 'landed ' || m.nk_deputado) AS nome_deputado,
               coalesce(sigla_partido, 'XX') AS sigla_partido, coalesce(sigla_uf, 'YY') AS sigla_uf,
               CAST(57 AS INTEGER) AS id_legislatura
        FROM (SELECT DISTINCT CAST(regexp_extract(p_brand, '[0-9]+') AS BIGINT) AS nk_frente,
                     o_custkey AS nk_deputado
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey) m
        LEFT JOIN dim_frente f ON f.nk_frente = m.nk_frente
        LEFT JOIN dim_deputado d ON d.nk_deputado = m.nk_deputado""",
    "dim_tipo_evento": """
        SELECT row_number() OVER (ORDER BY nome) AS sk_tipo_evento,
               CAST(substr(nome, 1, 1) AS BIGINT) AS cod_tipo_evento, NULL::VARCHAR AS sigla_tipo_evento,
               nome AS nome_tipo_evento,
               CASE WHEN nome LIKE '3%' THEN nome ELSE 'Tipo ' || nome END AS descricao_tipo_evento
        FROM (SELECT DISTINCT o_orderpriority AS nome FROM orders) p""",
    "dim_evento": """
        SELECT row_number() OVER (ORDER BY o_orderkey) AS sk_evento, o_orderkey AS nk_evento,
               '/eventos/' || o_orderkey AS uri_evento, sk_tipo_evento, cod_tipo_evento,
               o_orderdate AS data_hora_inicio, NULL::TIMESTAMP AS data_hora_fim,
               CAST(o_orderdate AS DATE) AS data_evento, CAST(year(o_orderdate) AS INTEGER) AS ano_evento,
               CAST(month(o_orderdate) AS INTEGER) AS mes_evento,
               CAST(week(o_orderdate) AS INTEGER) AS semana_evento, o_orderstatus AS situacao_evento,
               ' ' || lower(o_orderpriority) AS descricao_tipo_evento,
               'event ' || o_orderkey AS descricao_evento, NULL::VARCHAR AS local_externo,
               'Hall ' || substr(o_orderpriority, 1, 1) AS local_camara_nome,
               NULL::VARCHAR AS local_camara_predio, NULL::VARCHAR AS local_camara_sala,
               NULL::VARCHAR AS local_camara_andar, NULL::VARCHAR AS url_registro
        FROM orders LEFT JOIN dim_tipo_evento
          ON upper(trim(' ' || lower(o_orderpriority))) = upper(trim(nome_tipo_evento))""",
    "committees": """
        SELECT o_orderkey AS nk_evento,
               CAST(year(o_orderdate) * 10 + CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS BIGINT) AS nk_orgao,
               'C' || substr(o_orderpriority, 1, 1) AS sigla_orgao, 'main' AS nome_orgao FROM orders
        UNION ALL
        SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN month(o_orderdate) END, 'M', 'monthly'
        FROM orders""",
    "dim_orgao": """
        SELECT row_number() OVER (ORDER BY nk_orgao) AS sk_orgao, *, NULL::VARCHAR AS apelido_orgao,
               NULL::BIGINT AS cod_tipo_orgao, NULL::VARCHAR AS tipo_orgao,
               NULL::VARCHAR AS nome_publicacao, NULL::VARCHAR AS nome_resumido
        FROM (SELECT DISTINCT nk_orgao, sigla_orgao, nome_orgao FROM committees
              WHERE nk_orgao IS NOT NULL) c""",
    "bridge_evento_orgao": """
        SELECT DISTINCT sk_evento, sk_orgao, c.nk_evento, c.nk_orgao
        FROM committees c JOIN dim_evento e ON e.nk_evento = c.nk_evento
        LEFT JOIN dim_orgao o ON o.nk_orgao = c.nk_orgao""",
    "dim_data": """
        SELECT data, CAST(strftime(data, '%Y%m%d') AS INTEGER) AS sk_data,
               CAST(year(data) AS INTEGER) AS ano, CAST(month(data) AS INTEGER) AS mes,
               CAST(week(data) AS INTEGER) AS semana_ano,
               data BETWEEN DATE '1998-08-01' AND DATE '1998-10-31' AS periodo_eleitoral,
               CASE WHEN data BETWEEN DATE '1998-08-01' AND DATE '1998-10-31'
                    THEN 'Período eleitoral 1998' ELSE 'Fora do período eleitoral' END
                 AS descricao_periodo_eleitoral
        FROM (SELECT CAST(unnest(generate_series(date_trunc('day', min(o_orderdate)), max(o_orderdate),
                                                 INTERVAL 1 DAY)) AS DATE) AS data FROM orders) t""",
    "despesas": """
        SELECT sha256(concat_ws('|', nk_deputado, coalesce(cnpj_cpf_fornecedor, ''), data_documento,
                      CAST(valor_liquido AS DECIMAL(18,2)), cod_documento, num_documento, cod_lote))
                 AS nk_despesa, * EXCLUDE (nth),
               data_documento AS data_despesa, CAST(year(data_documento) AS INTEGER) AS ano_despesa,
               CAST(month(data_documento) AS INTEGER) AS mes_despesa,
               CAST(week(data_documento) AS INTEGER) AS semana_despesa
        FROM (SELECT *, row_number() OVER (PARTITION BY nk_deputado, cod_documento, cod_lote, parcela
                ORDER BY ano, mes, ano_mes, tipo_despesa, tipo_documento, data_documento, num_documento,
                         valor_documento, valor_liquido, nome_fornecedor, cnpj_cpf_fornecedor) AS nth
              FROM (SELECT o_custkey AS nk_deputado, CAST(year(l_shipdate) AS INTEGER) AS ano,
                           CAST(month(l_shipdate) AS INTEGER) AS mes, strftime(l_shipdate, '%Y-%m') AS ano_mes,
                           p_type AS tipo_despesa, l_orderkey AS cod_documento, l_linestatus AS tipo_documento,
                           CAST(1 AS INTEGER) AS cod_tipo_documento, CAST(l_shipdate AS DATE) AS data_documento,
                           CAST(l_linenumber AS VARCHAR) AS num_documento, l_extendedprice AS valor_documento,
                           l_extendedprice AS valor_liquido, CAST(0 AS DOUBLE) AS valor_glosa,
                           s_name AS nome_fornecedor, t AS cnpj_cpf_fornecedor,
                           regexp_replace(t, '[^0-9]', '', 'g') AS cnpj_cpf_fornecedor_limpo,
                           NULL::VARCHAR AS url_documento, l_partkey AS cod_lote, l_linenumber AS parcela
                    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
                    JOIN (SELECT *, CASE WHEN s_nationkey < 5 THEN ''
                                 WHEN s_nationkey < 15 THEN lpad(CAST(s_suppkey AS VARCHAR), 12, '0') || '/-99'
                                 ELSE lpad(CAST(s_suppkey AS VARCHAR), 11, '0') END AS t
                          FROM supplier) s ON l_suppkey = s_suppkey) x) y
        WHERE nth = 1""",
    "dim_fornecedor": """
        SELECT row_number() OVER (ORDER BY nk_fornecedor) AS sk_fornecedor, *,
               CASE length(cnpj_cpf_fornecedor_limpo) WHEN 14 THEN 'PJ' WHEN 11 THEN 'PF'
                    ELSE 'NAO_IDENTIFICADO' END AS tipo_pessoa
        FROM (SELECT DISTINCT CASE WHEN trim(cnpj_cpf_fornecedor_limpo) <> '' THEN cnpj_cpf_fornecedor_limpo
                                   ELSE nome_fornecedor END AS nk_fornecedor,
                     cnpj_cpf_fornecedor, cnpj_cpf_fornecedor_limpo, nome_fornecedor FROM despesas) f""",
    "dim_categoria": """
        SELECT row_number() OVER (ORDER BY nk_categoria_despesa) AS sk_categoria_despesa, nk_categoria_despesa
        FROM (SELECT DISTINCT tipo_despesa AS nk_categoria_despesa FROM despesas) c""",
    "dim_cpi": """
        SELECT s_suppkey AS nk_cpi, s_name AS nome_cpi, 'S' || s_suppkey AS sigla, n_name AS tipo_orgao,
               lo AS data_inicio, NULL::DATE AS data_instalacao, hi AS data_fim,
               NULL::DATE AS data_fim_original, '/site/' || l_suppkey AS url_website,
               '/orgaos/' || l_suppkey AS uri_orgao,
               CASE WHEN hi IS NULL OR hi >= DATE '2001-10-15' THEN 'Em andamento' ELSE 'Encerrada' END
                 AS status_cpi
        FROM supplier JOIN nation ON s_nationkey = n_nationkey AND n_regionkey = 4
        LEFT JOIN (SELECT l_suppkey, CAST(min(l_shipdate) AS DATE) AS lo, CAST(max(l_shipdate) AS DATE) AS hi
                   FROM lineitem GROUP BY 1) l ON l_suppkey = s_suppkey""",
    "votos": """
        SELECT sha256(id_votacao || '|' || nk_deputado) AS nk_voto, id_votacao,
               CAST(replace(id_votacao, '-', '') AS BIGINT) AS id_evento, nk_deputado, voto, data_voto,
               CAST(1 AS INTEGER) AS resultado_votacao, 'ballot of ' || id_votacao AS descricao_votacao,
               'PLEN' AS sigla_orgao, CAST(year(data_voto) AS INTEGER) AS ano_voto,
               CAST(month(data_voto) AS INTEGER) AS mes_voto
        FROM (SELECT *, row_number() OVER (PARTITION BY id_votacao, nk_deputado ORDER BY voto, data_voto) AS nth
              FROM (SELECT strftime(l_shipdate, '%Y-%m') AS id_votacao, o_custkey AS nk_deputado,
                           CASE l_returnflag WHEN 'A' THEN 'Sim' WHEN 'N' THEN 'Não' ELSE 'Abstenção' END AS voto,
                           l_shipdate AS data_voto
                    FROM lineitem JOIN orders ON l_orderkey = o_orderkey) v) w WHERE nth = 1""",
    "roster": """
        SELECT b.sk_frente, b.sk_deputado, b.nk_frente, b.nk_deputado, f.titulo_frente, f.id_legislatura,
               d.nome_deputado, d.sigla_partido, d.sigla_uf
        FROM bridge_frente_deputado b JOIN dim_frente f ON f.sk_frente = b.sk_frente
        JOIN dim_deputado d ON d.sk_deputado = b.sk_deputado WHERE d.is_current""",
    "ihh": """
        SELECT nk_frente, titulo_frente, CAST(sum(c) AS BIGINT) AS qtd_deputados_frente, count(*) AS qtd_partidos,
               """ + half_up("sum(c * c) / power(sum(c), 2)", 4) + """ AS ihh,
               ['Baixa diversidade', 'Média diversidade', 'Alta diversidade'][
                 1 + CAST(ihh <= 0.25 AS INTEGER) + CAST(ihh <= 0.15 AS INTEGER)] AS classificacao_diversidade
        FROM (SELECT nk_frente, titulo_frente, len(list_distinct(list(nk_deputado))) AS c
              FROM roster GROUP BY nk_frente, titulo_frente, sigla_partido) seats GROUP BY nk_frente, titulo_frente""",
    "ranking": """
        SELECT nk_deputado, nome_deputado, sigla_partido, sigla_uf, count(DISTINCT nk_frente) AS qtd_frentes,
               array_to_string(list_sort(list(DISTINCT titulo_frente)), ',') AS frentes_participa
        FROM roster GROUP BY ALL""",
    "eventos": """
        SELECT e.sk_evento, e.nk_evento, e.data_evento, t.sk_data, k.sk_tipo_evento, k.descricao_tipo_evento,
               o.sk_orgao, o.sigla_orgao, o.nome_orgao, e.situacao_evento, e.descricao_evento, t.ano, t.mes,
               t.semana_ano
        FROM dim_evento e JOIN bridge_evento_orgao b ON b.sk_evento = e.sk_evento
        JOIN dim_orgao o ON o.sk_orgao = b.sk_orgao
        JOIN dim_tipo_evento k ON k.sk_tipo_evento = e.sk_tipo_evento
        JOIN dim_data t ON t.data = e.data_evento""",
    "futuros": "SELECT * FROM eventos WHERE data_evento > DATE '2001-05-01'",
    "densidade": """
        SELECT ano, semana_ano, ano || '-' || lpad(CAST(semana_ano AS VARCHAR), 2, '0') AS ano_semana,
               count(DISTINCT nk_evento) AS qtd_eventos, count(DISTINCT nk_evento) > 0 AS possui_evento
        FROM dim_data LEFT JOIN dim_evento ON data = data_evento GROUP BY ALL""",
    "taxa": """
        SELECT d.nk_deputado, d.nome_deputado, d.sigla_partido, d.sigla_uf, e.ano_evento, k.sk_tipo_evento,
               k.nome_tipo_evento, count(*) AS qtd_eventos_participados, any_value(held) AS qtd_total_eventos_tipo,
               """ + half_up("count(*) / any_value(held)", 4) + """ AS taxa_participacao,
               """ + half_up("count(*) / any_value(held) * 100", 2) + """ AS percentual_taxa_participacao
        FROM (SELECT *, count(*) OVER (PARTITION BY ano_evento, sk_tipo_evento) AS held FROM dim_evento) e
        JOIN dim_tipo_evento k USING (sk_tipo_evento)
        JOIN (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) seen ON seen.l_orderkey = e.nk_evento
        JOIN dim_deputado d ON d.is_current AND d.nk_deputado = seen.l_partkey
        GROUP BY ALL""",
    "comparativo": """
        SELECT t.ano, t.periodo_eleitoral, t.descricao_periodo_eleitoral, e.descricao_tipo_evento,
               count(DISTINCT e.nk_evento) AS qtd_eventos,
               """ + half_up("count(DISTINCT e.nk_evento) / count(DISTINCT t.semana_ano)", 2) + """
                 AS media_eventos_semana, count(DISTINCT e.sk_orgao) AS qtd_orgaos
        FROM eventos e JOIN dim_data t ON t.data = e.data_evento GROUP BY ALL""",
    "fat_despesas": """
        SELECT d.sk_deputado, d.sigla_partido, f.sk_fornecedor, c.sk_categoria_despesa, d.nk_deputado,
               x.ano, x.mes, x.ano_mes, x.data_documento, x.tipo_documento, x.cod_documento, x.cod_lote,
               x.parcela, x.valor_documento, x.valor_liquido, x.valor_glosa, x.url_documento
        FROM despesas x JOIN dim_deputado d ON d.nk_deputado = x.nk_deputado AND d.is_current
        JOIN dim_fornecedor f
          ON coalesce(nullif(x.cnpj_cpf_fornecedor_limpo, ''), x.nome_fornecedor) = f.nk_fornecedor
        JOIN dim_categoria c ON c.nk_categoria_despesa = x.tipo_despesa""",
    "top_gastos": """
        SELECT ano, mes, ano_mes, sigla_partido, len(list_distinct(list(nk_deputado))) AS qtd_deputados,
               count(*) AS qtd_despesas, CAST(sum(CAST(valor_liquido AS DECIMAL(18,2))) AS DOUBLE) AS valor_total_liquido,
               CAST(row_number() OVER (PARTITION BY ano_mes ORDER BY sum(CAST(valor_liquido AS DECIMAL(18,2))) DESC,
                    sigla_partido) AS INTEGER) AS ranking_gasto_partido
        FROM fat_despesas GROUP BY ano, mes, ano_mes, sigla_partido QUALIFY ranking_gasto_partido <= 10""",
    "anomalias": """
        WITH cents AS (SELECT x.sk_deputado, d.nome_deputado, d.sigla_uf, c.nk_categoria_despesa AS tipo_despesa,
                              x.valor_liquido, CAST(round(x.valor_liquido * 100) AS HUGEINT) AS v
                       FROM fat_despesas x JOIN dim_deputado d USING (sk_deputado) JOIN dim_categoria c USING (sk_categoria_despesa)),
             sums AS (SELECT *, count(*) OVER g AS n, CAST(sum(v) OVER g AS HUGEINT) AS total, CAST(sum(v * v) OVER g AS HUGEINT) AS squares
                      FROM cents WINDOW g AS (PARTITION BY tipo_despesa, sigla_uf)),
             spread AS (SELECT *, sqrt(CAST(n * squares - total * total AS DOUBLE) / (CAST(n AS DOUBLE) * (n - 1))) AS s
                        FROM sums WHERE n * squares > total * total)
        SELECT sk_deputado, nome_deputado, sigla_uf, tipo_despesa, """ + half_up("valor_liquido", 2) + """ AS valor_liquido,
               CAST((total * 2 + n) // (n * 2) AS DOUBLE) / 100 AS media_grupo, """ + half_up("s / 100", 2) + """ AS desvio_grupo,
               """ + half_up("(v - total / n) / s", 2) + """ AS z_score,
               coalesce((['Comportamento esperado', 'Leve desvio', 'Atenção', 'Possível anomalia'])[1 + CAST(floor(abs(z_score)) AS INTEGER)],
                        'Muito atípico') AS classificacao_anomalia
        FROM spread""",
    "frentes_votacoes": """
        WITH counted AS (SELECT f.nk_frente, f.titulo_frente, v.id_votacao, count(*) AS total_deputados,
                                count(*) - count(v.voto) AS silent, CAST(list_max(map_values(histogram(v.voto))) AS BIGINT) AS most
                         FROM votos v JOIN bridge_frente_deputado b USING (nk_deputado) JOIN dim_frente f USING (nk_frente)
                         GROUP BY 1, 2, 3),
             shares AS (SELECT * EXCLUDE (silent, most), CASE WHEN most > silent THEN most ELSE 0 END AS deputados_alinhados FROM counted)
        SELECT *, CAST((deputados_alinhados * 20000 + total_deputados) // (2 * total_deputados) AS DOUBLE) / 100 AS percent_alinhamento,
               (['Baixo', 'Médio', 'Alto'])[1 + CAST(percent_alinhamento >= 60 AS INTEGER) + CAST(percent_alinhamento >= 80 AS INTEGER)]
                 AS faixa_alinhamento
        FROM shares""",
    "frentes_alinhamento": """
        WITH c AS (SELECT nk_frente, titulo_frente, count(*) AS qtd_votacoes,
                          """ + exact_mean("percent_alinhamento") + """ AS media_alinhamento,
                          min(percent_alinhamento) AS menor_alinhamento,
                          max(percent_alinhamento) AS maior_alinhamento,
                          stddev_samp(percent_alinhamento) AS sd FROM frentes_votacoes GROUP BY ALL)
        SELECT nk_frente, titulo_frente, qtd_votacoes, media_alinhamento, menor_alinhamento, maior_alinhamento,
               CASE WHEN media_alinhamento >= 80 THEN 'Muito Coesa' WHEN media_alinhamento >= 60 THEN 'Coesa'
                    ELSE 'Fragmentada' END AS classificacao,
               """ + half_up("sd", 2) + """ AS desvio_alinhamento,
               CASE WHEN sd < 10 THEN 'Sim' ELSE 'Não' END AS possui_baixo_desvio FROM c""",
    "engajamento": """
        WITH deeds AS (SELECT l_partkey AS nk_deputado, 'E' || l_orderkey AS deed, NULL AS voto FROM lineitem
                       UNION ALL SELECT nk_deputado, 'V' || id_votacao, upper(coalesce(voto, '')) FROM votos),
             counted AS (SELECT nk_deputado, count(DISTINCT deed) FILTER (deed[1] = 'E') AS qtd_eventos_presente,
                                count(DISTINCT deed) FILTER (deed[1] = 'V') AS qtd_votacoes_participadas,
                                """ + ", ".join(
        f"count(*) FILTER (voto = '{word}') AS {name}"
        for name, word in {
            "qtd_votos_sim": "SIM",
            "qtd_votos_nao": "NÃO",
            "qtd_abstencoes": "ABSTENÇÃO",
            "qtd_obstrucoes": "OBSTRUÇÃO",
            "qtd_art17": "ART. 17",
            "qtd_liberado": "LIBERADO",
        }.items()
    ) + """
                         FROM deeds GROUP BY 1),
             both_ AS (SELECT nome_deputado, sigla_partido, sigla_uf, counted.* FROM counted JOIN dim_deputado USING (nk_deputado)
                       WHERE is_current AND qtd_eventos_presente > 0 AND qtd_votacoes_participadas > 0),
             top AS (SELECT max(qtd_eventos_presente) AS e, max(qtd_votacoes_participadas) AS v FROM both_),
             scored AS (SELECT both_.*, (qtd_eventos_presente / e * 100) * 0.4::DOUBLE + (qtd_votacoes_participadas / v * 100) * 0.6::DOUBLE
                          AS score_engajamento FROM both_, top)
        SELECT *, percent_rank() OVER up AS percentil_engajamento,
               dense_rank() OVER (ORDER BY -score_engajamento) AS ranking_engajamento
        FROM scored WINDOW up AS (ORDER BY score_engajamento)""",
    "engajamento_partido": """
        WITH g AS (SELECT sigla_partido, count(*) AS n, avg(score_engajamento) AS m,
                          max(score_engajamento) AS hi, min(score_engajamento) AS lo
                   FROM engajamento GROUP BY 1)
        SELECT sigla_partido, n AS qtd_deputados, """ + half_up("m", 2) + """ AS media_engajamento,
               """ + half_up("hi", 2) + """ AS maior_score, """ + half_up("lo", 2) + """ AS menor_score,
               dense_rank() OVER (ORDER BY m DESC) AS ranking_engajamento,
               CASE WHEN m >= 80 THEN 'Alto' WHEN m >= 60 THEN 'Médio' ELSE 'Baixo' END AS faixa_engajamento
        FROM g""",
    "cpis": """
        SELECT *, CASE WHEN data_inicio IS NOT NULL THEN 'Sim' ELSE 'Não' END AS possui_data_inicio,
               CASE WHEN data_fim IS NOT NULL THEN 'Sim' ELSE 'Não' END AS possui_data_fim FROM dim_cpi""",
}


def oracle(step: str) -> str:
    """A WITH query that holds every step up to ``step`` that it needs."""
    names = list(STEPS)
    needed = [step]
    for name in reversed(names[: names.index(step)]):
        if any(name in re.findall(r"\w+", STEPS[n]) for n in needed):
            needed.append(name)
    ctes = ",\n".join(f"{n} AS ({STEPS[n]})" for n in names if n in needed)
    return f"WITH {ctes}\nSELECT * FROM {step}"


def _plain(df):
    """Without ingestion time, and with wall-clock timestamps."""
    out = df.drop("bronze_ingested_at")
    return out.withColumns(
        {n: F.col(n).cast("timestamp_ntz") for n, t in out.dtypes if t == "timestamp"}
    )


@query("silver_dim_deputado", oracle("dim_deputado"))
def silver_dim_deputado(spark, d):
    return _plain(dim_deputado(spark, d))


@query("silver_dim_frente", oracle("dim_frente"))
def silver_dim_frente(spark, d):
    return _plain(dim_frente(spark, d))


@query("silver_bridge_frente_deputado", oracle("bridge_frente_deputado"))
def silver_bridge_frente_deputado(spark, d):
    return _plain(bridge_frente_deputado(spark, d))


@query("silver_dim_tipo_evento", oracle("dim_tipo_evento"))
def silver_dim_tipo_evento(spark, d):
    return _plain(dim_tipo_evento(spark, d))


@query("silver_dim_evento", oracle("dim_evento"))
def silver_dim_evento(spark, d):
    return _plain(dim_evento(spark, d)).drop("orgaos", "raw_payload")


@query("silver_dim_orgao", oracle("dim_orgao"))
def silver_dim_orgao(spark, d):
    return stored_events(spark, d)[1]


@query("silver_bridge_evento_orgao", oracle("bridge_evento_orgao"))
def silver_bridge_evento_orgao(spark, d):
    return stored_events(spark, d)[2]


@query("silver_despesas", oracle("despesas"))
def silver_despesas(spark, d):
    return despesas(spark, d)


@query("silver_dim_fornecedor", oracle("dim_fornecedor"))
def silver_dim_fornecedor(spark, d):
    return L.dim_fornecedor(despesas(spark, d))


@query("silver_dim_categoria_despesa", oracle("dim_categoria"))
def silver_dim_categoria(spark, d):
    return L.dim_categoria_despesa(despesas(spark, d))


@query("silver_dim_cpi", oracle("dim_cpi"))
def silver_dim_cpi(spark, d):
    return dim_cpi(spark, d)


@query("silver_votos", oracle("votos"))
def silver_votos(spark, d):
    return _plain(votos(spark, d))


@query("gold_frentes_membros", oracle("roster"))
def gold_frentes_membros(spark, d):
    return roster(spark, d)


@query("gold_ihh_frentes", oracle("ihh"))
def gold_ihh_frentes(spark, d):
    return G.ihh_frentes(roster(spark, d), dim_frente(spark, d))


@query("gold_ranking_deputados", oracle("ranking"))
def gold_ranking_deputados(spark, d):
    ranked = G.ranking_deputados(roster(spark, d))
    return ranked.withColumn("frentes_participa", F.array_join("frentes_participa", ","))


@query("gold_eventos", oracle("eventos"))
def gold_eventos_query(spark, d):
    return gold_eventos(spark, d)


@query("gold_eventos_futuros", oracle("futuros"))
def gold_eventos_futuros(spark, d):
    return G.eventos_futuros(gold_eventos(spark, d), dt.date(2001, 5, 1))


@query("gold_densidade_eventos_semana", oracle("densidade"))
def gold_densidade(spark, d):
    return G.densidade_eventos_semana(dim_data(spark, d), dim_evento(spark, d))


@query("gold_taxa_presenca_evento", oracle("taxa"))
def gold_taxa_presenca(spark, d):
    return G.taxa_presenca_evento(
        presenca(spark, d), dim_evento(spark, d), dim_tipo_evento(spark, d), dim_deputado(spark, d)
    )


@query("gold_comparativo_periodo", oracle("comparativo"))
def gold_comparativo(spark, d):
    return G.comparativo_periodo_eleitoral(gold_eventos(spark, d), dim_data(spark, d))


@query("gold_fat_despesas", oracle("fat_despesas"))
def gold_fat_despesas(spark, d):
    return fat_despesas(spark, d)


@query("gold_top_gastos_partido", oracle("top_gastos"))
def gold_top_gastos(spark, d):
    return G.top_gastos_partido(fat_despesas(spark, d))


@query("gold_anomalias_despesas", oracle("anomalias"))
def gold_anomalias(spark, d):
    spent = checkpointed(despesas(spark, d))
    category, member = L.dim_categoria_despesa(spent), dim_deputado(spark, d)
    fact = G.fat_despesas(spent, member, L.dim_fornecedor(spent), category)
    return G.anomalias_despesas(fact, category, member)


@query("gold_frentes_votacoes", oracle("frentes_votacoes"))
def gold_frentes_votacoes(spark, d):
    return frentes_votacoes(spark, d)


@query("gold_frentes_alinhamento", oracle("frentes_alinhamento"))
def gold_frentes_alinhamento(spark, d):
    return G.frentes_alinhamento(frentes_votacoes(spark, d))


@query("gold_engajamento_deputado", oracle("engajamento"))
def gold_engajamento_deputado(spark, d):
    return engajamento(spark, d)


@query("gold_engajamento_partido", oracle("engajamento_partido"))
def gold_engajamento_partido(spark, d):
    return G.engajamento_partido(engajamento(spark, d))


@query("gold_cpis", oracle("cpis"))
def gold_cpis(spark, d):
    return G.cpis(dim_cpi(spark, d))
