"""The marts, named and shaped as their readers know them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from martloom.functions import blank_to_null
from martloom.operators import Dim, salted_join, star_join
from martloom.plans import marts as M
from martloom.plans.legislative import schemas as S

MEMBER = ["nome_deputado", "sigla_partido", "sigla_uf"]


def _current(dim_deputado: DataFrame) -> DataFrame:
    return dim_deputado.filter("is_current")


def frentes_membros(
    bridge_frente_deputado: DataFrame, dim_frente: DataFrame, dim_deputado: DataFrame
) -> DataFrame:
    """Roster: members of each caucus, both of them known."""
    keys = bridge_frente_deputado.select("sk_frente", "sk_deputado", "nk_frente", "nk_deputado")
    return star_join(
        keys,
        Dim(dim_frente, [("sk_frente", "sk_frente")], ["titulo_frente", "id_legislatura"]),
        Dim(_current(dim_deputado), [("sk_deputado", "sk_deputado")], MEMBER),
    )


def ihh_frentes(frentes_membros: DataFrame, dim_frente: DataFrame) -> DataFrame:
    """Party concentration of each caucus."""
    index = M.concentration_index(
        frentes_membros,
        "nk_frente",
        "sigla_partido",
        "nk_deputado",
        "qtd_deputados_frente",
        "qtd_partidos",
        "ihh",
        "classificacao_diversidade",
    )
    titled = star_join(index, Dim(dim_frente, [("nk_frente", "nk_frente")], ["titulo_frente"]))
    return titled.select(
        "nk_frente",
        "titulo_frente",
        "qtd_deputados_frente",
        "qtd_partidos",
        "ihh",
        "classificacao_diversidade",
    )


def ranking_deputados(frentes_membros: DataFrame) -> DataFrame:
    """Caucuses each member belongs to."""
    return M.participation_ranking(
        frentes_membros,
        ["nk_deputado", *MEMBER],
        "nk_frente",
        "titulo_frente",
        "qtd_frentes",
        "frentes_participa",
    )


def eventos(
    dim_evento: DataFrame,
    bridge_evento_orgao: DataFrame,
    dim_orgao: DataFrame,
    dim_tipo_evento: DataFrame,
    dim_data: DataFrame,
) -> DataFrame:
    """Event x committee with type and calendar attributes."""
    fact = dim_evento.select(
        "sk_evento",
        "nk_evento",
        "data_evento",
        "sk_tipo_evento",
        "situacao_evento",
        "descricao_evento",
    )
    joined = star_join(
        fact,
        Dim(dim_tipo_evento, [("sk_tipo_evento", "sk_tipo_evento")], ["descricao_tipo_evento"]),
        Dim(dim_data, [("data_evento", "data")], ["sk_data", "ano", "mes", "semana_ano"]),
        Dim(bridge_evento_orgao, [("sk_evento", "sk_evento")], ["sk_orgao"]),
        Dim(dim_orgao, [("sk_orgao", "sk_orgao")], ["sigla_orgao", "nome_orgao"]),
    )
    return joined.select(
        "sk_evento",
        "nk_evento",
        "data_evento",
        "sk_data",
        "sk_tipo_evento",
        "descricao_tipo_evento",
        "sk_orgao",
        "sigla_orgao",
        "nome_orgao",
        "situacao_evento",
        "descricao_evento",
        "ano",
        "mes",
        "semana_ano",
    )


def eventos_futuros(eventos: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    return M.future_events(eventos, "data_evento", as_of)


def densidade_eventos_semana(dim_data: DataFrame, dim_evento: DataFrame) -> DataFrame:
    """Events per calendar week, weeks without events included."""
    days = dim_data.select(
        F.col("data").alias("date"), F.col("semana_ano").alias("iso_week")
    )
    names = {
        "year": "ano",
        "iso_week": "semana_ano",
        "year_week": "ano_semana",
        "events": "qtd_eventos",
        "has_events": "possui_evento",
    }
    return M.weekly_density(days, dim_evento, "data_evento", "nk_evento").withColumnsRenamed(names)


def taxa_presenca_evento(
    bronze_presenca: DataFrame,
    dim_evento: DataFrame,
    dim_tipo_evento: DataFrame,
    dim_deputado: DataFrame,
) -> DataFrame:
    """Share of each year's events of a type that a member attended."""
    presence = bronze_presenca.select(
        F.col("id").alias("nk_deputado"), F.col("id_evento").alias("nk_evento")
    )
    events = dim_evento.select("nk_evento", "ano_evento", "sk_tipo_evento")
    rates = M.attendance_rate(
        presence,
        events,
        "nk_deputado",
        "nk_evento",
        "ano_evento",
        "sk_tipo_evento",
        "qtd_eventos_participados",
        "qtd_total_eventos_tipo",
    )
    named = star_join(
        rates,
        Dim(dim_tipo_evento, [("sk_tipo_evento", "sk_tipo_evento")], ["nome_tipo_evento"]),
        Dim(_current(dim_deputado), [("nk_deputado", "nk_deputado")], MEMBER),
    )
    return named.select(
        "nk_deputado",
        *MEMBER,
        "ano_evento",
        "sk_tipo_evento",
        "nome_tipo_evento",
        "qtd_eventos_participados",
        "qtd_total_eventos_tipo",
        F.col("attendance_rate").alias("taxa_participacao"),
        F.col("attendance_percent").alias("percentual_taxa_participacao"),
    )


def comparativo_periodo_eleitoral(eventos: DataFrame, dim_data: DataFrame) -> DataFrame:
    """Event counts inside and outside election periods."""
    flags = ["periodo_eleitoral", "descricao_periodo_eleitoral"]
    dated = star_join(
        eventos.select(
            "nk_evento", "data_evento", "descricao_tipo_evento", "sk_orgao", "ano", "semana_ano"
        ),
        Dim(dim_data, [("data_evento", "data")], flags),
    )
    return M.period_comparison(
        dated,
        ["ano", *flags, "descricao_tipo_evento"],
        "nk_evento",
        "semana_ano",
        "sk_orgao",
        "qtd_eventos",
        "media_eventos_semana",
        "qtd_orgaos",
    )


def _expense_dims(
    dim_deputado: DataFrame, dim_fornecedor: DataFrame, dim_categoria: DataFrame
) -> dict[str, Dim]:
    supplier = F.coalesce(blank_to_null("cnpj_cpf_fornecedor_limpo"), F.col("nome_fornecedor"))
    return {
        "deputado": Dim(
            _current(dim_deputado),
            [("nk_deputado", "nk_deputado")],
            ["sk_deputado", "sigla_partido"],
        ),
        "categoria": Dim(
            dim_categoria, [("tipo_despesa", "nk_categoria_despesa")], ["sk_categoria_despesa"]
        ),
        "fornecedor": Dim(dim_fornecedor, [(supplier, "nk_fornecedor")], ["sk_fornecedor"]),
    }


def fat_despesas(
    despesas: DataFrame,
    dim_deputado: DataFrame,
    dim_fornecedor: DataFrame,
    dim_categoria: DataFrame,
    losses: Observation | None = None,
) -> DataFrame:
    """Expense fact with the keys of member, supplier and category; ``losses`` as in ``star_join``."""
    dims = _expense_dims(dim_deputado, dim_fornecedor, dim_categoria)
    return star_join(despesas, *dims.values(), losses=losses).select(
        "sk_deputado",
        "sigla_partido",
        "sk_fornecedor",
        "sk_categoria_despesa",
        "nk_deputado",
        "ano",
        "mes",
        "ano_mes",
        "data_documento",
        "tipo_documento",
        "cod_documento",
        "cod_lote",
        "parcela",
        "valor_documento",
        "valor_liquido",
        "valor_glosa",
        "url_documento",
    )


def top_gastos_partido(fat_despesas: DataFrame, n: int = 10) -> DataFrame:
    """The parties that spent most in each month."""
    return M.top_n_monthly(
        fat_despesas,
        "sigla_partido",
        ["ano", "mes", "ano_mes"],
        "valor_liquido",
        "nk_deputado",
        n,
        "qtd_deputados",
        "qtd_despesas",
        "valor_total_liquido",
        "ranking_gasto_partido",
    )


def anomalias_despesas(
    fat_despesas: DataFrame, dim_categoria: DataFrame, dim_deputado: DataFrame
) -> DataFrame:
    """Expenses that deviate from their category and state."""
    located = star_join(
        fat_despesas.select("sk_deputado", "sk_categoria_despesa", "valor_liquido"),
        Dim(_current(dim_deputado), [("sk_deputado", "sk_deputado")], ["nome_deputado", "sigla_uf"]),
    )
    scored = M.zscore_outliers(
        located,
        ["sk_categoria_despesa", "sigla_uf"],
        "valor_liquido",
        ["sk_deputado", "nome_deputado"],
        "media_grupo",
        "desvio_grupo",
        "classificacao_anomalia",
        amounts=True,
    )
    category = Dim(
        dim_categoria,
        [("sk_categoria_despesa", "sk_categoria_despesa")],
        {"nk_categoria_despesa": "tipo_despesa"},
    )
    return star_join(scored, category).select(
        "sk_deputado",
        "nome_deputado",
        "sigla_uf",
        "tipo_despesa",
        "valor_liquido",
        "media_grupo",
        "desvio_grupo",
        "z_score",
        "classificacao_anomalia",
    )


def frentes_votacoes(
    bridge_frente_deputado: DataFrame,
    dim_frente: DataFrame,
    votos: DataFrame,
    rows_per_task: int = 1_000_000,
) -> DataFrame:
    """Agreement of each caucus with its own majority, per ballot.

    Every vote counts once for each caucus of its member. A member with very
    many votes is spread over several tasks before that multiplication.
    """
    seats = star_join(
        bridge_frente_deputado.select("nk_frente", "nk_deputado"),
        Dim(dim_frente, [("nk_frente", "nk_frente")]),
    )
    cast = votos.select("nk_deputado", "id_votacao", "voto")
    fanned = salted_join(
        cast, seats, "nk_deputado", spread_by=["id_votacao"], rows_per_task=rows_per_task
    )
    aligned = M.alignment(
        fanned,
        ["nk_frente", "id_votacao"],
        "voto",
        "deputados_alinhados",
        "total_deputados",
        "percent_alinhamento",
        "faixa_alinhamento",
    )
    titled = star_join(aligned, Dim(dim_frente, [("nk_frente", "nk_frente")], ["titulo_frente"]))
    return titled.select(
        "nk_frente",
        "titulo_frente",
        "id_votacao",
        "deputados_alinhados",
        "total_deputados",
        "percent_alinhamento",
        "faixa_alinhamento",
    )


def frentes_alinhamento(frentes_votacoes: DataFrame) -> DataFrame:
    """Cohesion of each caucus over its ballots."""
    names = {
        "ballots": "qtd_votacoes",
        "mean_alignment": "media_alinhamento",
        "min_alignment": "menor_alinhamento",
        "max_alignment": "maior_alinhamento",
        "cohesion_band": "classificacao",
        "stddev_alignment": "desvio_alinhamento",
        "has_low_spread": "possui_baixo_desvio",
    }
    return M.cohesion(
        frentes_votacoes, ["nk_frente", "titulo_frente"], "percent_alinhamento"
    ).withColumnsRenamed(names)


def cpis(dim_cpi: DataFrame) -> DataFrame:
    """Committees of inquiry with two presence flags."""
    flagged = M.inquiry_catalog(dim_cpi, "data_inicio", "data_fim")
    return flagged.select(
        "nk_cpi",
        "nome_cpi",
        "sigla",
        "tipo_orgao",
        "status_cpi",
        "data_inicio",
        "data_instalacao",
        "data_fim",
        "data_fim_original",
        "url_website",
        "uri_orgao",
        F.col("has_start").alias("possui_data_inicio"),
        F.col("has_end").alias("possui_data_fim"),
    )


def engajamento_deputado(
    dim_deputado: DataFrame, bronze_presenca: DataFrame, votos: DataFrame
) -> DataFrame:
    """Composite engagement of each member."""
    presence = bronze_presenca.select(F.col("id").alias("nk_deputado"), "id_evento")
    return M.engagement_score(
        _current(dim_deputado),
        presence,
        votos,
        "nk_deputado",
        MEMBER,
        "id_evento",
        "id_votacao",
        "voto",
        S.VOTE_KINDS,
        "qtd_eventos_presente",
        "qtd_votacoes_participadas",
        "score_engajamento",
        "ranking_engajamento",
        "percentil_engajamento",
    )


def engajamento_partido(engajamento_deputado: DataFrame) -> DataFrame:
    """Engagement per party."""
    names = {
        "members": "qtd_deputados",
        "mean_score": "media_engajamento",
        "max_score": "maior_score",
        "min_score": "menor_score",
        "score_band": "faixa_engajamento",
    }
    return M.engagement_by_group(
        engajamento_deputado, "sigla_partido", "score_engajamento", "ranking_engajamento"
    ).withColumnsRenamed(names)
