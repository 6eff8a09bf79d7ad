"""Dimensions, bridges and facts built from bronze tables.

``existing`` is the table as the last run left it; its surrogate keys are
kept. Nothing is stamped here, see ``build``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions import (
    date_parts,
    digits_only,
    hash_key,
    id_after,
    money,
    month_label,
    norm_text,
    parse_date,
    parse_timestamp,
    party_kind,
    tax_id_or_name,
    trailing_id,
    typed_select,
)
from martloom.operators import Dim, calendar_between, dedupe, open_history, scd2_apply, stable_key, star_join
from martloom.operators.calendar import Period
from martloom.operators.dedupe import tie_break
from martloom.operators.upsert import newest_per_key
from martloom.plans.legislative import schemas as S
from martloom.plans.marts import open_status

INGESTED = ("ingested_at", "bronze_ingested_at", "timestamp")


def members(bronze: DataFrame) -> DataFrame:
    """Typed members, newest row per (member, party, state, term)."""
    typed = typed_select(
        bronze,
        [
            ("id", "nk_deputado", "bigint"),
            ("uri", "uri_deputado", "string"),
            ("nome", "nome_deputado", "string"),
            ("siglaPartido", "sigla_partido", "string"),
            (id_after("uriPartido", "partidos"), "id_partido", "bigint"),
            ("siglaUf", "sigla_uf", "string"),
            ("idLegislatura", "id_legislatura", "int"),
            ("urlFoto", "url_foto", "string"),
            ("email", "email", "string"),
            INGESTED,
        ],
    )
    return dedupe(
        typed,
        ["nk_deputado", "sigla_partido", "sigla_uf", "id_legislatura"],
        "bronze_ingested_at",
    )


def dim_deputado(
    bronze: DataFrame, as_of: dt.date, existing: DataFrame | None = None
) -> DataFrame:
    """Members as they are now: one current row per member, key kept over reruns."""
    newest = dedupe(members(bronze), "nk_deputado", "bronze_ingested_at")
    return open_history(stable_key(newest, existing, "nk_deputado", "sk_deputado"), as_of)


def dim_deputado_history(
    bronze: DataFrame, as_of: dt.date, existing: DataFrame | None = None
) -> DataFrame:
    """Members with every change of party, state or term as a version of its own.

    The key identifies the member, (key, valid_from) the version.
    """
    newest = dedupe(members(bronze), "nk_deputado", "bronze_ingested_at")
    if existing is None:
        return open_history(stable_key(newest, None, "nk_deputado", "sk_deputado"), as_of)
    held = existing.select("nk_deputado", "sk_deputado").distinct()
    keyed = stable_key(newest, held, "nk_deputado", "sk_deputado")
    return scd2_apply(
        existing, keyed, "nk_deputado", ["sigla_partido", "sigla_uf", "id_legislatura"], as_of
    )


def dim_frente(bronze: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Caucuses; of several terms of one caucus the newest row counts."""
    typed = typed_select(
        bronze,
        [
            ("id", "nk_frente", "bigint"),
            ("idLegislatura", "id_legislatura", "int"),
            ("titulo", "titulo_frente", "string"),
            ("uri", "uri_frente", "string"),
            INGESTED,
        ],
    )
    newest = dedupe(typed, "nk_frente", ["bronze_ingested_at", "id_legislatura"])
    return stable_key(newest, existing, "nk_frente", "sk_frente")


def bridge_frente_deputado(
    bronze: DataFrame, dim_frente: DataFrame, dim_deputado: DataFrame
) -> DataFrame:
    """Caucus members with both surrogate keys; names come from the member dimension if known."""
    typed = typed_select(
        bronze,
        [
            ("id_frente", "nk_frente", "bigint"),
            ("id", "nk_deputado", "bigint"),
            ("nome", "_nome", "string"),
            ("siglaPartido", "_partido", "string"),
            ("siglaUf", "_uf", "string"),
            ("idLegislatura", "id_legislatura", "int"),
            INGESTED,
        ],
    )
    pairs = dedupe(typed, ["nk_frente", "nk_deputado"], "bronze_ingested_at")
    current = dim_deputado.filter("is_current")
    names = ["sk_deputado", "nome_deputado", "sigla_partido", "sigla_uf"]
    joined = star_join(
        pairs,
        Dim(dim_frente, [("nk_frente", "nk_frente")], ["sk_frente"], "left"),
        Dim(current, [("nk_deputado", "nk_deputado")], names, "left"),
    )
    return joined.select(
        "sk_frente",
        "sk_deputado",
        "nk_frente",
        "nk_deputado",
        F.coalesce("nome_deputado", "_nome").alias("nome_deputado"),
        F.coalesce("sigla_partido", "_partido").alias("sigla_partido"),
        F.coalesce("sigla_uf", "_uf").alias("sigla_uf"),
        "id_legislatura",
        "bronze_ingested_at",
    )


def dim_tipo_evento(bronze: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Event types; a missing description falls back to the name, then the code."""
    typed = typed_select(
        bronze,
        [
            ("cod", "cod_tipo_evento", "bigint"),
            ("sigla", "sigla_tipo_evento", "string"),
            ("nome", "nome_tipo_evento", "string"),
            (
                F.coalesce("descricao", "nome", "sigla"),
                "descricao_tipo_evento",
                "string",
            ),
            INGESTED,
        ],
    )
    newest = dedupe(typed, "cod_tipo_evento", "bronze_ingested_at")
    return stable_key(newest, existing, "cod_tipo_evento", "sk_tipo_evento")


def dim_evento(
    bronze: DataFrame, dim_tipo_evento: DataFrame, existing: DataFrame | None = None
) -> DataFrame:
    """Events with place, times, date parts and the type found by its normalised name."""
    placed = bronze.withColumn("_local", F.from_json("localCamara", S.EVENT_PLACE))
    typed = typed_select(
        placed,
        [
            ("id", "nk_evento", "bigint"),
            ("uri", "uri_evento", "string"),
            (parse_timestamp("dataHoraInicio"), "data_hora_inicio", "timestamp"),
            (parse_timestamp("dataHoraFim"), "data_hora_fim", "timestamp"),
            ("situacao", "situacao_evento", "string"),
            ("descricaoTipo", "descricao_tipo_evento", "string"),
            ("descricao", "descricao_evento", "string"),
            ("localExterno", "local_externo", "string"),
            ("_local.nome", "local_camara_nome", "string"),
            ("_local.predio", "local_camara_predio", "string"),
            ("_local.sala", "local_camara_sala", "string"),
            ("_local.andar", "local_camara_andar", "string"),
            ("urlRegistro", "url_registro", "string"),
            ("orgaos", "orgaos", "string"),
            ("raw_payload", "raw_payload", "string"),
            INGESTED,
        ],
    )
    newest = dedupe(typed, "nk_evento", "bronze_ingested_at")
    # two types with one normalised name would double their events
    types = dedupe(
        dim_tipo_evento.select(
            norm_text("nome_tipo_evento").alias("_nome_tipo"), "sk_tipo_evento", "cod_tipo_evento"
        ),
        "_nome_tipo",
    )
    typed_events = star_join(
        newest,
        Dim(
            types,
            [(norm_text("descricao_tipo_evento"), "_nome_tipo")],
            ["sk_tipo_evento", "cod_tipo_evento"],
            "left",
        ),
    )
    dated = typed_events.select(
        "*",
        F.to_date("data_hora_inicio").alias("data_evento"),
        *date_parts(
            "data_hora_inicio",
            {"year": "ano_evento", "month": "mes_evento", "iso_week": "semana_evento"},
        ),
    )
    return stable_key(dated, existing, "nk_evento", "sk_evento")


def exploded_committees(dim_evento: DataFrame) -> DataFrame:
    """One row per (event, committee) from the committees kept as JSON text."""
    parsed = F.from_json("orgaos", S.EVENT_COMMITTEES)
    return dim_evento.select("sk_evento", "nk_evento", F.explode(parsed).alias("orgao"))


def dim_orgao(dim_evento: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Committees named by any event."""
    typed = typed_select(
        exploded_committees(dim_evento),
        [
            ("orgao.id", "nk_orgao", "bigint"),
            ("orgao.sigla", "sigla_orgao", "string"),
            ("orgao.nome", "nome_orgao", "string"),
            ("orgao.apelido", "apelido_orgao", "string"),
            ("orgao.codTipoOrgao", "cod_tipo_orgao", "bigint"),
            ("orgao.tipoOrgao", "tipo_orgao", "string"),
            ("orgao.nomePublicacao", "nome_publicacao", "string"),
            ("orgao.nomeResumido", "nome_resumido", "string"),
        ],
    ).filter(F.col("nk_orgao").isNotNull())
    return stable_key(dedupe(typed, "nk_orgao"), existing, "nk_orgao", "sk_orgao")


def bridge_evento_orgao(dim_evento: DataFrame, dim_orgao: DataFrame) -> DataFrame:
    """Distinct (event, committee) pairs with both surrogate keys."""
    pairs = (
        exploded_committees(dim_evento)
        .select("sk_evento", "nk_evento", F.col("orgao.id").alias("nk_orgao"))
        .distinct()
    )
    committee = Dim(dim_orgao, [("nk_orgao", "nk_orgao")], ["sk_orgao"], "left")
    return star_join(pairs, committee).select("sk_evento", "sk_orgao", "nk_evento", "nk_orgao")


def dim_data(dates: DataFrame, date: str, periods: list[Period]) -> DataFrame:
    """The calendar from the first to the last of ``dates``, with the election period flag."""
    days = calendar_between(dates, date, periods, S.OUTSIDE_PERIODS)
    names = {
        "date_key": "sk_data",
        "date": "data",
        "year": "ano",
        "month": "mes",
        "month_name": "nome_mes",
        "quarter": "trimestre",
        "year_month": "ano_mes",
        "iso_week": "semana_ano",
        "day": "dia_mes",
        "weekday": "dia_semana",
        "weekday_name": "nome_dia_semana",
        "is_weekend": "is_fim_semana",
        "in_period": "periodo_eleitoral",
        "period_label": "descricao_periodo_eleitoral",
    }
    return days.select(*[F.col(c).alias(n) for c, n in names.items()])


def despesas(bronze: DataFrame, losses: Observation | None = None) -> DataFrame:
    """Typed expenses with month label, cleaned tax id, date parts and hash key.

    Instalments of one document share the hash; (nk_despesa, parcela) is unique. ``losses`` as in ``typed_select``.
    """
    typed = typed_select(
        bronze,
        [
            ("nk_deputado", "nk_deputado", "bigint"),
            ("ano", "ano", "int"),
            ("mes", "mes", "int"),
            (month_label("ano", "mes"), "ano_mes", "string"),
            ("tipoDespesa", "tipo_despesa", "string"),
            ("codDocumento", "cod_documento", "bigint"),
            ("tipoDocumento", "tipo_documento", "string"),
            ("codTipoDocumento", "cod_tipo_documento", "int"),
            (parse_date("dataDocumento"), "data_documento", "date"),
            ("numDocumento", "num_documento", "string"),
            ("valorDocumento", "valor_documento", "double"),
            ("valorLiquido", "valor_liquido", "double"),
            ("valorGlosa", "valor_glosa", "double"),
            ("nomeFornecedor", "nome_fornecedor", "string"),
            ("cnpjCpfFornecedor", "cnpj_cpf_fornecedor", "string"),
            (digits_only("cnpjCpfFornecedor"), "cnpj_cpf_fornecedor_limpo", "string"),
            ("urlDocumento", "url_documento", "string"),
            ("codLote", "cod_lote", "bigint"),
            ("parcela", "parcela", "int"),
            ("ingested_at", "_ingested_at", "timestamp"),
        ],
        losses,
        {"data_documento": "dataDocumento"},
    )
    newest = dedupe(
        typed, ["nk_deputado", "cod_documento", "cod_lote", "parcela"], "_ingested_at"
    ).drop("_ingested_at")
    key = hash_key(
        "nk_deputado",
        "cnpj_cpf_fornecedor",
        "data_documento",
        money("valor_liquido"),
        "cod_documento",
        "num_documento",
        "cod_lote",
    )
    return newest.select(
        key.alias("nk_despesa"),
        "*",
        F.col("data_documento").alias("data_despesa"),
        *date_parts(
            "data_documento",
            {"year": "ano_despesa", "month": "mes_despesa", "iso_week": "semana_despesa"},
        ),
    )


def dim_fornecedor(despesas: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Suppliers by cleaned tax id, or by name where there is none."""
    clean = "cnpj_cpf_fornecedor_limpo"
    suppliers = despesas.select(
        tax_id_or_name(clean, "nome_fornecedor").alias("nk_fornecedor"),
        "cnpj_cpf_fornecedor",
        clean,
        "nome_fornecedor",
        party_kind(clean).alias("tipo_pessoa"),
    )
    return stable_key(dedupe(suppliers, "nk_fornecedor"), existing, "nk_fornecedor", "sk_fornecedor")


def dim_categoria_despesa(despesas: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Expense categories."""
    names = despesas.select(F.col("tipo_despesa").alias("nk_categoria_despesa")).distinct()
    return stable_key(names, existing, "nk_categoria_despesa", "sk_categoria_despesa")


def dim_cpi(bronze_orgaos: DataFrame, bronze_detalhe: DataFrame, as_of: dt.date) -> DataFrame:
    """Committees of inquiry with the dates of their detail record, open or closed on ``as_of``."""
    newest = dedupe(
        typed_select(
            bronze_orgaos,
            [
                ("id", "nk_cpi", "bigint"),
                ("sigla", "sigla", "string"),
                ("nome", "nome_cpi", "string"),
                ("codTipoOrgao", "cod_tipo_orgao", "int"),
                ("tipoOrgao", "tipo_orgao", "string"),
                INGESTED,
            ],
        ),
        "nk_cpi",
        "bronze_ingested_at",
    ).filter(F.col("cod_tipo_orgao") == S.INQUIRY_TYPE)
    detail = dedupe(
        typed_select(
            bronze_detalhe,
            [
                ("id_orgao", "_id_orgao", "bigint"),
                (parse_date("dataInicio"), "data_inicio", "date"),
                (parse_date("dataInstalacao"), "data_instalacao", "date"),
                (parse_date("dataFim"), "data_fim", "date"),
                (parse_date("dataFimOriginal"), "data_fim_original", "date"),
                ("urlWebsite", "url_website", "string"),
                ("uri", "uri_orgao", "string"),
                INGESTED,
            ],
        ),
        "_id_orgao",
        "bronze_ingested_at",
    )
    attributes = [
        "data_inicio",
        "data_instalacao",
        "data_fim",
        "data_fim_original",
        "url_website",
        "uri_orgao",
    ]
    joined = star_join(newest, Dim(detail, [("nk_cpi", "_id_orgao")], attributes, "left"))
    return joined.select(
        "nk_cpi",
        "nome_cpi",
        "sigla",
        "tipo_orgao",
        *attributes,
        open_status("data_fim", as_of).alias("status_cpi"),
    )


def dim_votos_votacoes(bronze_votos: DataFrame, bronze_votacoes: DataFrame) -> DataFrame:
    """Votes with the ballot they belong to, keyed by hash of (ballot, member)."""
    votes = typed_select(
        bronze_votos,
        [
            ("id_votacao", "id_votacao", "string"),
            ("deputado_.id", "nk_deputado", "bigint"),
            ("tipoVoto", "voto", "string"),
            ("dataRegistroVoto", "data_voto", "timestamp"),
            INGESTED,
        ],
    )
    # a vote without voter equals no other; its key counts it within its ballot
    votes = newest_per_key(votes, ["id_votacao", "nk_deputado"], "bronze_ingested_at", False)
    place = Window.partitionBy("id_votacao").orderBy(*tie_break(votes, ["id_votacao", "nk_deputado"]))
    loose = votes.filter(F.col("nk_deputado").isNull()).withColumn("_nth", F.row_number().over(place))
    known = votes.filter(F.col("nk_deputado").isNotNull()).withColumn("_nth", F.lit(None).cast("int"))
    votes = known.unionByName(loose)
    ballots = bronze_votacoes.select(
        F.col("id").alias("_id"),
        trailing_id("uriEvento").alias("id_evento"),
        F.col("aprovacao").alias("resultado_votacao"),
        F.col("descricao").alias("descricao_votacao"),
        F.col("siglaOrgao").alias("sigla_orgao"),
        F.col("ingested_at").alias("_ingested_at"),
    )
    ballots = dedupe(ballots, "_id", "_ingested_at")
    attributes = ["id_evento", "resultado_votacao", "descricao_votacao", "sigla_orgao"]
    joined = star_join(votes, Dim(ballots, [("id_votacao", "_id")], attributes, "left"))
    return joined.select(
        F.when(F.col("_nth").isNull(), hash_key("id_votacao", "nk_deputado"))
        .otherwise(hash_key("id_votacao", "nk_deputado", "_nth"))
        .alias("nk_voto"),
        "id_votacao",
        "id_evento",
        "nk_deputado",
        "voto",
        "data_voto",
        "resultado_votacao",
        "descricao_votacao",
        "sigla_orgao",
        *date_parts("data_voto", {"year": "ano_voto", "month": "mes_voto"}),
    )
