"""Landed files -> bronze -> silver -> gold, in the order the tables depend on."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martloom.operators.calendar import Period
from martloom.operators.history import VALIDITY
from martloom.plans.legislative import bronze as B
from martloom.plans.legislative import gold as G
from martloom.plans.legislative import schemas as S
from martloom.plans.legislative import silver as L
from martloom.session import checkpointed, release
from martloom.sinks import error_rows, future_view, load, load_bucketed, load_history, load_indexed
from martloom.sinks import quarantine, replace, split_once, stamp
from martloom.sinks.keyed import BUCKETS
from martloom.sources import judge, read_landed_pages
from martloom.sources.ledger import landed_files, paths_of, record, unread


@dataclass(frozen=True)
class Layers:
    """Databases of the four layers."""

    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    audit: str = "audit"

    def create(self, spark: SparkSession) -> None:
        for name in (self.bronze, self.silver, self.gold, self.audit):
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def build_bronze(
    spark: SparkSession,
    landing: dict[str, str],
    batch_id: str,
    as_of: dt.datetime | None = None,
    layers: Layers = Layers(),
    version: str = "1.0",
    buckets: int = BUCKETS,
) -> dict[str, dict[str, int]]:
    """Load the new landed files of each bronze table (name -> path).

    Records that cannot be decoded or lack their key go to the audit table
    before the others are loaded. Returns per table the files opened, their records, and how many were rejected.
    ``buckets`` is the number of partitions by key of tables that have no business date.
    """
    known = B.tables()
    errors, ledger = f"{layers.audit}.erros_api", f"{layers.audit}.arquivos_lidos"
    report = {}
    for name, path in landing.items():
        table = known[name]
        target = f"{layers.bronze}.{name}"
        files = landed_files(spark, path)
        # a table without key is replaced by all that is landed, the others by what is new
        new = unread(files, ledger, name) if table.keys and spark.catalog.tableExists(target) else checkpointed(files)
        if new.isEmpty() and spark.catalog.tableExists(target):
            report[name] = {"files": 0, "rows": 0, "rejected": 0}
            continue
        paths = paths_of(new)
        records = read_landed_pages(spark, paths or path, table.path_keys)
        seen = Observation()
        judged = judge(records, "raw_payload", table.ddl, table.required, list(table.path_keys))
        good, bad = split_once(judged, seen)
        quarantine(
            error_rows(
                bad, "source_file", "source_file", "raw_payload", name, batch_id, version, as_of
            ),
            errors,
        )
        rows = B.bronze(good, table, batch_id, version, as_of)
        options = {"newest_by": "ingested_at", "null_safe": table.optional, "buckets": buckets}
        if not table.keys:
            replace(rows, target)
        elif table.business_date:
            load_indexed(rows, target, table.keys, table.business_date, **options)
        else:
            load_bucketed(rows, target, table.keys, **options)
        release(good, bad)  # all that was derived from them is written
        record(new, ledger, name, batch_id)
        report[name] = {"files": len(paths), **seen.get}
    return report


def build_silver(
    spark: SparkSession,
    as_of: dt.datetime,
    layers: Layers = Layers(),
    version: str = "1.0",
    periods: list[Period] = S.ELECTION_PERIODS,
    buckets: int = BUCKETS,
) -> dict[str, dict[str, int]]:
    """Dimensions first, then the bridges and facts that need their keys.

    The calendar spans the days of the events, so no event falls outside it. Returns the values that the typed
    expenses lost, by column, and the parents whose children were never landed.
    """
    day = as_of.date()
    lost = Observation()

    def bronze(name: str) -> DataFrame:
        return spark.table(f"{layers.bronze}.{name}")

    def silver(name: str) -> DataFrame:
        return spark.table(f"{layers.silver}.{name}")

    def existing(name: str) -> DataFrame | None:
        full = f"{layers.silver}.{name}"
        return spark.table(full) if spark.catalog.tableExists(full) else None

    def keep(name: str, df: DataFrame, keys: list[str], partition_by: list[str] = ()) -> None:
        stamped, full = stamp(df, version, as_of), f"{layers.silver}.{name}"
        if partition_by:
            load(stamped, full, keys, partition_by=partition_by, null_safe=True)
        else:
            load_bucketed(stamped, full, keys, buckets, null_safe=True)

    def rebuild(name: str, df: DataFrame) -> None:
        replace(stamp(df, version, as_of), f"{layers.silver}.{name}")

    keep(
        "dim_deputado",
        L.dim_deputado(bronze("bronze_deputados"), day, existing("dim_deputado")),
        ["nk_deputado"],
    )
    load_history(
        silver("dim_deputado").drop(*VALIDITY),
        f"{layers.silver}.dim_deputado_history",
        "nk_deputado",
        ["sigla_partido", "sigla_uf", "id_legislatura"],
        day,
    )
    keep("dim_frente", L.dim_frente(bronze("bronze_frentes"), existing("dim_frente")), ["nk_frente"])
    keep(
        "dim_tipo_evento",
        L.dim_tipo_evento(bronze("bronze_tipo_evento"), existing("dim_tipo_evento")),
        ["cod_tipo_evento"],
    )
    keep(
        "dim_evento",
        L.dim_evento(bronze("bronze_eventos"), silver("dim_tipo_evento"), existing("dim_evento")),
        ["nk_evento"],
    )
    keep("dim_orgao", L.dim_orgao(silver("dim_evento"), existing("dim_orgao")), ["nk_orgao"])
    rebuild("bridge_evento_orgao", L.bridge_evento_orgao(silver("dim_evento"), silver("dim_orgao")))
    rebuild(
        "bridge_frente_deputado",
        L.bridge_frente_deputado(
            bronze("bronze_frentes_membros"), silver("dim_frente"), silver("dim_deputado")
        ),
    )
    rebuild("dim_data", L.dim_data(silver("dim_evento"), "data_evento", periods))
    keep(
        "despesas",
        L.despesas(bronze("bronze_despesas"), lost),
        ["nk_despesa", "parcela"],
        partition_by=["ano_mes"],
    )
    keep(
        "dim_fornecedor",
        L.dim_fornecedor(silver("despesas"), existing("dim_fornecedor")),
        ["nk_fornecedor"],
    )
    keep(
        "dim_categoria_despesa",
        L.dim_categoria_despesa(silver("despesas"), existing("dim_categoria_despesa")),
        ["nk_categoria_despesa"],
    )
    rebuild("dim_cpi", L.dim_cpi(bronze("bronze_orgaos"), bronze("bronze_orgaos_detalhe"), day))
    keep(
        "dim_votos_votacoes",
        L.dim_votos_votacoes(bronze("bronze_votacoes_votos"), bronze("bronze_votacoes")),
        ["nk_voto"],
        partition_by=["ano_voto", "mes_voto"],
    )
    gaps = sources_without_children(spark, layers).groupBy("parent").count().collect()  # five parents
    return {"despesas": lost.get, "without_children": {r["parent"]: r["count"] for r in gaps}}


def build_gold(
    spark: SparkSession,
    as_of: dt.datetime,
    layers: Layers = Layers(),
    version: str = "1.0",
    source_system: str = "landed_json",
) -> dict[str, dict[str, int]]:
    """Every mart is rebuilt from silver and from marts built before it.

    Marts that readers rank or scan by a column are stored in its order. Returns the expenses that found no
    member, category or supplier and are not in their fact.
    """
    lost = Observation()

    def silver(name: str) -> DataFrame:
        return spark.table(f"{layers.silver}.{name}")

    def gold(name: str) -> DataFrame:
        return spark.table(f"{layers.gold}.{name}")

    def rebuild(
        name: str, df: DataFrame, partition_by: str | tuple = (), order_by: str | Column | list = (), **source
    ) -> None:
        stamped = stamp(df, version, as_of, **source)
        replace(stamped, f"{layers.gold}.{name}", partition_by=partition_by, order_by=order_by)

    presence = spark.table(f"{layers.bronze}.bronze_eventos_presenca")
    member, caucus = silver("dim_deputado"), silver("dim_frente")
    event, kind, days = silver("dim_evento"), silver("dim_tipo_evento"), silver("dim_data")
    seats, votes = silver("bridge_frente_deputado"), silver("dim_votos_votacoes")

    rebuild("gold_frentes_membros", G.frentes_membros(seats, caucus, member))
    rebuild("gold_ihh_frentes", G.ihh_frentes(gold("gold_frentes_membros"), caucus), order_by="ihh")
    rebuild("gold_ranking_deputados", G.ranking_deputados(gold("gold_frentes_membros")))
    rebuild(
        "eventos",
        G.eventos(event, silver("bridge_evento_orgao"), silver("dim_orgao"), kind, days),
    )
    future_view(spark, f"{layers.gold}.vw_eventos_futuros", f"{layers.gold}.eventos", "data_evento")
    rebuild("densidade_eventos_semana", G.densidade_eventos_semana(days, event))
    rebuild(
        "taxa_presenca_evento",
        G.taxa_presenca_evento(presence, event, kind, member),
        order_by=F.col("taxa_participacao").desc(),
    )
    rebuild(
        "comparativo_periodo_eleitoral",
        G.comparativo_periodo_eleitoral(gold("eventos"), days),
        order_by=["ano", "descricao_tipo_evento", "periodo_eleitoral"],
    )
    rebuild(
        "fat_despesas",
        G.fat_despesas(
            silver("despesas"), member, silver("dim_fornecedor"), silver("dim_categoria_despesa"), lost
        ),
        partition_by="ano_mes",
    )
    rebuild(
        "top_gastos_partido",
        G.top_gastos_partido(gold("fat_despesas")),
        order_by=["ano_mes", "ranking_gasto_partido"],
    )
    rebuild(
        "anomalias_despesas",
        G.anomalias_despesas(gold("fat_despesas"), silver("dim_categoria_despesa"), member),
        order_by=F.col("z_score").desc(),
    )
    rebuild(
        "gold_frentes_votacoes",
        G.frentes_votacoes(seats, caucus, votes),
        layer="silver",
        system=source_system,
    )
    rebuild("gold_frentes_alinhamento", G.frentes_alinhamento(gold("gold_frentes_votacoes")))
    rebuild("gold_engajamento_deputado", G.engajamento_deputado(member, presence, votes))
    rebuild("gold_engajamento_partido", G.engajamento_partido(gold("gold_engajamento_deputado")))
    rebuild("gold_cpis", G.cpis(silver("dim_cpi")))
    found = lost.get
    names = ("deputado", "categoria", "fornecedor")
    return {"fat_despesas": {"rows": found["rows"], "kept": found["kept"], **{n: found[f"lost_{i}"] for i, n in enumerate(names)}}}


def sources_without_children(spark: SparkSession, layers: Layers = Layers()) -> DataFrame:
    """Events, ballots and caucuses for which no attendance, vote or member has been landed."""
    from martloom.operators import parents_without_children

    def missing(parent: str, child: str, key: str) -> DataFrame:
        gaps = parents_without_children(
            spark.table(f"{layers.bronze}.{parent}").select(F.col("id").cast("string")),
            spark.table(f"{layers.bronze}.{child}").select(F.col(key).cast("string").alias(key)),
            {"id": key},
        )
        return gaps.select(F.lit(parent).alias("parent"), F.lit(child).alias("child"), "id")

    return (
        missing("bronze_eventos", "bronze_eventos_presenca", "id_evento")
        .unionByName(missing("bronze_votacoes", "bronze_votacoes_votos", "id_votacao"))
        .unionByName(missing("bronze_frentes", "bronze_frentes_membros", "id_frente"))
        .unionByName(missing("bronze_deputados", "bronze_despesas", "nk_deputado"))
        .unionByName(missing("bronze_orgaos", "bronze_orgaos_detalhe", "id_orgao"))
    )
