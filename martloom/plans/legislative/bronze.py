"""Landed pages -> typed, audited bronze rows."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.hashing import amount_text, hash_key
from martloom.plans.legislative import schemas as S
from martloom.sinks.audit import add_audit
from martloom.sources.landed import decode_json


@dataclass(frozen=True)
class BronzeTable:
    """How one kind of landed record becomes a bronze table.

    ``path_keys`` are parent ids found in the path of a landed file (``/votacoes/7/`` or ``/votacoes=7/``) and must be
    there, ``keys`` the upsert key; no key means each load replaces the table. NULL equals NULL
    only in the ``optional`` ones. Records without ``unkeyed`` have no key of their own and
    get one, ``id_registro``, from their file and place in it. ``business_date`` are columns that facts are partitioned by.
    """

    ddl: str
    keys: list[str] = field(default_factory=list)
    path_keys: dict[str, tuple[str, str]] = field(default_factory=dict)
    required: list[str] = field(default_factory=list)
    derived: dict[str, Column] = field(default_factory=dict)
    optional: list[str] = field(default_factory=list)
    unkeyed: str | None = None
    business_date: list[str] = field(default_factory=list)


def expense_key() -> Column:
    """Hash key of a landed expense; missing parts count as empty text."""
    return hash_key(
        "nk_deputado",
        "codDocumento",
        "numDocumento",
        F.date_format(F.col("dataDocumento").try_cast("timestamp"), "yyyy-MM-dd"),
        amount_text("valorLiquido"),
        "codLote",
    )


def tables() -> dict[str, BronzeTable]:
    return {
        "bronze_deputados": BronzeTable(S.DEPUTADOS, ["id"], required=["id"]),
        "bronze_frentes": BronzeTable(S.FRENTES, ["id"], required=["id"]),
        "bronze_frentes_membros": BronzeTable(
            S.FRENTES_MEMBROS,
            ["id_frente", "id", "dataInicio"],
            {"id_frente": (r"/frentes[/=](\d+)", "bigint")},
            ["id"],
            optional=["dataInicio"],
        ),
        "bronze_eventos": BronzeTable(S.EVENTOS, ["id"], required=["id"]),
        "bronze_eventos_presenca": BronzeTable(
            S.EVENTOS_PRESENCA,
            ["id_evento", "id"],
            {"id_evento": (r"/eventos[/=](\d+)", "bigint")},
            ["id"],
        ),
        "bronze_tipo_evento": BronzeTable(S.TIPO_EVENTO, required=["cod"]),
        "bronze_despesas": BronzeTable(
            S.DESPESAS,
            ["sk_despesa", "parcela"],
            {
                "nk_deputado": (r"/deputados[/=](\d+)", "bigint"),
                "ano_referencia": (r"/despesas[/=](\d{4})", "int"),
            },
            derived={"sk_despesa": expense_key()},
            optional=["parcela"],
            business_date=["ano", "mes"],
        ),
        "bronze_orgaos": BronzeTable(S.ORGAOS, required=["id"]),
        "bronze_orgaos_detalhe": BronzeTable(
            S.ORGAOS_DETALHE, path_keys={"id_orgao": (r"/orgaos[/=](\d+)", "string")}
        ),
        "bronze_votacoes": BronzeTable(S.VOTACOES, ["id"], required=["id"]),
        "bronze_votacoes_votos": BronzeTable(
            S.VOTOS,
            ["id_votacao", "id_deputado", "id_registro"],
            {"id_votacao": (r"/votacoes[/=]([^/]+)", "string")},
            derived={"id_deputado": F.col("deputado_.id")},
            optional=["id_deputado", "id_registro"],
            unkeyed="id_deputado",
        ),
    }


def bronze(
    records: DataFrame,
    table: BronzeTable,
    batch_id: str,
    version: str = "1.0",
    as_of: dt.datetime | None = None,
) -> DataFrame:
    """Decode records read with the table's ``path_keys`` and stamp them."""
    rows = decode_json(records, "raw_payload", table.ddl)
    rows = rows.withColumnRenamed("source_file", "source_endpoint_detail")
    if table.derived:
        rows = rows.withColumns(table.derived)
    if table.unkeyed:
        rows = _keyed_by_place(rows, table.unkeyed)
    return add_audit(rows, F.col("source_endpoint_detail"), batch_id, version, as_of)


def _keyed_by_place(rows: DataFrame, part: str) -> DataFrame:
    """``id_registro`` for records without ``part``: equal ones in a file are told apart by number."""
    file = F.col("source_endpoint_detail")
    place = Window.partitionBy(file).orderBy("raw_payload")
    loose = rows.filter(F.col(part).isNull()).withColumn("_nth", F.row_number().over(place))
    named = F.sha2(F.concat_ws("|", file, F.col("_nth").cast("string")), 256)
    keyed = rows.filter(F.col(part).isNotNull()).withColumn("id_registro", F.lit(None).cast("string"))
    return keyed.unionByName(loose.withColumn("id_registro", named).drop("_nth"))
