"""Landed files to marts, twice, over a small made-up legislature."""

import datetime as dt
import json
import random

import pytest

from martloom.plans.legislative.build import (
    Layers,
    build_bronze,
    build_gold,
    build_silver,
    sources_without_children,
)
from martloom.plans.legislative.silver import dim_deputado_history
from tests.conftest import rows

LAYERS = Layers("leg_bronze", "leg_silver", "leg_gold", "leg_audit")
FIRST = dt.datetime(2024, 5, 1, 6, 0)
SECOND = dt.datetime(2024, 6, 1, 6, 0)
PARTIES = ["AA", "BB", "CC"]


def person(i, party):
    return {
        "id": i, "uri": f"/deputados/{i}", "nome": f"Member {i}", "siglaPartido": party,
        "uriPartido": f"/api/partidos/{PARTIES.index(party) + 100}", "siglaUf": "XY"[i % 2],
        "idLegislatura": 57, "urlFoto": None, "email": f"m{i}@x",
    }


class Landing:
    def __init__(self, root):
        self.root = root

    def put(self, path, records):
        file = self.root / path
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(records if isinstance(records, str) else json.dumps({"dados": records}))

    def paths(self):
        glob = {
            "bronze_deputados": "deputados.json",
            "bronze_frentes": "frentes.json",
            "bronze_frentes_membros": "frentes/*/membros.json",
            "bronze_eventos": "eventos.json",
            "bronze_eventos_presenca": "eventos/*/deputados.json",
            "bronze_tipo_evento": "tipos.json",
            "bronze_despesas": "deputados/*/despesas/*.json",
            "bronze_orgaos": "orgaos.json",
            "bronze_orgaos_detalhe": "orgaos/*/detalhe.json",
            "bronze_votacoes": "votacoes.json",
            "bronze_votacoes_votos": "votacoes/*/votos.json",
        }
        return {name: f"{self.root}/{g}" for name, g in glob.items()}


def land(root, members, seed=1):
    """``members`` maps id to party."""
    rng = random.Random(seed)
    box = Landing(root)
    box.put("deputados.json", [person(i, p) for i, p in members.items()])
    box.put("frentes.json", [{"id": f, "titulo": f"Caucus {f}", "idLegislatura": 57, "uri": f"/f/{f}"} for f in (1, 2, 3)])
    for f in (1, 2):
        box.put(f"frentes/{f}/membros.json", [
            {**person(i, "AA"), "dataInicio": None} for i in members if i % f == 0
        ] + [{**person(999, "AA"), "nome": "Unknown", "dataInicio": None}])
    box.put("frentes/3/membros.json", [])
    box.put("tipos.json", [
        {"cod": "10", "sigla": "S", "nome": "Session", "descricao": None},
        {"cod": "20", "sigla": "H", "nome": "Hearing ", "descricao": "Public hearing"},
    ])
    box.put("eventos.json", [
        {
            "id": e, "uri": f"/e/{e}", "dataHoraInicio": f"2024-0{1 + e % 6}-1{e % 9}T10:00", "dataHoraFim": "",
            "situacao": "done", "descricaoTipo": ["  session", "HEARING", "Other"][e % 3], "descricao": f"ev {e}",
            "orgaos": [{"id": 50 + e % 2, "sigla": "C", "nome": f"Com {e % 2}"}, {"sigla": "no id"}],
            "localCamara": {"nome": "Hall", "predio": None, "sala": "1", "andar": "2"},
        }
        for e in range(1, 13)
    ])
    for e in range(1, 12):
        box.put(f"eventos/{e}/deputados.json", [person(i, p) for i, p in members.items() if rng.random() < 0.7])
    box.put("votacoes.json", [
        {"id": f"v-{b}", "uriEvento": f"/api/eventos/{b}" if b % 2 else "/api/eventos/", "descricao": f"Ballot {b}",
         "siglaOrgao": "PLEN", "aprovacao": 1} for b in range(1, 7)
    ])
    for b in range(1, 6):
        box.put(f"votacoes/v-{b}/votos.json", [
            {"dataRegistroVoto": f"2024-03-0{b}T11:12:13", "tipoVoto": rng.choice(["Sim", "Não", "Obstrução"]),
             "deputado_": person(i, p)} for i, p in members.items()
        ])
    for i in members:
        box.put(f"deputados/{i}/despesas/2024.json", [
            {
                "ano": 2024, "mes": 1 + n % 3, "tipoDespesa": ["Fuel", "Rent"][n % 2], "codDocumento": i * 100 + n // 2,
                "tipoDocumento": "Nota", "codTipoDocumento": 0, "dataDocumento": f"2024-0{1 + n % 3}-05T00:00:00",
                "numDocumento": str(n // 2), "valorDocumento": 10.5 * (n + 1), "valorLiquido": 10.5 * (n + 1) + i,
                "valorGlosa": 0.0, "nomeFornecedor": f"Shop {n % 3}",
                "cnpjCpfFornecedor": ["12.345.678/0001-90", "123.456.789-01", ""][n % 3], "codLote": 1, "parcela": n % 2,
            }
            for n in range(6)
        ])
    box.put("orgaos.json", [
        {"id": "70", "sigla": "CPI1", "nome": "Inquiry 1", "codTipoOrgao": "4", "tipoOrgao": "CPI"},
        {"id": "71", "sigla": "CPI2", "nome": "Inquiry 2", "codTipoOrgao": "4", "tipoOrgao": "CPI"},
        {"id": "72", "sigla": "COM", "nome": "Plain", "codTipoOrgao": "2", "tipoOrgao": "Com"},
    ])
    box.put("orgaos/70/detalhe.json", '{"dados": {"id": 70, "dataInicio": "2023-01-01", "dataFim": "2023-12-31", "urlWebsite": "w"}}')
    box.put("orgaos/72/detalhe.json", '{"dados": {"id": 72}}')
    return box


def run(spark, box, batch, as_of):
    return (
        build_bronze(spark, box.paths(), batch, as_of, LAYERS, buckets=3),
        build_silver(spark, as_of, LAYERS, buckets=3),
        build_gold(spark, as_of, LAYERS),
    )


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """All layers after a first run; then a rerun; then a run with changed members."""
    LAYERS.create(spark)
    state = {}

    def remember(step):
        for db in (LAYERS.silver, LAYERS.gold):
            for t in spark.catalog.listTables(db):
                if "__v" not in t.name:
                    df = spark.table(f"{db}.{t.name}")
                    plain = df.drop("updated_at", "bronze_ingested_at", "valid_from")
                    state[step, t.name] = [r.asDict() for r in plain.collect()]

    first = land(tmp_path_factory.mktemp("first"), {i: PARTIES[i % 3] for i in range(1, 9)})
    first.put("frentes.json", json.dumps({"dados": [
        {"id": f, "titulo": f"Caucus {f}", "idLegislatura": 57, "uri": f"/f/{f}"} for f in (1, 2, 3)
    ] + [{"titulo": "no id"}]}))
    state["report", "first"] = run(spark, first, "b1", FIRST)
    remember("first")
    state["report", "again"] = run(spark, first, "b2", FIRST)
    remember("again")
    # member 1 is gone, member 2 changed party, member 0 is new and sorts first
    changed = {0: "AA", 2: "AA", **{i: PARTIES[i % 3] for i in range(3, 9)}}
    run(spark, land(tmp_path_factory.mktemp("second"), changed), "b3", SECOND)
    remember("second")
    yield state
    for db in (LAYERS.bronze, LAYERS.silver, LAYERS.gold, LAYERS.audit):
        spark.sql(f"DROP DATABASE {db} CASCADE")


def table(built, step, name):
    return built[step, name]


def canonical(records):
    return sorted(json.dumps(r, default=str, sort_keys=True) for r in records)


def test_rerun_changes_nothing(built):
    names = {n for s, n in built if s == "first"}
    assert len(names) >= 28
    for name in names:
        assert canonical(table(built, "first", name)) == canonical(table(built, "again", name)), name


def test_reports_count_what_was_read_and_lost(built):
    bronze, silver, gold = built["report", "first"]
    assert bronze["bronze_frentes"] == {"files": 1, "rows": 4, "rejected": 1}
    assert bronze["bronze_despesas"]["rows"] == 48 and bronze["bronze_despesas"]["rejected"] == 0
    assert silver["despesas"]["rows"] == 48 and silver["despesas"]["data_documento"] == 0
    assert silver["without_children"]["bronze_votacoes"] == 1
    assert gold["fat_despesas"] == {"rows": 48, "kept": 48, "deputado": 0, "categoria": 0, "fornecedor": 0}
    again = built["report", "again"][0]
    assert again["bronze_despesas"] == {"files": 0, "rows": 0, "rejected": 0}
    assert again["bronze_orgaos"]["files"] == 1  # no key, so it is replaced as a whole


def test_history_follows_members(built):
    parties = {(r["nk_deputado"], r["sigla_partido"], r["is_current"]) for r in table(built, "second", "dim_deputado_history")}
    assert {(2, "CC", False), (2, "AA", True), (0, "AA", True), (1, "BB", True)} <= parties


def test_surrogate_keys_survive_changes(built):
    before = {r["nk_deputado"]: r["sk_deputado"] for r in table(built, "first", "dim_deputado")}
    after = {r["nk_deputado"]: r["sk_deputado"] for r in table(built, "second", "dim_deputado")}
    assert {k: after[k] for k in before} == before
    assert after[0] == len(before) + 1
    parties = {r["nk_deputado"]: r["sigla_partido"] for r in table(built, "second", "dim_deputado")}
    assert parties[2] == "AA" and parties[0] == "AA" and 1 in parties


def test_instalments_of_a_document_are_kept(built):
    spent = table(built, "first", "despesas")
    assert len(spent) == 8 * 6
    assert len(table(built, "first", "fat_despesas")) == 8 * 6


def test_suppliers_and_kinds(built):
    got = {(r["nk_fornecedor"], r["tipo_pessoa"]) for r in table(built, "first", "dim_fornecedor")}
    assert got == {("12345678000190", "PJ"), ("12345678901", "PF"), ("Shop 2", "NAO_IDENTIFICADO")}


def test_event_types_match_on_normalised_names(built):
    kinds = {r["nk_evento"]: r["cod_tipo_evento"] for r in table(built, "first", "dim_evento")}
    assert {kinds[e] for e in (3, 6, 9, 12)} == {10}
    assert {kinds[e] for e in (1, 4, 7, 10)} == {20}
    assert {kinds[e] for e in (2, 5, 8, 11)} == {None}
    described = {r["cod_tipo_evento"]: r["descricao_tipo_evento"] for r in table(built, "first", "dim_tipo_evento")}
    assert described == {10: "Session", 20: "Public hearing"}


def test_committees_come_from_events(built):
    assert {r["nk_orgao"] for r in table(built, "first", "dim_orgao")} == {50, 51}
    bridge = table(built, "first", "bridge_evento_orgao")
    assert len(bridge) == 24 and sum(r["nk_orgao"] is None for r in bridge) == 12
    # inner joins drop committees without id and events without type
    assert len(table(built, "first", "eventos")) == 8


def test_unknown_member_stays_in_bridge_but_not_in_roster(built):
    lost = [r for r in table(built, "first", "bridge_frente_deputado") if r["nk_deputado"] == 999]
    assert len(lost) == 2 and all(r["sk_deputado"] is None and r["nome_deputado"] == "Unknown" for r in lost)
    assert all(r["nk_deputado"] != 999 for r in table(built, "first", "gold_frentes_membros"))


def test_votes_refer_to_events_when_the_uri_has_one(built):
    events = {r["id_votacao"]: r["id_evento"] for r in table(built, "first", "dim_votos_votacoes")}
    assert events == {"v-1": 1, "v-2": None, "v-3": 3, "v-4": None, "v-5": 5}


def test_inquiries(built):
    got = {(r["nk_cpi"], r["status_cpi"], r["possui_data_inicio"], r["possui_data_fim"])
           for r in table(built, "first", "gold_cpis")}
    assert got == {(70, "Encerrada", "Sim", "Sim"), (71, "Em andamento", "Não", "Não")}


def test_alignment_against_python(built):
    seats = [(r["nk_frente"], r["nk_deputado"]) for r in table(built, "first", "bridge_frente_deputado")]
    cast = [(r["nk_deputado"], r["id_votacao"], r["voto"]) for r in table(built, "first", "dim_votos_votacoes")]
    counted = {}
    for caucus, member in seats:
        for who, ballot, vote in cast:
            if who == member:
                hist = counted.setdefault((caucus, ballot), {})
                hist[vote] = hist.get(vote, 0) + 1
    want = {
        k: (sorted(h.items(), key=lambda i: (-i[1], i[0]))[0][1], sum(h.values())) for k, h in counted.items()
    }
    got = {
        (r["nk_frente"], r["id_votacao"]): (r["deputados_alinhados"], r["total_deputados"])
        for r in table(built, "first", "gold_frentes_votacoes")
    }
    assert got == want
    assert {r["source_layer"] for r in table(built, "first", "gold_frentes_votacoes")} == {"silver"}


def test_cohesion_has_a_table_of_its_own(built):
    assert {r["nk_frente"] for r in table(built, "first", "gold_frentes_alinhamento")} == {1, 2}
    assert "nome_deputado" in table(built, "first", "gold_frentes_membros")[0]


def test_engagement_and_attendance_are_consistent(built):
    scores = table(built, "first", "gold_engajamento_deputado")
    assert len(scores) == 8 and max(r["percentil_engajamento"] for r in scores) <= 1
    assert min(r["ranking_engajamento"] for r in scores) == 1
    assert sum(r["qtd_deputados"] for r in table(built, "first", "gold_engajamento_partido")) == 8
    assert all(0 < r["taxa_participacao"] <= 1 for r in table(built, "first", "taxa_presenca_evento"))


def test_bad_records_are_audited_and_gaps_reported(spark, built):
    bad = spark.table(f"{LAYERS.audit}.erros_api").filter("batch_id = 'b1'")
    assert rows(bad, "pipeline", "tipo_erro") == [("bronze_frentes", "missing_id")]
    gaps = rows(sources_without_children(spark, LAYERS), "parent", "id")
    assert ("bronze_eventos", "12") in gaps and ("bronze_votacoes", "v-6") in gaps
    assert ("bronze_frentes", "3") in gaps and ("bronze_orgaos", "71") in gaps


def test_history_of_members(spark, tmp_path):
    def bronze(members, at):
        people = [person(i, p) for i, p in members.items()]
        df = spark.createDataFrame(
            [tuple(p.values()) for p in people],
            "id bigint, uri string, nome string, siglaPartido string, uriPartido string, siglaUf string, "
            "idLegislatura bigint, urlFoto string, email string",
        )
        return df.selectExpr("*", f"timestamp'{at}' AS ingested_at")

    h = dim_deputado_history(bronze({1: "AA", 2: "BB"}, FIRST), FIRST.date())
    h = dim_deputado_history(bronze({1: "CC", 2: "BB", 3: "AA"}, SECOND), SECOND.date(), h)
    got = rows(h, "nk_deputado", "sk_deputado", "sigla_partido", "valid_from", "valid_to", "is_current")
    a, b = FIRST.date(), SECOND.date()
    assert got == [
        (1, 1, "AA", a, b, False), (1, 1, "CC", b, None, True), (2, 2, "BB", a, None, True), (3, 3, "AA", b, None, True),
    ]
