"""Landed records and calendar settings of the legislative marts."""

from __future__ import annotations

import datetime as dt

from martloom.operators.calendar import Period

# Fields of the landed records, as DDL.
PERSON = (
    "id bigint, uri string, nome string, siglaPartido string, uriPartido string, "
    "siglaUf string, idLegislatura bigint, urlFoto string, email string"
)
DEPUTADOS = PERSON
FRENTES = (
    "id bigint, uri string, titulo string, idLegislatura bigint, dataCriacao string, "
    "dataExtincao string"
)
FRENTES_MEMBROS = f"{PERSON}, titulo string, codTitulo bigint, dataInicio string, dataFim string"
EVENTOS = (
    "id bigint, uri string, dataHoraInicio string, dataHoraFim string, situacao string, "
    "descricaoTipo string, descricao string, localExterno string, orgaos string, "
    "localCamara string, urlRegistro string"
)
EVENTOS_PRESENCA = PERSON
TIPO_EVENTO = "cod string, sigla string, nome string, descricao string"
DESPESAS = (
    "ano int, mes int, tipoDespesa string, codDocumento bigint, tipoDocumento string, "
    "codTipoDocumento int, dataDocumento string, numDocumento string, valorDocumento double, "
    "urlDocumento string, nomeFornecedor string, cnpjCpfFornecedor string, valorLiquido double, "
    "valorGlosa double, numRessarcimento string, codLote bigint, parcela int"
)
ORGAOS = (
    "id string, sigla string, nome string, apelido string, nomePublicacao string, "
    "nomeResumido string, tipoOrgao string, codTipoOrgao string, uri string"
)
ORGAOS_DETALHE = (
    "apelido string, casa string, codTipoOrgao string, dataFim string, dataFimOriginal string, "
    "dataInicio string, dataInstalacao string, id string, nome string, nomePublicacao string, "
    "nomeResumido string, sala string, sigla string, tipoOrgao string, uri string, "
    "urlWebsite string"
)
VOTACOES = (
    "id string, uri string, data string, dataHoraRegistro string, siglaOrgao string, "
    "uriOrgao string, uriEvento string, proposicaoObjeto string, uriProposicaoObjeto string, "
    "descricao string, aprovacao int"
)
VOTOS = (
    "dataRegistroVoto string, tipoVoto string, "
    "deputado_ struct<id: bigint, uri: string, nome: string, siglaPartido: string, "
    "uriPartido: string, siglaUf: string, idLegislatura: bigint, urlFoto: string, email: string>"
)
EVENT_COMMITTEES = (
    "array<struct<id: bigint, uri: string, sigla: string, nome: string, apelido: string, "
    "codTipoOrgao: int, tipoOrgao: string, nomePublicacao: string, nomeResumido: string>>"
)
EVENT_PLACE = "struct<nome: string, predio: string, sala: string, andar: string>"

# Election period, committee type, kinds of vote.
ELECTION_PERIODS = [
    Period(dt.date(2026, 8, 1), dt.date(2026, 10, 31), "Período eleitoral 2026")
]
OUTSIDE_PERIODS = "Fora do período eleitoral"
INQUIRY_TYPE = 4
VOTE_KINDS = {
    "qtd_votos_sim": "SIM",
    "qtd_votos_nao": "NÃO",
    "qtd_abstencoes": "ABSTENÇÃO",
    "qtd_obstrucoes": "OBSTRUÇÃO",
    "qtd_art17": "ART. 17",
    "qtd_liberado": "LIBERADO",
}
