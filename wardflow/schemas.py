"""Schemas of the reference data model, with column comments as field metadata."""

from __future__ import annotations

from pyspark.sql import types as T


def _field(name: str, kind: T.DataType, nullable: bool = False, comment: str = "") -> T.StructField:
    return T.StructField(name, kind, nullable, {"comment": comment} if comment else None)


HOSPITALS = T.StructType([
    _field("id_hospital", T.IntegerType(), comment="chave primaria"),
    _field("nome_hospital", T.StringType(), comment="nome, nao unico"),
    _field("especialidade", T.StringType()),
    _field("cidade", T.StringType()),
    _field("endereco", T.StringType()),
    _field("bairro", T.StringType()),
    _field("estado", T.StringType(), comment="sigla de duas letras"),
    _field("regiao", T.StringType()),
    _field("qtd_leitos", T.IntegerType()),
    _field("qtd_medicos", T.IntegerType()),
    _field("horario_funcionamento", T.StringType()),
    _field("descricao_servicos", T.StringType()),
])

PATIENTS = T.StructType([
    _field("id_paciente", T.IntegerType(), comment="chave primaria"),
    _field("nome_paciente", T.StringType()),
    _field("data_nascimento", T.DateType()),
    _field("idade", T.IntegerType(), comment="anos completos na data de referencia"),
    _field("sexo", T.StringType()),
    _field("estado_civil", T.StringType()),
    _field("cpf", T.StringType(), comment="dado pessoal"),
    _field("cns", T.StringType(), comment="dado pessoal"),
    _field("rg", T.StringType(), comment="dado pessoal"),
    _field("email", T.StringType(), comment="dado pessoal"),
    _field("telefone", T.StringType(), comment="dado pessoal"),
    _field("convenio", T.StringType()),
])

VISITS = T.StructType([
    _field("id_consulta", T.IntegerType(), comment="chave primaria"),
    _field("id_paciente", T.IntegerType(), nullable=True, comment="pode faltar"),
    _field("id_hospital", T.IntegerType()),
    _field("id_medico", T.IntegerType()),
    _field("nome_medico", T.StringType()),
    _field("crm", T.StringType()),
    _field("modalidade", T.StringType()),
    _field("status", T.StringType()),
    _field("tempo_espera_minutos", T.IntegerType()),
    _field("cid_10", T.StringType(), nullable=True, comment="so em consultas finalizadas"),
    _field("diagnostico_descricao", T.StringType(), nullable=True),
    _field("procedimento_realizado", T.StringType(), nullable=True),
])

REVIEWS = T.StructType([
    _field("id_consulta", T.IntegerType()),
    _field("id_paciente", T.IntegerType(), nullable=True),
    _field("texto_avaliacao", T.StringType()),
    _field("data_avaliacao", T.DateType()),
    _field("canal_avaliacao", T.StringType()),
    _field("avaliacao_anonima", T.BooleanType()),
    _field("tempo_para_avaliar_min", T.IntegerType()),
])

SYMPTOM_VISITS = T.StructType([
    _field("id_consulta", T.IntegerType()),
    _field("id_paciente", T.IntegerType(), nullable=True),
    _field("id_hospital", T.IntegerType()),
    _field("especialidade", T.StringType()),
    _field("tempo_espera_minutos", T.IntegerType()),
    _field("status", T.StringType()),
    _field("sintomas_relatados", T.StringType(), nullable=True),
])

CODES = T.StructType([
    _field("especialidade", T.StringType()),
    _field("cid_10", T.StringType()),
    _field("diagnostico_descricao", T.StringType()),
])

WEIGHTS = T.StructType([
    _field("id_hospital", T.IntegerType()),
    _field("peso", T.IntegerType(), comment="inteiro positivo"),
])

LEXICON = T.StructType([
    _field("label", T.StringType()),
    _field("term", T.StringType()),
    _field("weight", T.DoubleType()),
])
