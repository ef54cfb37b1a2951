"""Declared columns of the raw tables, as they are stored."""

from __future__ import annotations

from pyspark.sql import types as T

_FILE = "_loaded_at timestamp, _source_file string, _reference_year int"
_URL = "_loaded_at timestamp, _source_url string"

# Column names and types of the raw tables.
RAW_SCHEMAS = {
    "raw_ibge.municipios": (
        "id_municipio int, nome_municipio string, id_microrregiao int, nome_microrregiao string,"
        " id_mesorregiao int, nome_mesorregiao string, id_uf int, sigla_uf string, nome_uf string,"
        f" id_regiao int, sigla_regiao string, nome_regiao string, {_URL}"
    ),
    "raw_ibge.populacao_estimada": (
        "id_municipio int, nome_municipio string, ano_referencia int, populacao_estimada bigint,"
        f" {_URL}"
    ),
    "raw_cnes.estabelecimentos": (
        "codigo_cnes string, cod_municipio_ibge6 string, tipo_pessoa string,"
        " nivel_dependencia string, tipo_unidade string, natureza_organizacao string,"
        " natureza_juridica string, atividade_ensino string, vinculo_sus string,"
        " tipo_gestao string, esfera_administrativa string, competencia string,"
        f" data_atualizacao string, {_FILE}, _reference_month int"
    ),
    "raw_cnes.equipes_aps": (
        "id_equipe string, codigo_cnes string, cod_municipio_ibge6 string,"
        " codigo_tipo_equipe string, nome_equipe string, competencia_ativacao string,"
        " competencia_desativacao string, motivo_desativacao string, tipo_desativacao string,"
        " competencia string, id_area string, nome_area string, id_segmento string,"
        f" descricao_segmento string, tipo_segmento string, {_FILE}, _reference_month int"
    ),
    "raw_cnes.estabelecimentos_detalhados": (
        "codigo_cnes string, nome_razao_social string, nome_fantasia string,"
        " codigo_tipo_unidade string, codigo_cep string, endereco string, numero_endereco string,"
        " bairro string, numero_telefone string, latitude decimal(12,8), longitude decimal(12,8),"
        " email string, descricao_turno_atendimento string,"
        " faz_atendimento_ambulatorial_sus string, descricao_esfera_administrativa string,"
        " codigo_motivo_desabilitacao string, possui_centro_cirurgico int,"
        " possui_centro_obstetrico int, possui_centro_neonatal int,"
        " possui_atendimento_hospitalar int, possui_servico_apoio int,"
        f" possui_atendimento_ambulatorial int, data_atualizacao string, {_URL}"
    ),
    "raw_cnes.rede_porte_municipio": (
        "cod_municipio_ibge6 string, competencia string, quantidade_estabelecimentos int,"
        " _loaded_at timestamp, _source_file string"
    ),
    "raw_sia.producao_ambulatorial": (
        "codigo_cnes_estabelecimento string, cod_municipio_ibge6_estabelecimento string,"
        " cod_municipio_ibge6_paciente string, competencia string, competencia_arquivo string,"
        " codigo_procedimento string, codigo_cbo string, carater_atendimento string,"
        " idade_paciente string, sexo_paciente string, raca_cor_paciente string,"
        " quantidade_produzida string, quantidade_aprovada string, valor_produzido string,"
        f" valor_aprovado string, origem_documento string, {_FILE}, _reference_month int"
    ),
    "raw_sih.internacoes": (
        "numero_aih string, codigo_cnes_estabelecimento string,"
        " cod_municipio_ibge6_estabelecimento string, cod_municipio_ibge6_paciente string,"
        " competencia string, codigo_procedimento string, codigo_cbo string,"
        " idade_paciente string, sexo_paciente string, raca_cor_paciente string,"
        " diagnostico_principal string, valor_total string, data_internacao string,"
        f" data_saida string, dias_permanencia string, indicador_obito string, {_FILE},"
        " _reference_month int"
    ),
    "raw_sim.obitos": (
        "origem_informacao string, codigo_cnes_estabelecimento string,"
        " cod_municipio_ibge6_ocorrencia string, cod_municipio_ibge6_residencia string,"
        " data_obito string, data_nascimento string, idade string, sexo string, raca_cor string,"
        " estado_civil string, escolaridade string, local_ocorrencia string,"
        f" causa_basica string, circunstancia_obito string, assistencia_medica string, {_FILE}"
    ),
    "raw_sinasc.nascidos_vivos": (
        "origem_informacao string, codigo_cnes_estabelecimento string,"
        " cod_municipio_ibge6_nascimento string, cod_municipio_ibge6_residencia string,"
        " data_nascimento string, sexo string, raca_cor string, peso_gramas string,"
        " semanas_gestacao_faixa string, tipo_parto string, apgar1 string, apgar5 string,"
        f" numero_consultas_prenatal string, idade_mae string, escolaridade_mae string, {_FILE}"
    ),
    "raw_fns.repasses": (
        "id_lancamento bigint, cnpj_ente_solicitante string, nome_ente_solicitante string,"
        " codigo_programa_agil string, tipo_operacao string, descricao_tipo_operacao string,"
        " descricao_lancamento string, data_lancamento date, data_evento_lancamento date,"
        " numero_referencia_unica string, tipo_favorecido int, descricao_tipo_favorecido string,"
        " nome_favorecido string, valor_lancamento decimal(18,2), id_categoria_despesa int,"
        f" quantidade_subtransacoes int, {_URL}, _reference_year int"
    ),
    "raw_portaltransparencia.recursos_recebidos_saude": (
        "competencia int, cnpj_favorecido string, nome_favorecido string, tipo_favorecido string,"
        " municipio_favorecido string, sigla_uf_favorecido string, codigo_ug string,"
        " nome_ug string, codigo_orgao string, nome_orgao string, codigo_orgao_superior string,"
        f" nome_orgao_superior string, valor decimal(18,2), {_URL}, _reference_year int"
    ),
    "raw_siops.rreo_anexo14": (
        "ano_exercicio int, tipo_demonstrativo string, periodo_bimestre int,"
        " periodicidade string, instituicao string, id_municipio int, uf string,"
        " populacao bigint, anexo string, esfera string, rotulo string, coluna string,"
        f" codigo_conta string, descricao_conta string, valor decimal(18,2), {_URL}"
    ),
    "raw_sisab.indicador_desempenho": (
        "uf string, municipio string, codigo_municipio int, quadrimestre string,"
        " competencia int, codigo_tipo_indicador int, visao_equipe string,"
        " numerador decimal(18,4), denominador_utilizador decimal(18,4),"
        " denominador_identificado decimal(18,4), denominador_estimado decimal(18,4),"
        " percentual decimal(18,4), percentual_quadrimestre decimal(18,4),"
        f" cadastro decimal(18,4), base_externa decimal(18,4), populacao bigint, {_URL}"
    ),
    "raw_sisab.cadastro_vinculado": (
        "competencia_referencia int, sigla_unidade_federacao string, codigo_municipio_ibge int,"
        " nome_municipio string, estimativa_populacional_ibge bigint, tipo_equipe int,"
        " sigla_equipe string, situacao_equipe string,"
        " pessoas_vinculadas_criterios_ponderacao string,"
        f" pessoas_vinculadas_equipe_municipio decimal(18,4), {_URL}"
    ),
}

# The raw columns that may lack a value; all others must hold one.
NULLABLE = {
    "raw_ibge.municipios": (
        "id_microrregiao nome_microrregiao id_mesorregiao nome_mesorregiao"
    ),
    "raw_cnes.estabelecimentos_detalhados": (
        "nome_razao_social nome_fantasia codigo_tipo_unidade codigo_cep endereco numero_endereco"
        " bairro numero_telefone latitude longitude email descricao_turno_atendimento"
        " faz_atendimento_ambulatorial_sus descricao_esfera_administrativa"
        " codigo_motivo_desabilitacao possui_centro_cirurgico possui_centro_obstetrico"
        " possui_centro_neonatal possui_atendimento_hospitalar possui_servico_apoio"
        " possui_atendimento_ambulatorial data_atualizacao"
    ),
    "raw_fns.repasses": (
        "codigo_programa_agil numero_referencia_unica tipo_favorecido descricao_tipo_favorecido"
        " nome_favorecido id_categoria_despesa quantidade_subtransacoes"
    ),
}


def raw_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(RAW_SCHEMAS[table])


def not_null(table: str) -> list[str]:
    """Columns that must hold a value."""
    return [c for c in raw_schema(table).names if c not in NULLABLE.get(table, "").split()]
