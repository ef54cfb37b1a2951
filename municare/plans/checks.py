"""The declared data tests of every model and seed."""

from __future__ import annotations

from municare.operators.quality import Check

BRIDGE = "int_ibge__municipio_codigo6"


def _key(model: str, column: str) -> list[Check]:
    return [Check(model, column, "unique"), Check(model, column, "not_null")]


def _present(model: str, *columns: str) -> list[Check]:
    return [Check(model, c, "not_null") for c in columns]


def _domain(model: str, column: str, *values: str) -> Check:
    return Check(model, column, "accepted_values", values=values)


def _refers(
    model: str, column: str, parent: str, parent_column: str, severity: str = "error"
) -> Check:
    return Check(
        model, column, "relationships",
        parent=parent, parent_column=parent_column, severity=severity,
    )


def _municipality(model: str, column: str = "id_municipio") -> list[Check]:
    return [*_present(model, column), _refers(model, column, "dim_municipio", "id_municipio")]


# The domains the models promise.
TEAM_KINDS = ("eSF", "eCR", "eAPP", "eAP")
TEAM_STATES = ("ativa", "desativada")

CHECKS: tuple[Check, ...] = (
    # raw tables
    *_key("raw_ibge.municipios", "id_municipio"),
    *_present("raw_ibge.populacao_estimada", "id_municipio"),
    *_present("raw_cnes.estabelecimentos", "codigo_cnes"),
    *_key("raw_cnes.equipes_aps", "id_equipe"),
    *_key("raw_cnes.estabelecimentos_detalhados", "codigo_cnes"),
    *_present("raw_cnes.rede_porte_municipio", "cod_municipio_ibge6"),
    *_key("raw_fns.repasses", "id_lancamento"),
    *_present("raw_portaltransparencia.recursos_recebidos_saude", "cnpj_favorecido"),
    *_present("raw_sia.producao_ambulatorial", "competencia_arquivo"),
    *_key("raw_sih.internacoes", "numero_aih"),
    # seeds
    *_key("seed_cnes_natureza_juridica", "codigo_natureza_juridica"),
    *_present("seed_cnes_natureza_juridica", "descricao_natureza_juridica"),
    *_key("seed_cnes_tipo_unidade", "codigo_tipo_unidade"),
    *_present("seed_cnes_tipo_unidade", "descricao_tipo_unidade"),
    *_key("seed_sisab_tipo_indicador", "codigo_tipo_indicador"),
    *_key("seed_sisab_tipo_indicador", "numero_indicador"),
    *_key("seed_fns_ente_municipio", "cnpj_ente"),
    *_municipality("seed_fns_ente_municipio"),
    *_present("seed_icsap_cid10", "grupo_icsap", "cid_inicio", "cid_fim"),
    *_key("seed_sigtap_grupo", "codigo_grupo"),
    *_present("seed_sigtap_grupo", "descricao_grupo"),
    *_key("seed_previne_brasil_meta", "numero_indicador"),
    *_present("seed_previne_brasil_meta", "parametro_percentual", "meta_percentual"),
    # staging
    *_key("stg_ibge__municipios", "id_municipio"),
    *_present("stg_ibge__municipios", "id_uf", "id_regiao"),
    *_present("stg_ibge__populacao_estimada", "id_municipio", "ano_referencia"),
    _refers("stg_ibge__populacao_estimada", "id_municipio", "stg_ibge__municipios", "id_municipio"),
    *_key("stg_cnes__estabelecimentos", "id_estabelecimento_competencia"),
    *_present("stg_cnes__estabelecimentos", "codigo_cnes"),
    _domain("stg_cnes__estabelecimentos", "tipo_pessoa", "fisica", "juridica"),
    _domain("stg_cnes__estabelecimentos", "nivel_dependencia", "individual", "mantida"),
    _domain(
        "stg_cnes__estabelecimentos", "atividade_ensino",
        "unidade_universitaria", "unidade_escola_superior_isolada", "unidade_auxiliar_de_ensino",
        "sem_atividade_de_ensino", "hospital_de_ensino", "nao_informado",
    ),
    _domain(
        "stg_cnes__estabelecimentos", "tipo_gestao",
        "municipal", "estadual", "dupla", "sem_gestao", "nao_informado",
    ),
    *_key("stg_cnes__equipes_aps", "id_equipe"),
    _domain("stg_cnes__equipes_aps", "sigla_equipe", *TEAM_KINDS),
    _domain("stg_cnes__equipes_aps", "situacao_equipe", *TEAM_STATES),
    _refers("stg_cnes__equipes_aps", "cod_municipio_ibge6", BRIDGE, "cod_municipio_ibge6"),
    *_key("stg_cnes__estabelecimentos_detalhados", "codigo_cnes"),
    *_present("stg_cnes__rede_porte_municipio", "cod_municipio_ibge6"),
    *_key("stg_fns__repasses", "id_lancamento"),
    _domain("stg_fns__repasses", "tipo_operacao", "credito", "debito"),
    *_present("stg_portaltransparencia__recursos_recebidos", "cnpj_favorecido", "valor"),
    _refers(
        "stg_portaltransparencia__recursos_recebidos", "cnpj_favorecido",
        "seed_fns_ente_municipio", "cnpj_ente",
    ),
    *_present("stg_sia__producao_ambulatorial", "competencia_arquivo"),
    *_key("stg_sih__internacoes", "numero_aih"),
    _domain(
        "stg_sim__obitos", "idade_unidade",
        "minutos", "horas", "dias", "meses", "anos", "anos_mais_de_100", "nao_informado",
    ),
    *_municipality("stg_siops__rreo_anexo14"),
    *_present("stg_sisab__indicador_desempenho", "numero_indicador"),
    _refers("stg_sisab__indicador_desempenho", "codigo_municipio", BRIDGE, "cod_municipio_ibge6"),
    _domain("stg_sisab__cadastro_vinculado", "sigla_equipe", *TEAM_KINDS),
    _domain("stg_sisab__cadastro_vinculado", "situacao_equipe", "válidas", "homologadas", "todas"),
    _refers("stg_sisab__cadastro_vinculado", "codigo_municipio_ibge", BRIDGE, "cod_municipio_ibge6"),
    # intermediate
    *_key(BRIDGE, "id_municipio"),
    *_key(BRIDGE, "cod_municipio_ibge6"),
    # a repeated diagnosis would mean two overlapping ranges
    *_key("int_sih__diagnostico_icsap", "diagnostico_principal"),
    # marts
    *_key("dim_municipio", "id_municipio"),
    *_key("dim_estabelecimento", "codigo_cnes"),
    *_municipality("dim_estabelecimento"),
    *_key("fct_internacoes", "numero_aih"),
    *_municipality("fct_internacoes", "id_municipio_estabelecimento"),
    _refers(
        "fct_internacoes", "codigo_cnes_estabelecimento",
        "dim_estabelecimento", "codigo_cnes", "warn",
    ),
    *_municipality("fct_obitos", "id_municipio_ocorrencia"),
    *_municipality("fct_nascidos_vivos", "id_municipio_nascimento"),
    *_present("fct_producao_ambulatorial", "competencia_arquivo"),
    *_municipality("fct_producao_ambulatorial", "id_municipio_estabelecimento"),
    _refers(
        "fct_producao_ambulatorial", "codigo_cnes_estabelecimento",
        "dim_estabelecimento", "codigo_cnes", "warn",
    ),
    *_key("mart_repasses_fns", "id_lancamento"),
    *_municipality("mart_repasses_fns"),
    *_municipality("mart_financiamento_saude_siops"),
    *_municipality("mart_indicadores_aps"),
    *_present("mart_indicadores_aps", "numero_indicador"),
    _domain("mart_indicadores_aps", "status_meta", "ok", "atencao", "critico"),
    *_key("mart_cobertura_aps_municipio", "id_municipio"),
    _refers("mart_cobertura_aps_municipio", "id_municipio", "dim_municipio", "id_municipio"),
    *_present("mart_cobertura_aps_municipio", "populacao_estimada"),
    *_key("mart_historico_rede_cnes", "id_estabelecimento_competencia"),
    _domain(
        "mart_historico_rede_cnes", "situacao_operacional",
        "ativo", "possivelmente_encerrado", "historico",
    ),
    *_municipality("mart_historico_rede_cnes"),
    _domain(
        "mart_financiamento_saude_uniao", "fonte", "fns_fundo_a_fundo", "portal_transparencia"
    ),
    *_municipality("mart_financiamento_saude_uniao"),
    *_present("mart_financiamento_saude_uniao", "valor"),
    *_municipality("mart_producao_grupo_municipio"),
    *_present(
        "mart_producao_grupo_municipio", "competencia_date", "codigo_grupo", "descricao_grupo"
    ),
    *_municipality("mart_icsap_municipio"),
    *_present("mart_icsap_municipio", "total_internacoes", "percentual_icsap"),
    *_key("mart_alertas_saude", "id_alerta"),
    *_present("mart_alertas_saude", "codigo_regra"),
    _domain(
        "mart_alertas_saude", "codigo_regra",
        "siops_abaixo_minimo_constitucional", "rede_cnes_possivel_encerramento",
        "financiamento_liquido_negativo",
    ),
    _domain("mart_alertas_saude", "severidade", "alta", "media", "baixa"),
    *_municipality("mart_alertas_saude"),
    _domain("mart_alertas_saude", "status", "ativo"),
    *_key("mart_comparacao_municipios_rj", "id_municipio"),
    _refers("mart_comparacao_municipios_rj", "id_municipio", "dim_municipio", "id_municipio"),
    *_present("mart_comparacao_municipios_rj", "populacao_estimada"),
    *_key("mart_equipe_aps_detalhada", "id_equipe"),
    _domain("mart_equipe_aps_detalhada", "sigla_equipe", *TEAM_KINDS),
    _domain("mart_equipe_aps_detalhada", "situacao_equipe", *TEAM_STATES),
    *_municipality("mart_equipe_aps_detalhada"),
)
