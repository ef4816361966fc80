"""What each source entity looks like: its key and the rule of every column."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Entity:
    """Column rules of one entity, applied by ``plans.transforms.conform``."""

    key: str
    text: list[str]
    days: list[str] = field(default_factory=list)
    numbers: dict[str, str] = field(default_factory=dict)
    dropped: list[str] = field(default_factory=list)
    renamed: dict[str, str] = field(default_factory=dict)


# Fixed values from here to the end of the file: column names of the source
# system by entity, the words that mean true, and the keys that start a new version.
CUSTOMERS = Entity(
    key="codigo_associado",
    text=[
        "codigo_associado", "codigo_situacao", "nome", "sexo", "tipo_pessoa", "rg_associado", "cnh",
        "categoria_cnh", "dia_vencimento", "cpf", "ddd", "telefone", "codigo_profissao",
        "codigo_classificacao", "ddd_celular", "telefone_celular", "email", "cep", "logradouro", "numero",
        "complemento", "bairro", "cidade", "estado", "codigo_regional", "codigo_cooperativa",
        "codigo_voluntario",
    ],
    days=["data_nascimento", "data_vencimento_habilitacao", "data_cadastro_associado", "data_contrato_associado"],
    dropped=[
        "radio", "radio2", "hora_contrato_associado", "orgao_expedidor_rg", "data_expedicao_rg",
        "email_auxiliar", "pontos", "opcoes_notificacao", "campos_opcionais", "ddd_celular_aux",
        "telefone_celular_aux", "ddd_comercial", "telefone_comercial",
    ],
)
VEHICLES = Entity(
    key="codigo_veiculo",
    text=[
        "codigo_veiculo", "placa", "chassi", "renavam", "codigo_associado", "codigo_usuario", "codigo_tipo",
        "codigo_classificacao", "codigo_cota", "codigo_fipe", "valor_fipe_protegido", "codigo_depreciacao",
        "codigo_regional", "codigo_cooperativa", "codigo_marca", "codigo_modelo", "codigo_combustivel",
        "codigo_cor", "codigo_grupo_produto", "codigo_vencimento", "boleto_fisico", "mes_referente",
        "codigo_categoria", "tipo", "categoria", "marca", "modelo", "nome_associado", "rg_associado",
        "cpf_associado", "telefone", "ddd", "telefone_celular", "ddd_celular", "email", "codigo_situacao",
        "descricao_situacao", "codigo_voluntario", "nome_voluntario", "cpf_voluntario", "campos_opcionais",
    ],
    days=["data_reativacao", "data_alteracao", "data_cadastro", "data_contrato"],
    numbers={
        "valor_fipe": "double", "valor_fixo": "double", "valor_adesao": "double",
        "pontos": "bigint", "ano_fabricacao": "bigint", "ano_modelo": "bigint", "mes_final_carne": "bigint",
    },
    dropped=[
        "hora_cadastro", "usuario_cadastro", "telefone_celular_aux", "ddd_celular_aux", "ddd_comercial",
        "telefone_comercial", "data_contrato_final", "codigo_tabela_avaliacao", "codigo_tipo_adesao",
    ],
)
VOLUNTEERS = Entity(
    key="codigo_voluntario",
    text=[
        "codigo_voluntario", "nome", "cpf", "cep", "telefone", "telefone_comercial", "celular", "email",
        "situacao", "codigo_classificacao", "logradouro", "numero", "complemento", "bairro", "cidade",
        "estado", "situacao_origem",
    ],
    days=["data_cadastro", "data_nascimento"],
    dropped=[
        "formato_pagamento", "formato_pagamento_residual", "valor_pagamento", "valor_pagamento_residual", "obs",
    ],
)
COOPERATIVES = Entity(
    key="codigo_cooperativa",
    text=[
        "codigo_cooperativa", "nome", "logradouro", "numero", "complemento", "bairro", "cidade", "estado",
        "cep", "email", "cpf", "telefone", "situacao",
    ],
    numbers={"valor_pagamento": "double", "valor_pagamento_residual": "double"},
)
REGIONALS = Entity(
    key="codigo_regional",
    text=[
        "codigo_regional", "nome", "nome_fantasia", "cnpj", "logradouro", "numero", "complemento", "bairro",
        "cidade", "estado", "cep", "email", "telefone", "situacao",
    ],
)
STATUSES = Entity(key="codigo_situacao", text=["codigo_situacao", "descricao_situacao", "cor_linha", "cor_fonte"])
INVOICE_STATUSES = Entity(
    key="codigo_situacao_boleto",
    text=["codigo_situacao_boleto", "descricao_situacao_boleto"],
    renamed={"codigo_situacaoboleto": "codigo_situacao_boleto", "descricao": "descricao_situacao_boleto"},
)
INVOICES = Entity(
    key="codigo_boleto",
    text=[
        "codigo_boleto", "nosso_numero", "mes_referente", "pago", "codigo_associado", "cpf_associado",
        "codigo_situacao_associado", "descricao_situacao_associado", "codigo_regional_associado",
        "nome_regional_associado", "codigo_situacao_boleto", "descricao_situacao_boleto", "codigo_regional",
        "nome_regional_boleto", "referente", "codigo_mgfformapagamento", "codigo_forma_pagamento",
        "descricao_forma_pagamento", "descricao_tipo_cobranca_recorrente", "codigo_tipo_boleto",
        "descricao_tipo_boleto", "codigo_conta", "codigo_banco", "nome_banco", "agencia", "conta",
        "descricao_tipo_baixa_boleto", "codigo_situacao",
    ],
    days=["data_emissao", "data_vencimento_original", "data_vencimento", "data_pagamento", "data_credito_banco"],
    numbers={
        "valor_boleto": "double", "valor_pagamento": "double", "tarifa_cobranca_banco": "double",
        "parcela_paga": "bigint", "qtde_parcela": "bigint",
    },
)

STATUS_IN_USE = ["ativo"]
YES_WORDS = ["s", "sim", "y"]

SIMPLE_DIMENSIONS = {
    "cooperatives": ("dim_cooperatives", "codigo_cooperativa"),
    "regionals": ("dim_regionals", "codigo_regional"),
    "volunteers": ("dim_volunteers", "codigo_voluntario"),
    "statuses": ("dim_status", "codigo_situacao"),
    "invoice_statuses": ("dim_status_invoice", "codigo_situacao_boleto"),
}
CODE_LISTS = {"statuses": "descricao_situacao", "invoice_statuses": "descricao_situacao_boleto"}
VERSIONED_DIMENSIONS = {
    "customers": (
        "dim_customers", "codigo_associado", "sk_customer",
        ["codigo_situacao", "codigo_voluntario", "codigo_classificacao", "codigo_regional", "codigo_cooperativa"],
    ),
    "vehicles": (
        "dim_vehicles", "codigo_veiculo", "sk_vehicle",
        [
            "codigo_situacao", "valor_fixo", "codigo_voluntario", "data_contrato", "codigo_classificacao",
            "codigo_regional", "codigo_cooperativa", "valor_fipe_protegido",
        ],
    ),
}
MONITORED_TABLES = {
    "dim_customers": "atualizado_em",
    "dim_vehicles": "atualizado_em",
    "fact_invoices": "atualizado_em",
    "bridge_invoices_vehicles": "atualizado_em",
    "fact_delinquency_snapshot": "criado_em",
}
