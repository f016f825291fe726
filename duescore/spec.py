"""Portfolio specification: everything that differs between two portfolios.

One ``PortfolioSpec`` describes a creditor's daily scoring run: which creditor
and document type it covers, how wide documents are, which tags are read from
the contact and debt arrays, how interactions are labelled and where the
probability bands start.  Every operator takes names and values from a spec or
from its arguments; no creditor name is written in library code.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the values used by the scoring models and by
# the downstream consumers of the feature base, so they are stated verbatim.
# ---------------------------------------------------------------------------

# Tags read from every phone and e-mail slot of the contact profile; the last
# one is true when the slot holds no answer at all.
CONTACT_TAGS = ("skip:hot", "skip:alto", "skip:medio", "skip:baixo", "skip:nhot", "sem_tags")

# Tags read from the debt tag array of the debt snapshot (card base).
DEBT_TAGS = ("rank:a", "rank:b", "rank:c", "rank:d", "rank:e", "sem_tags")

# One rank per nested debt (company base); the last value means "no rank".
RANK_VALUES = ("rank:a", "rank:b", "rank:c", "rank:d", "rank:e", "sem_skip")

# Placeholder written into state slots when no state was registered.
STATE_PLACEHOLDER = "!!!<<Cadastrar>>!!!"

# Right-closed upper edges of the probability bands.
CARD_BAND_EDGES = (0.15462458, 0.18387774, 0.5029465, 0.63928771, 0.72260146)
COMPANY_BAND_EDGES = (0.071, 0.0725, 0.074, 0.0758, 0.0783, 0.0819, 0.0883, 0.11)

# Milliseconds per "year" used for the age of a person.
AGE_YEAR_MS = 31540000000
# Days per year for elapsed-years date features.
DAYS_PER_YEAR = 365.25

# Column names of the feature base and of the score output.
PHONE_PREFIX = "Telefone"
EMAIL_PREFIX = "Email"
DOMAIN_SUFFIX = "dominio"
STATE_PREFIX = "UF"
DEBT_FLAG_PREFIX = "SkipDivida_"
OTHER_CREDITOR_FLAG = "Divida_Outro_Credor"
SAME_CREDITOR_FLAG = "Divida_Mesmo_Credor"
SIMULATION_COUNT = "QTD_SIMU"
AUTH_COUNT = "QTD_AUTH"
FIRST_TOUCH = "PRIMEIRO_ACIONAMENTO"
DEAL_DATE = "DT_ACORDO"
DEAL_FLAG = "VARIAVEL_RESPOSTA_ACORDO"
PAYMENT_DATE = "DT_PAGAMENTO"
INSTALLMENT_COUNT = "QTD_PARCELAS"
PAYMENT_FLAG = "PAGTO"
ACTIVATED = "ATIVADO"
NOT_ACTIVATED = "NAO_ATIVADO"
SCORE_COLUMNS = ("Document", "Score", "ScoreValue", "ScoreAvg", "Provider", "Date", "CreatedAt")

# Card portfolio file: raw header names and their cleaned names.
CARD_FILE_RENAMES = {
    "NOME CLIENTE": "NOME_CLIENTE",
    "DIAS ATRASO": "DIAS_ATRASO",
    "DATA DIVIDA": "DATA_DIVIDA",
    "DATA ULTIMA FATURA": "DATA_ULTIMA_FATURA",
    "DATA INTERROMPE COBRANCA": "DATA_INTERROMPE_COBRANCA",
    "DATA RETORNO COBRANCA": "DATA_RETORNO_COBRANCA",
    "VALOR ULTIMA FATURA": "VALOR_ULTIMA_FATURA",
}
CARD_PAYMENT_COLUMNS = ("DATA PAGAMENTO", "VALOR PAGO")

# Company portfolio file: headerless, ';'-separated, one record type per line
# (0 header, 9 trailer).  Field order of the file layout.
COMPANY_FILE_FIELDS = (
    "Tipo_Registro", "Tipo_Pessoa", "Numero_Documento", "Nome",
    "Endereco1", "Bairro1", "Cidade1", "Uf1", "Cep1",
    "Endereco2", "Bairro2", "Cidade2", "Uf2", "Cep2",
    "Endereco3", "Bairro3", "Cidade3", "Uf3", "Cep3",
    "Telefone1", "Telefone2", "Telefone3", "Telefone4", "Telefone5",
    "Telefone6", "Telefone7", "Telefone8", "Telefone9", "Telefone10",
    "Email", "Indicador_Correntista", "Contrato_Altair", "Numero_Operacao_LY",
    "Descricao_Produto", "Saldo_Devedor_Contrato", "Dias_Atraso", "Codigo_Politica",
    "Taxa_Padrao", "Desconto_Padrao", "Percentual_Min_Entrada", "Valor_Min_Parcela",
    "Qtde_Min_Parcelas", "Qtde_Max_Parcelas", "Qtde_Parcelas_Padrao",
    "Forma_Pgto_Padrao", "Total",
)
COMPANY_AMOUNT_FIELDS = (
    "Saldo_Devedor_Contrato", "Taxa_Padrao", "Desconto_Padrao",
    "Percentual_Min_Entrada", "Valor_Min_Parcela",
)
COMPANY_INT_FIELDS = ("Dias_Atraso", "Qtde_Min_Parcelas", "Qtde_Max_Parcelas", "Qtde_Parcelas_Padrao")
# Columns of the company base, in order, before enrichment.
COMPANY_BASE_COLUMNS = (
    "ID_Credor", "ID_DEVEDOR", "Contrato_Altair", "data_referencia", "DATA_ENTRADA_DIVIDA",
    "Indicador_Correntista", "Cep1", "Cep2", "Cep3", "Forma_Pgto_Padrao", "Taxa_Padrao",
    "Desconto_Padrao", "Qtde_Min_Parcelas", "Qtde_Max_Parcelas", "Qtde_Parcelas_Padrao",
    "Valor_Min_Parcela", "Codigo_Politica", "Saldo_Devedor_Contrato", "Dias_Atraso",
    "Descricao_Produto",
) + RANK_VALUES

# Card feature groups fed to the model (numeric, categorical, date).
CARD_NUMERIC = (
    "DIAS_ATRASO", "VALOR_ULTIMA_FATURA", "QTD_AUTH", "QTD_SIMU",
    "ACION_EMAIL_QTD_ATIVADO", "ACION_EMAIL_QTD_NAO_ATIVADO",
    "ACION_SMS_QTD_ATIVADO", "ACION_SMS_QTD_NAO_ATIVADO",
)
CARD_CATEGORICAL = ("UF1", "UF2", "UF3")
CARD_DATES = ("DATA_DIVIDA", "DATA_ULTIMA_FATURA", "PRIMEIRO_ACIONAMENTO")
COMPANY_NUMERIC = (
    "Taxa_Padrao", "Desconto_Padrao", "Saldo_Devedor_Contrato", "Dias_Atraso", "originalAmount",
    "QTD_AUTH", "QTD_SIMU", "ACION_SMS_QTD_ATIVADO", "ACION_SMS_QTD_NAO_ATIVADO",
    "ACION_VOICE_QTD_ATIVADO", "ACION_VOICE_QTD_NAO_ATIVADO", "ACION_EMAIL_QTD_ATIVADO",
    "ACION_EMAIL_QTD_NAO_ATIVADO",
)
COMPANY_CATEGORICAL = ("Indicador_Correntista", "Forma_Pgto_Padrao", "Descricao_Produto", "UF1", "UF2", "UF3")
COMPANY_DATES = ("DATA_ENTRADA_DIVIDA", "PRIMEIRO_ACIONAMENTO")

# Interaction types counted per activation label: card pivots e-mail and sms,
# the company base counts sms, call (as VOICE) and e-mail.
CARD_CHANNELS = (("email", "EMAIL"), ("sms", "SMS"))
COMPANY_CHANNELS = (("sms", "SMS"), ("call", "VOICE"), ("email", "EMAIL"))


@dataclass(frozen=True)
class PortfolioSpec:
    """What one portfolio's daily run needs to know."""

    creditor: str
    document_type: str                      # value of ``documentType`` in the profile
    document_width: int                     # zero-padded width of the published document
    provider: str                           # written into every published score row
    band_edges: tuple[float, ...]
    file_document: str                      # document column of the portfolio file
    file_contract: str                      # contract column of the portfolio file
    phone_slots: int = 10
    email_slots: int = 3
    state_slots: int = 3
    contact_tags: tuple[str, ...] = CONTACT_TAGS
    debt_tags: tuple[str, ...] = DEBT_TAGS
    rank_values: tuple[str, ...] = RANK_VALUES
    none_tag: str = "sem_tags"
    state_placeholder: str = STATE_PLACEHOLDER
    campaign_marker: str = "NOVO"           # campaign names holding it are not activations
    outcome_since: str = "2020-01-01"       # lower bound for deals and installments
    outcome_until: str | None = None        # optional upper bound for them (the file rule has none, Q8)
    excluded_deal_status: str = "error"
    reopening_status: tuple[str, ...] = ("expired", "broken")
    excluded_interaction_status: str = "not_received"
    channels: tuple[tuple[str, str], ...] = CARD_CHANNELS
    inclusive_day: bool = False             # False: activity later on the file date is left out
    fill_zero: bool = False                 # True: persons without contacts get 0, not null
    hot_rows: int = 1_000_000               # rows of a (person, document) per task; a larger pair is salted
    hot_top_k: int = 10_000                 # a salted pair holds at least this share (1/k) of all rows
    extra: dict = field(default_factory=dict)

    def with_(self, **kw) -> "PortfolioSpec":
        return replace(self, **kw)


def card_spec(creditor: str, provider: str, **kw) -> PortfolioSpec:
    """Card-payments portfolio of natural persons."""
    return PortfolioSpec(
        creditor=creditor, document_type="cpf", document_width=11, provider=provider,
        band_edges=CARD_BAND_EDGES, file_document="CPF", file_contract="CONTA",
        channels=CARD_CHANNELS, **kw,
    )


def company_spec(creditor: str, provider: str, **kw) -> PortfolioSpec:
    """Bank portfolio of companies."""
    return PortfolioSpec(
        creditor=creditor, document_type="cnpj", document_width=14, provider=provider,
        band_edges=COMPANY_BAND_EDGES, file_document="ID_DEVEDOR", file_contract="Contrato_Altair",
        channels=COMPANY_CHANNELS, **kw,
    )
