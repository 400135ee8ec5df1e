"""Fixed values of the data model: vocabularies, keyword lists, price references.

Everything here must equal the published vocabulary for results to agree; none of it is logic.
"""

# ---- fixed values: cell texts that mean "no value" (compared after trimming, case kept) ----
MISSING_TOKENS = (
    "", "null", "none", "undefined", "n/a", "na", "não informado", "nao informado", "-", "--",
    "s/i", "sem informação", "sem informacao", "NaT", "nat", "NaN", "nan", "inf", "-inf",
)

# ---- fixed values: texts each source treats as null ----
NULL_TEXTS_LEGACY = ("", "nan", "none", "null", "-")          # compared in lower case
NULL_TEXTS_COURT = ("", "nan", "None", "NaT")                 # case kept
NULL_TEXTS_PORTAL = ("", "nan")                               # case kept
NULL_TEXTS_LEGACY_CELL = ("NaT", "nat", "nan", "None", "none", "null", "NULL", "", "NaN")

# ---- fixed values: official status -> raw spellings (lower case) ----
UNDEFINED_STATUS = "Indefinido"
STATUS_SPELLINGS = {
    "Em andamento": (
        "em andamento", "em execução", "em execucao", "em obras", "em execução física",
        "iniciada", "vigente", "em execução (em obras)", "contrato vigente",
    ),
    "Concluída": (
        "concluída", "concluida", "finalizada", "encerrada", "entregue", "obra concluída",
        "concluído", "concluido", "em funcionamento",
    ),
    "Paralisada": (
        "paralisada", "paralisado", "suspensa", "suspensa/paralisada", "obra paralisada",
        "interrompida", "parada",
    ),
    "Em fase de planejamento": (
        "planejada", "planejado", "a iniciar", "não iniciada", "nao iniciada", "não iniciado",
        "nao iniciado", "licitação", "licitacao", "em licitação", "em licitacao", "projeto",
        "em projeto", "cadastrada", "cadastrado", "em cadastro", "habilitada", "habilitado",
        "proposta", "em ação preparatória",
    ),
    "Cancelada": ("cancelada", "cancelado", "obra cancelada", "em cancelamento"),
    "Rescindida": (
        "rescindida", "rescindido", "contrato rescindido", "rescisão", "rescisao",
        "prazo expirado",
    ),
    "Indefinido": ("indefinido", "expirado"),
}

# ---- fixed values: official statuses grouped for the completion rules (lower case) ----
DONE_STATUSES = ("concluida", "concluída", "em funcionamento")
STOPPED_STATUSES = ("cancelada", "rescindida", "suspensa", "em cancelamento")
PLANNED_STATUSES = (
    "em fase de planejamento", "planejada", "cadastrada", "em ação preparatória",
    "em acao preparatoria",
)
RUNNING_STATUSES = ("em andamento", "em execução", "em execucao", "em obras", "em obra")

# ---- fixed values: sources, best first ----
SOURCE_PRIORITY = (
    "painel_obras_atual_macae",
    "painel_obras_legado_macae",
    "portal_transparencia_macae_contratos",
    "portal_transparencia_federal",
    "tce_rj_contratos",
    "tce_rj_compras_diretas",
    "sismob_cidadao",
    "egim_google_mymaps",
    "tce_rj_obras_paralisadas",
)

# ---- fixed values: words that mark a contract object as public works ----
WORKS_KEYWORDS = (
    "obra", "construção", "reforma", "ampliação", "pavimentação", "drenagem", "saneamento",
    "urbanização", "infraestrutura", "recapeamento", "iluminação", "edificação", "galeria",
)
TENDER_KEYWORDS = (
    "obra", "construção", "reforma", "ampliação", "pavimentação", "drenagem", "saneamento",
    "urbanização", "infraestrutura", "recapeamento", "iluminação", "praça", "parque",
    "contenção",
)

# ---- fixed values: reference cost per square metre (R$, state of RJ) ----
COST_PER_M2 = {
    "residencial_popular": 1850.00,
    "residencial_normal": 2400.00,
    "residencial_alto_padrao": 3800.00,
    "comercial_salas_lojas": 2200.00,
    "galpao_industrial": 1200.00,
    "escola": 2800.00,
    "ubs": 3200.00,
    "upa": 3500.00,
    "caps": 3000.00,
    "quadra_esportiva": 900.00,
    "pavimentacao_asfalto": 450.00,
    "pavimentacao_concreto": 650.00,
    "drenagem": 380.00,
    "calcamento": 350.00,
    "praca_urbanizacao": 800.00,
    "padrao": 2000.00,
}

# ---- fixed values: word in a work type -> cost category; the first match wins ----
COST_CATEGORY_BY_WORD = (
    ("ubs", "ubs"),
    ("upa", "upa"),
    ("caps", "caps"),
    ("hospital", "ubs"),
    ("creche", "escola"),
    ("colegio", "escola"),
    ("escola", "escola"),
    ("cras", "comercial_salas_lojas"),
    ("creas", "comercial_salas_lojas"),
    ("recapeamento", "pavimentacao_asfalto"),
    ("pavimentacao", "pavimentacao_asfalto"),
    ("drenagem", "drenagem"),
    ("galeria", "drenagem"),
    ("calcamento", "calcamento"),
    ("praca", "praca_urbanizacao"),
    ("parque", "praca_urbanizacao"),
    ("quadra", "quadra_esportiva"),
    ("construcao", "residencial_normal"),
    ("reforma", "residencial_normal"),
    ("ampliacao", "residencial_normal"),
)
DEFAULT_COST_CATEGORY = "padrao"

# ---- fixed values: month names ----
MONTHS = (
    "janeiro", "fevereiro", "março", "abril", "maio", "junho", "julho", "agosto", "setembro",
    "outubro", "novembro", "dezembro",
)

# ---- fixed values: days per unit of a written duration ----
DAYS_PER_UNIT = {"DIA": 1, "MES": 30, "SEMANA": 7, "ANO": 365}

# ---- fixed values: municipality ----
MUNICIPALITY = "Macaé"
STATE = "RJ"
COUNTRY = "Brasil"
MUNICIPALITY_DEFAULT = "Macae"
MUNICIPALITY_KEY = "macae"
MUNICIPALITY_CODE = "3302403"
MUNICIPALITY_CODE_HEALTH = "330240"
LOCALITIES = ("Macaé/RJ", "Macae/RJ")
# latitude min, latitude max, longitude min, longitude max
BOUNDING_BOX = (-22.65, -22.05, -42.15, -41.55)

# ---- fixed values: marker colours -> status ----
MARKER_STATUS = (
    ("orange", "concluída"),
    ("laranja", "concluída"),
    ("yellow", "concluída"),
    ("blue", "em andamento"),
    ("azul", "em andamento"),
    ("ltblue", "em andamento"),
    ("green", "em andamento"),
    ("red", "paralisada"),
    ("vermelho", "paralisada"),
    ("purple", "planejada"),
    ("gray", "indefinido"),
    ("grey", "indefinido"),
)

# ---- fixed values: patterns that find a district or street in an object text ----
DISTRICT_PATTERN = (
    r"\bBAIRRO\s+(?:D[AEO]S?\s+)?([A-ZÀ-Ú][\wÀ-ú\s]{2,28}?)"
    r"(?:\s*[,;.]|\s+MACA[ÉE]|\s+LOCALIZAD|/RJ)"
)
STREET_PATTERN = (
    r"LOCALIZAD[AO]S?\s+N[AOE]S?\s+"
    r"((?:RUA|AVENIDA|AV\.|RODOVIA|RJ-?\d+|ESTRADA|TRAVESSA|ALAMEDA|LARGO|PRA[ÇC]A)"
    r"\s+[A-ZÀ-Ú][^,;]{2,55}?)(?:\s*[,;]|\s+MACA[ÉE]|\s+BAIRRO|/RJ|$)"
)

# ---- fixed values: column-name fragments that hint at a role ----
DATE_HINTS = (
    "data", "date", "dt_", "_dt", "assinatura", "vigencia", "vencimento", "inicio", "fim",
    "rescisao", "publicacao", "atualizacao", "coletado",
)
MONEY_HINTS = ("valor", "montante", "preco", "quantia", "orcamento", "total")

# ---- fixed values: text columns worth packing, and the size from which packing pays ----
PACKED_TEXT_COLUMNS = (
    "objeto_contrato", "historico_obra", "razao_social_fornecedor", "descricao_item",
)
PACKED_TEXT_MIN_BYTES = 64

# ---- fixed values: days a work stays "recent" in the active filter ----
ACTIVE_WINDOW_DAYS = 730

# ---- fixed values: words that tell the stage of a map marker, a panel row or a health work ----
FINISHED_WORDS = ("conclu", "finaliz", "entreg")
RUNNING_WORDS = ("andamento", "execu")
HALTED_WORDS = ("paralis", "suspens")
PLANNED_WORDS = ("planeja", "projeto", "previs")
MARKER_FINISHED_WORDS = ("CONCLU", "FINALIZ")
MARKER_RUNNING_WORDS = ("ANDAMENTO", "EXECU")
PANEL_FINISHED_WORDS = ("conclu", "finaliz", "entregue", "funcionamento")
PANEL_PLANNED_WORDS = ("cadastrad", "planejad", "previs", "fase de planejamento")
PANEL_RUNNING_WORDS = ("andamento", "execu", "obra")
HEALTH_FINISHED_WORDS = ("funcionamento", "conclu")

# ---- fixed values: words that tell whether an agreement or a work is over or running ----
CANCELLED_WORDS = ("anulad", "cancelad", "rescis")
SETTLED_WORDS = ("conclu", "aprovad", "prestacao de contas")
ACTIVE_WORDS = ("andamento", "execu", "iniciada", "vigente")
OVER_WORDS = ("cancelada", "rescindida", "concluída", "concluida")

# a flag text that says there is no amendment
DENIED_AMENDMENT = r"^(?:sem|n[aã]o|nenhum|nada|0)(?:\W|$)"
