"""Fixed values of the data model: column names, tokens, labels, thresholds.

Everything here has to equal what the source files and the users of the panel
expect, so it is stated plainly and nowhere else.
"""

# --- missing-value tokens ------------------------------------------------------------
DEFAULT_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
DASH_NA_TOKENS = ("-", "--")

# --- raw tables: rows above the header, source column -> panel column -----------------
TERRITORY_SKIP = 6
TERRITORY_NAMES = {
    "UF": "id_uf",
    "Nome_UF": "nome_uf",
    "Nome Região Geográfica Imediata": "nome_rgi",
    "Código Município Completo": "id_municipio",
    "Nome_Município": "nome_municipio",
}

SCORE_SKIP = 9
SCORE_YEARS = tuple(range(2005, 2025, 2))
SCORE_SOURCE_PREFIX = "VL_OBSERVADO_"
SCORE_PREFIX = "ideb_"
SCORE_NAMES = {
    "CO_MUNICIPIO": "id_municipio",
    "NO_MUNICIPIO": "nome_municipio",
    "REDE": "rede",
}

PROJECT_SKIP = 0
PROJECT_SHEETS = ("2020", "2021", "2022", "2023", "2024", "2025")
PROJECT_NAMES = {
    "CIDADES": "nome_municipio",
    "ESTADO": "sg_uf",
    "Nº de Projetos": "nr_projetos",
    "Nº de Instituições": "nr_instituicoes",
    "Nº de Beneficiados": "nr_beneficiados",
}
PROJECT_MEASURES = ("nr_projetos", "nr_instituicoes", "nr_beneficiados")

GDP_SKIP = 0
GDP_NAMES = {
    "Ano": "ano",
    "Nome da Grande Região": "regiao",
    "Código do Município": "id_municipio",
    "Nome do Município": "nome_municipio",
    "Sigla da Unidade da Federação": "sg_uf",
    "Produto Interno Bruto, \na preços correntes\n(R$ 1.000)": "pib_mil_reais",
    "Produto Interno Bruto per capita, \na preços correntes\n(R$ 1,00)": "pib_per_capita",
}
GDP_REPLICATE_UNTIL = 2025

DISTORTION_SKIP = 8
DISTORTION_NAMES = {
    "NU_ANO_CENSO": "ano",
    "NO_MUNICIPIO": "nome_municipio",
    "CO_MUNICIPIO": "id_municipio",
    "NO_DEPENDENCIA": "rede",
    "FUN_CAT_0": "taxa_distorcao_total_fun",
    "FUN_AI_CAT_0": "taxa_distorcao_anos_iniciais",
    "FUN_AF_CAT_0": "taxa_distorcao_anos_finais",
}
DISTORTION_MEASURES = (
    "taxa_distorcao_total_fun",
    "taxa_distorcao_anos_iniciais",
    "taxa_distorcao_anos_finais",
)

PUBLIC_NETWORK = "Pública"

STATE_NAMES = {
    "PB": "Paraíba",
    "PE": "Pernambuco",
    "MG": "Minas Gerais",
    "SP": "São Paulo",
    "RJ": "Rio de Janeiro",
}

# --- name normalisation ---------------------------------------------------------------
NAME_NOISE = "MIXING CENTER"
NAME_PUNCTUATION = '-.!?"`()*'
# what Python's str.strip removes
UNICODE_SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# --- processed tables -----------------------------------------------------------------
TABLE_TERRITORY = "dtb_consolidado"
TABLE_SCORE = "ideb_consolidado"
TABLE_PROJECTS = "proj_IA_consolidado"
TABLE_GDP = "pib_consolidado"
TABLE_DISTORTION = "taxa_distorcao_consolidado"
TABLE_PANEL = "data_final_consolidado"

PANEL_COLUMNS = (
    "ano", "regiao", "id_municipio", "sg_uf", "pib_mil_reais", "pib_per_capita",
    "nome_municipio_formatado", "populacao", "ideb_nota", "id_uf", "nome_uf", "nome_rgi",
    "nr_projetos", "nr_instituicoes", "nr_beneficiados", "taxa_distorcao_total_fun",
    "taxa_distorcao_anos_iniciais", "taxa_distorcao_anos_finais",
)

# --- labels ---------------------------------------------------------------------------
WITH_PROJECTS, WITHOUT_PROJECTS = "Com Projetos", "Sem Projetos"
STATUS_LABELS = (WITH_PROJECTS, WITHOUT_PROJECTS)
PRESENT, ABSENT = "Sim", "Não"
PRESENCE_LABELS = (ABSENT, PRESENT)

POPULATION_BANDS = ("Pequeno Porte", "Médio Porte", "Grande Porte", "Metrópole")
GDP_BANDS = ("PIB Baixo", "PIB Médio-Baixo", "PIB Médio-Alto", "PIB Alto")
GDP_PER_CAPITA_BANDS = ("PIB per Capita Baixo", "Médio-Baixo", "Médio-Alto", "Alto")
WEALTH_BANDS = ("Baixo", "Médio-Baixo", "Médio-Alto", "Alto")

SIZE_LIMITS = (20_000, 100_000)
SIZE_LABELS = ("Pequeno", "Médio", "Grande")
SIZE_UNDEFINED = "Não definido"

DETAIL_COLUMNS = (
    "nome_municipio_formatado", "sg_uf", "populacao", "ideb_nota", "pib_per_capita",
    "nr_projetos", "nr_beneficiados", "taxa_distorcao_total_fun",
)
HOVER_COLUMNS = (
    "nome_municipio_formatado", "sg_uf", "nr_projetos", "nr_beneficiados", "populacao",
    "ideb_nota", "pib_per_capita",
)
SCATTER_AXES = (
    "ideb_nota", "pib_per_capita", "populacao", "taxa_distorcao_total_fun", "nr_projetos",
)
