"""Fixed values of the domain: territories, institutions, brands, address vocabularies, precision levels."""

from __future__ import annotations

# States with their numeric codes, municipality counts, names, and regions in official order.
STATE_CODES = {
    "RO": 11, "AC": 12, "AM": 13, "RR": 14, "PA": 15, "AP": 16, "TO": 17,
    "MA": 21, "PI": 22, "CE": 23, "RN": 24, "PB": 25, "PE": 26, "AL": 27, "SE": 28, "BA": 29,
    "MG": 31, "ES": 32, "RJ": 33, "SP": 35,
    "PR": 41, "SC": 42, "RS": 43,
    "MS": 50, "MT": 51, "GO": 52, "DF": 53,
}
UNITS_PER_STATE = {
    "RO": 52, "AC": 22, "AM": 62, "RR": 15, "PA": 144, "AP": 16, "TO": 139,
    "MA": 217, "PI": 224, "CE": 184, "RN": 167, "PB": 223, "PE": 185, "AL": 102, "SE": 75, "BA": 417,
    "MG": 853, "ES": 78, "RJ": 92, "SP": 645,
    "PR": 399, "SC": 295, "RS": 497,
    "MS": 79, "MT": 141, "GO": 246, "DF": 1,
}
STATE_NAMES = {
    "RO": "Rondônia", "AC": "Acre", "AM": "Amazonas", "RR": "Roraima", "PA": "Pará", "AP": "Amapá", "TO": "Tocantins",
    "MA": "Maranhão", "PI": "Piauí", "CE": "Ceará", "RN": "Rio Grande do Norte", "PB": "Paraíba", "PE": "Pernambuco",
    "AL": "Alagoas", "SE": "Sergipe", "BA": "Bahia",
    "MG": "Minas Gerais", "ES": "Espírito Santo", "RJ": "Rio de Janeiro", "SP": "São Paulo",
    "PR": "Paraná", "SC": "Santa Catarina", "RS": "Rio Grande do Sul",
    "MS": "Mato Grosso do Sul", "MT": "Mato Grosso", "GO": "Goiás", "DF": "Distrito Federal",
}
REGIONS = {
    "Norte": ["RO", "AC", "AM", "RR", "PA", "AP", "TO"],
    "Nordeste": ["MA", "PI", "CE", "RN", "PB", "PE", "AL", "SE", "BA"],
    "Sudeste": ["MG", "ES", "RJ", "SP"],
    "Sul": ["PR", "SC", "RS"],
    "Centro-Oeste": ["MS", "MT", "GO", "DF"],
}
REGION_OF_STATE = {uf: region for region, ufs in REGIONS.items() for uf in ufs}

# Institutions kept, and the two categories.
COOPERATIVE_SEGMENT = "Cooperativa de Crédito"
CATEGORY_COOPERATIVE = "Cooperativa de Crédito"
CATEGORY_BANK = "Banco"
BANK_BRANDS = {
    "BANCO DO BRASIL S.A.": "Banco do Brasil",
    "BANCO BRADESCO S.A.": "Bradesco",
    "ITAÚ UNIBANCO S.A.": "Itaú",
    "CAIXA ECONOMICA FEDERAL": "Caixa",
    "BANCO SANTANDER (BRASIL) S.A.": "Santander",
}

# Brand rules in order; the id roots of the affiliates of one brand come before any name.
AFFILIATE_ROOTS = {
    "Ailos": [
        "05463212", "03427097", "03461243", "10218474", "05979692", "08850613", "09590601", "09512539",
        "62109566", "10143743", "10311218", "08075352", "02405189", "82639451", "16779741",
    ],
}
BRAND_RULES = [
    ("Sicredi", r"\bSICREDI\b"),
    ("Sicoob", r"\bSICOOB\b"),
    ("Cresol", r"\bCRESOL\b"),
    ("Unicred", r"\bUNICRED\b"),
    ("Ailos", r"\bAILOS\b"),
]
OTHER_COOPERATIVE = "Outra Cooperativa"
DISPLAY_RULES = [
    ("Credicoamo", r"\bCREDICOAMO\b"),
    ("Uniprime", r"\bUNIPRIME\b"),
    ("Sulcredi", r"\bSULCREDI\b"),
    ("Sisprime", r"\bSISPRIME\b"),
    ("Lar Credi", r"\bLAR CREDI\b"),
    ("Credi&Gente", r"\bCREDI&GENTE\b"),
    ("Credisis", r"\bCREDISIS\b"),
    ("Crediseara", r"\bCREDISEARA\b"),
    ("Greencred", r"\bGREENCRED\b"),
    ("Servicoop", r"\bSERVICOOP\b"),
    ("Minuano", r"\bMINUANO\b"),
    ("Crehnor", r"\bCREHNOR\b"),
    ("Coopavel", r"\bCOOPAVEL\b"),
    ("Cooperforte", r"\bCOOPERFORTE\b"),
    ("Cogem", r"\bCOGEM\b"),
    ("Credicebrace", r"\bCREDICEBRACE\b|\bCEBRACE\b"),
    ("Coopesf", r"\bCOOPESF\b"),
    ("Coopnore", r"\bCOOPNORE\b"),
    ("Coopcrece", r"\bCOOPCRECE\b"),
    ("Cooperalfa", r"\bCOOPERALFA\b"),
]

# Column suffix of each brand, in panel order.
BRAND_SUFFIX = {
    "Sicredi": "sicredi", "Sicoob": "sicoob", "Cresol": "cresol", "Ailos": "ailos", "Unicred": "unicred",
    "Outra Cooperativa": "outra_coop",
    "Banco do Brasil": "bb", "Bradesco": "bradesco", "Itaú": "itau", "Caixa": "caixa", "Santander": "santander",
}

# Address vocabulary of the street key.
STREET_TYPES = [
    "RUA", "AVENIDA", "PRACA", "RODOVIA", "ESTRADA", "TRAVESSA", "ALAMEDA", "LARGO", "LINHA", "BECO", "PASSAGEM",
    "VIELA", "SERVIDAO", "ACESSO", "CAMINHO", "MARGINAL", "VIA", "VIADUTO", "LOTEAMENTO", "CONDOMINIO",
]
ABBREVIATIONS = {
    "R": "RUA", "RU": "RUA", "AV": "AVENIDA", "AVE": "AVENIDA", "AVEN": "AVENIDA", "PCA": "PRACA", "PC": "PRACA",
    "PRC": "PRACA", "ROD": "RODOVIA", "EST": "ESTRADA", "ESTR": "ESTRADA", "TV": "TRAVESSA", "TRAV": "TRAVESSA",
    "AL": "ALAMEDA", "LGO": "LARGO", "SERV": "SERVIDAO", "LOT": "LOTEAMENTO",
    "GAL": "GENERAL", "GEN": "GENERAL", "CEL": "CORONEL", "CAP": "CAPITAO", "MAL": "MARECHAL", "MAR": "MARECHAL",
    "ALM": "ALMIRANTE", "TEN": "TENENTE", "SGT": "SARGENTO", "BRIG": "BRIGADEIRO", "DR": "DOUTOR", "DRA": "DOUTORA",
    "PROF": "PROFESSOR", "PROFA": "PROFESSORA", "ENG": "ENGENHEIRO", "PE": "PADRE", "MON": "MONSENHOR",
    "SEN": "SENADOR", "DEP": "DEPUTADO", "VER": "VEREADOR", "PRES": "PRESIDENTE", "GOV": "GOVERNADOR",
    "PREF": "PREFEITO", "MIN": "MINISTRO", "CONS": "CONSELHEIRO", "DES": "DESEMBARGADOR", "BAR": "BARAO",
    "VISC": "VISCONDE", "CDE": "CONDE", "STA": "SANTA", "STO": "SANTO", "NSA": "NOSSA", "NS": "NOSSA",
    "EXP": "EXPEDICIONARIO", "IRM": "IRMAO", "JR": "JUNIOR",
}
ROMANS = {
    "II": "DOIS", "III": "TRES", "IV": "QUATRO", "VI": "SEIS", "VII": "SETE", "VIII": "OITO", "IX": "NOVE",
    "XI": "ONZE", "XII": "DOZE", "XIII": "TREZE", "XIV": "QUATORZE", "XV": "QUINZE", "XVI": "DEZESSEIS",
    "XVII": "DEZESSETE", "XVIII": "DEZOITO", "XIX": "DEZENOVE", "XX": "VINTE", "XXI": "VINTE E UM",
    "XXV": "VINTE E CINCO", "XXX": "TRINTA",
}
ARTICLES = ["DE", "DA", "DO", "DAS", "DOS", "E", "DEL", "D"]

# Precision levels from the tightest to the loosest, their descriptions and fan-out radii in metres.
EXACT, STREET, LOCALITY, UNIT = "endereço", "logradouro", "localidade", "município"
PRECISION_LEVELS = [EXACT, STREET, LOCALITY, UNIT]
PRECISION_TEXT = {
    EXACT: "endereço do imóvel (CNEFE/IBGE, Censo 2022)",
    STREET: "logradouro — posição aproximada dentro da rua",
    LOCALITY: "área urbana do município — logradouro não localizado",
    UNIT: "município — endereço não localizado no CNEFE",
}
FAN_OUT_METRES = {EXACT: 8.0, STREET: 20.0, LOCALITY: 60.0, UNIT: 120.0}
METRES_PER_DEGREE = 111_320.0

# The default sequential palette.
PALETTE = ["#c9ece5", "#9addd2", "#63c4be", "#31a1a4", "#1a7583", "#0a4655"]
ZERO_COLOUR = "#eef1f1"
