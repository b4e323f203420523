"""Lookup tables of the domain.

Everything in this module is a FIXED VALUE: the words, codes and thresholds
below are part of the result contract and must not be reworded.
"""

# --- NR-04 risk grade -> label -------------------------------------------------
RISK_GRADE_LABEL = {1: "Leve", 2: "Medio", 3: "Alto", 4: "Critico"}

# --- accident-notice vocabulary ------------------------------------------------
# Fragment searched in the lower-cased text (in this order) -> accident type.
ACCIDENT_TYPE_BY_FRAGMENT = {
    "pico": "típico",
    "trajeto": "trajeto",
    "doen": "doença",
    "ignora": "ignorado",
}
WORK_ACCIDENT_TYPES = ("típico", "doença")
COMMUTE_ACCIDENT_TYPE = "trajeto"
CAT_SEX = {"Masculino": "M", "Feminino": "F"}
PLACEHOLDER_MARK = "{"
BLANK_OCCUPATION = "000000"
BLANK_ACTIVITY = "0000"

# --- death-certificate vocabulary ----------------------------------------------
SIM_SEX = {"1": "M", "2": "F"}
SIM_WORK_ACCIDENT = {"1": "Sim", "2": "Não", "9": "Ignorado"}
SEX_NOT_INFORMED = "Não informado"
AGE_NOT_INFORMED = "Não informada"
CERTIFICATE_LINES = ("a", "b", "c", "d", "ii")
CERTIFICATE_LINE_LABEL = {
    "a": "Parte I – Linha A (causa imediata)",
    "b": "Parte I – Linha B (causa anterior)",
    "c": "Parte I – Linha C (causa anterior)",
    "d": "Parte I – Linha D (causa originária)",
    "ii": "Parte II – Comorbidades / outras condições",
}

# --- age bands: label -> (first age, last age); None = open end -----------------
AGE_BANDS = {
    "0-17": (0, 17),
    "18-24": (18, 24),
    "25-34": (25, 34),
    "35-44": (35, 44),
    "45-54": (45, 54),
    "55-64": (55, 64),
    "65+": (65, None),
}
OLDEST_CREDIBLE_AGE = 130

# --- CID-10 chapter by first letter, certificate lines --------------------------
CHAPTER_LABEL = {
    "A": "I – Infecciosas e parasitárias",
    "B": "I – Infecciosas e parasitárias",
    "C": "II – Neoplasias malignas",
    "D": "II/III – Neoplasias / Sangue e órgãos hematopoéticos",
    "E": "IV – Endócrinas, nutricionais e metabólicas",
    "F": "V – Transtornos mentais e comportamentais",
    "G": "VI – Doenças do sistema nervoso",
    "H": "VII/VIII – Olho / Ouvido",
    "I": "IX – Doenças do aparelho circulatório",
    "J": "X – Doenças do aparelho respiratório",
    "K": "XI – Doenças do aparelho digestivo",
    "L": "XII – Doenças da pele",
    "M": "XIII – Doenças do sistema osteomuscular",
    "N": "XIV – Doenças do aparelho geniturinário",
    "O": "XV – Gravidez, parto e puerpério",
    "P": "XVI – Afecções do período perinatal",
    "Q": "XVII – Malformações congênitas",
    "R": "XVIII – Sintomas, sinais e achados anormais",
    "S": "XIX – Lesões e traumatismos",
    "T": "XIX/XX – Envenenamentos e causas externas",
    "U": "XXII – Códigos especiais (ex: COVID-19)",
    "V": "XX – Causas externas: acidentes de transporte",
    "W": "XX – Causas externas: quedas e afogamentos",
    "X": "XX – Causas externas: intencionais/indeterminadas",
    "Y": "XX – Causas externas: intenção indeterminada / intervenção",
    "Z": "XXI – Fatores que influenciam o estado de saúde",
}

# --- condition type by first letter, certificate lines --------------------------
CONDITION_LABEL = {
    "A": "Doença crônica/infecciosa",
    "B": "Doença crônica/infecciosa",
    "C": "Neoplasia",
    "D": "Neoplasia/Hematológica",
    "E": "Doença crônica/metabólica",
    "F": "Saúde mental",
    "G": "Doença crônica/neurológica",
    "H": "Doença crônica/sensorial",
    "I": "Doença crônica/cardiovascular",
    "J": "Doença crônica/respiratória",
    "K": "Doença crônica/digestiva",
    "L": "Doença crônica/dermatológica",
    "M": "Doença crônica/osteomuscular",
    "N": "Doença crônica/renal-urológica",
    "O": "Maternidade",
    "P": "Perinatal",
    "Q": "Congênita",
    "R": "Sintoma inespecífico",
    "S": "Traumatismo/Lesão",
    "T": "Intoxicação/Complicação cirúrgica",
    "U": "Código especial",
    "V": "Acidente de transporte",
    "W": "Acidente: queda/afogamento/exposição",
    "X": "Causa externa intencional/indeterminada",
    "Y": "Causa externa: intenção indeterminada/intervenção médica",
    "Z": "Histórico clínico/situacional",
}
UNCLASSIFIED = "Não classificado"

# --- CID-10 chapter by first letter, comorbidities ------------------------------
COMORBIDITY_CHAPTER_LABEL = {
    "A": "I – Infecciosas e parasitárias",
    "B": "I – Infecciosas e parasitárias",
    "C": "II – Neoplasias",
    "D": "II/III – Neoplasias / Sangue",
    "E": "IV – Endócrinas, nutricionais e metabólicas",
    "F": "V – Transtornos mentais",
    "G": "VI – Sistema nervoso",
    "H": "VII/VIII – Olho / Ouvido",
    "I": "IX – Aparelho circulatório",
    "J": "X – Aparelho respiratório",
    "K": "XI – Aparelho digestivo",
    "L": "XII – Pele",
    "M": "XIII – Osteomuscular",
    "N": "XIV – Aparelho geniturinário",
    "O": "XV – Gravidez e parto",
    "P": "XVI – Afecções perinatais",
    "Q": "XVII – Malformações congênitas",
    "R": "XVIII – Sintomas e sinais",
}
COMORBIDITY_CHAPTER_OTHER = "Outro"
NOT_A_COMORBIDITY = ("S", "T", "V", "W", "X", "Y", "Z")

# --- external causes of death ---------------------------------------------------
EXTERNAL_CAUSE_LABEL = {
    "S": "Traumatismo",
    "T": "Envenenamento / Queimadura / Complicacao cirurgica",
    "V": "Acidente de transporte",
    "W": "Queda / Afogamento / Exposicao",
    "X": "Causa externa intencional ou indeterminada",
    "Y": "Intencao nao determinada / Complicacao medica",
}

# --- death categories -----------------------------------------------------------
# 1. any of these first letters together with a declared work accident
WORK_DEATH_LETTERS = ("V", "W", "X", "Y")
WORK_DEATH = "Acidental – Trabalho"
# 2. by first letter, ahead of the code ranges
TRANSPORT_AND_FALL_DEATH = {
    "V": "Acidental – Trânsito",
    "W": "Acidental – Queda / Afogamento",
}
# 3. by inclusive code range
DEATH_BY_RANGE = {
    ("X60", "X84.9"): "Suicídio",
    ("X85", "Y09.9"): "Homicídio / Agressão",
    ("Y10", "Y34.9"): "Causa externa – Intenção indeterminada",
    ("Y83", "Y84.9"): "Complicação de procedimento médico",
}
# 4. by first letter, whatever is left
DEATH_BY_LETTER = {
    "Y": "Causa externa – Outra (Y)",
    "X": "Causa externa – Outra (X)",
    "S": "Traumatismo / Lesão (S)",
    "T": "Intoxicação / Queimadura / Complicação cirúrgica (T)",
    "Z": "Fator situacional / Histórico (Z)",
    "A": "Natural – I: Infecciosas",
    "B": "Natural – I: Infecciosas",
    "C": "Natural – II/III: Neoplasias",
    "D": "Natural – II/III: Neoplasias",
    "E": "Natural – IV: Endócrinas/Metabólicas",
    "F": "Natural – V: Transtornos mentais",
    "G": "Natural – VI: Sistema nervoso",
    "H": "Natural – VII/VIII: Olho/Ouvido",
    "I": "Natural – IX: Cardiovascular",
    "J": "Natural – X: Respiratório",
    "K": "Natural – XI: Digestivo",
    "L": "Natural – XII: Pele",
    "M": "Natural – XIII: Osteomuscular",
    "N": "Natural – XIV: Geniturinário",
    "O": "Natural – XV: Maternidade",
    "P": "Natural – XVI: Perinatal",
    "Q": "Natural – XVII: Congênita",
    "R": "Natural – XVIII: Sintomas inespecíficos",
    "U": "Natural – XXII: Especial (COVID-19)",
}

# --- risk score -----------------------------------------------------------------
# Upper limits (exclusive) of scores 1..4 and the fatality limit of the
# aggravator, in parts per million.
SCORE_LIMITS_PPM = (3000, 6000, 10000, 15000)
FATALITY_LIMIT_PPM = 10000
TOP_SCORE = 5
REASON_WITHOUT_SCORE = "Sem acidentes típicos/doença registrados"
