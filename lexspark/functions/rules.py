r"""Rule tables of Brazilian legal text. All values in this module are fixed: patterns, word lists and tables that results depend on.

Patterns are Java regular expressions; ``(?iuU)`` ignores case beyond ASCII.
"""

# --- devices of a statute -------------------------------------------------------------------
ROMAN_LIMIT = 80


def roman(n: int) -> str:
    out = ""
    for value, sign in ((100, "C"), (90, "XC"), (50, "L"), (40, "XL"), (10, "X"), (9, "IX"), (5, "V"), (4, "IV"), (1, "I")):
        while n >= value:
            out, n = out + sign, n - value
    return out


ROMANS = [roman(n) for n in range(1, ROMAN_LIMIT + 1)]
_ANY_ROMAN = "|".join(sorted(ROMANS, key=len, reverse=True))

ARTICLE = r"(?iuU)^\s*Art\.\s*(\d+(?:\.\d+)*)[º°o]?(-[A-Za-z]+)?[\w-]*[.\s]"
PARAGRAPH = r"(?iuU)^\s*(§\s*(\d+)[º°o]?\.?\s|Par[aá]grafo\s+[uú]nico)"
INCISO = rf"(?U)^\s*({_ANY_ROMAN})\s*[-–—]\s?"
ALINEA = r"(?U)^\s*([a-z])\)\s"
SUMMARY_LINE = r"(?U)\.{5,}|\s_\s|\s-\s{2,}"
METADATA_WORDS = ("DIÁRIO OFICIAL DA UNIÃO", "Publicado em:", "Imprensa Nacional", "https://", "http://")
METADATA_STAMP = r"^\d{2}/\d{2}/\d{4},?\s+\d{2}:\d{2}"
PAGINATION = r"(?iuU)^(p[áa]ginas?|p[áa]g\.?|fls?\.?)?\s*\d+(?:\s*(?:/|de)\s*\d+)?\s*$"
ISSUER = r"(?iuU)^\s*[OÓ]rg[aã]o\s*:"
NORM_NAME = r"(?iuU)^\s*(INSTRUÇÃO NORMATIVA|DECRETO|LEI\s+(COMPLEMENTAR\s+)?N[º°]|PORTARIA|RESOLUÇÃO)"
PREAMBLE = (
    r"(?iuU)^\s*O\s+(SECRETÁRI[OA]|MINISTRO|PRESIDENTE|DIRETOR)",
    r"(?iuU)^\s*(RESOLVE|CONSIDERANDO)",
    r"(?iuU)no uso d[ea]s?\s+atribuiç",
    r"(?iuU)resolve\s*:",
)
SUMMARY_VERB = r"(?iuU)^\s*(Dispõe|Altera|Regulamenta|Estabelece|Institui)\s+"
CHAPTER = r"(?iuU)^\s*CAP[ÍI]TULO\s"
ALL_CAPS = r"^[A-ZÁÉÍÓÚÂÊÔÃÕÇ\s\-–—/,.:;()]+$"
LEGAL_MARKER = rf"(?iuU)^\s*(Art\.|§|(?:{_ANY_ROMAN})\s*[-–—]|[a-z]\)|\d+\.)"
#: As the marker reads without grouping its numerals: any text that begins with one of them.
LEGAL_MARKER_COMPAT = rf"(?iuU)^\s*(Art\.|§|{_ANY_ROMAN}\s*[-–—]|[a-z]\)|\d+\.)"
BROWSER_HEADER = r"^((?:\d{2}/\d{2}/\d{4},?\s+\d{2}:\d{2}[^\n]*\n)(?:[^\n]*(?:https?://|\.gov\.br|\.htm)[^\n]*\n)?(?:[^\n]*\d+\s*/\s*\d+[^\n]*\n)?)"
EXPIRED = "vigência encerrada"
OPEN_ENDED = (
    r"(?iuU)(?:,\s*$|(?<![\p{L}\p{N}_])(?:e|ou|a|o|os|as|de|do|da|dos|das|no|na|nos|nas|ao|aos|à|às|em|com|por|para|que|se|como|sobre|entre|sob|sem|até"
    r"|pelo|pela|pelos|pelas|seu|sua|seus|suas|um|uma|uns|umas|cujo|cuja|cujos|cujas|quando|onde|qual|quais|conforme|mediante|perante)\s*$)"
)
MERGE_GAP = 1500
SPLIT_REST = 20
DEVICE_ORDER = {"ART": 0, "INC": 1, "ALI": 2, "PAR": 3}

# --- types of relation, first match wins ----------------------------------------------------
REL_TYPES = (
    (r"(?:fica[mn]?\s+)?revogad[oa]s?(?:\s+expressamente)?", "REVOGA_EXPRESSAMENTE", 0.95),
    (r"revoga(?:m|-se)?\s+(?:o\s+)?(?:art|§|inciso|al[ií]nea)", "REVOGA_EXPRESSAMENTE", 0.90),
    (r"revoga[çc][aã]o\s+(?:expressa|total|integral)", "REVOGA_EXPRESSAMENTE", 0.92),
    (r"passa[mn]?\s+a\s+vigorar\s+com\s+(?:a\s+seguinte\s+)?reda[çc][aã]o", "ALTERA_EXPRESSAMENTE", 0.95),
    (r"altera(?:m|-se)?\s+(?:o\s+)?(?:art|§|inciso|al[ií]nea|caput)", "ALTERA_EXPRESSAMENTE", 0.90),
    (r"nova\s+reda[çc][aã]o\s+(?:d[oa]\s+)?(?:art|§|inciso|al[ií]nea)", "ALTERA_EXPRESSAMENTE", 0.88),
    (r"(?:d[aá]\s+)?nova\s+reda[çc][aã]o\s+a[os]?", "ALTERA_EXPRESSAMENTE", 0.85),
    (r"altera[çc][aã]o\s+(?:expressa|do\s+art)", "ALTERA_EXPRESSAMENTE", 0.85),
    (r"regulamenta(?:r)?\s+(?:a\s+|o\s+)?(?:lei|art)", "REGULAMENTA", 0.90),
    (r"(?:este|esta)\s+(?:decreto|instru[çc][aã]o|portaria|resolu[çc][aã]o)\s+regulamenta", "REGULAMENTA", 0.95),
    (r"para\s+fins\s+de\s+regulamenta[çc][aã]o", "REGULAMENTA", 0.85),
    (r"salvo\s+(?:o\s+)?(?:disposto|previsto|estabelecido)", "EXCEPCIONA", 0.92),
    (r"exceto\s+(?:o\s+)?(?:disposto|previsto|estabelecido|quando|nos?\s+casos?)", "EXCEPCIONA", 0.90),
    (r"ressalvad[oa]s?\s+(?:o\s+)?(?:disposto|previsto|art)", "EXCEPCIONA", 0.88),
    (r"com\s+exce[çc][aã]o\s+d[eo]", "EXCEPCIONA", 0.85),
    (r"excepcionalmente", "EXCEPCIONA", 0.75),
    (r"nos\s+termos\s+(?:d[oa]\s+)?(?:art|§|inciso|lei|decreto)", "DEPENDE_DE", 0.85),
    (r"na\s+forma\s+(?:d[oa]\s+)?(?:art|§|inciso|lei|decreto|regulamento)", "DEPENDE_DE", 0.85),
    (r"observad[oa]s?\s+(?:o\s+)?(?:disposto|previsto|art|§)", "DEPENDE_DE", 0.82),
    (r"atendid[oa]s?\s+(?:o\s+)?(?:disposto|previsto|requisitos?)", "DEPENDE_DE", 0.80),
    (r"em\s+conson[aâ]ncia\s+com", "DEPENDE_DE", 0.78),
    (r"de\s+acordo\s+com\s+(?:o\s+)?(?:art|§|disposto|previsto)", "DEPENDE_DE", 0.80),
    (r"(?:conforme|v(?:ide|er))\s+(?:o\s+)?(?:art|§|inciso|disposto)", "REFERENCIA", 0.75),
    (r"(?:mencionad[oa]|referid[oa]|citad[oa])\s+(?:no|na|n[oa]s?)\s+(?:art|§|inciso)", "REFERENCIA", 0.70),
    (r"a\s+que\s+(?:se\s+)?refere\s+(?:o\s+)?(?:art|§|inciso)", "REFERENCIA", 0.72),
)
REL_DEFAULT, REL_WINDOW = ("CITA", 0.5), 120
#: Relations that change what a norm says, all relations, and the least confidence at which an expansion follows each.
REL_IMPACT = ("REVOGA_EXPRESSAMENTE", "ALTERA_EXPRESSAMENTE", "REGULAMENTA", "EXCEPCIONA", "DEPENDE_DE")
REL_BROAD = (*REL_IMPACT, "REFERENCIA", "CITA")
REL_FLOORS = {**dict.fromkeys(REL_IMPACT, 0.80), "REFERENCIA": 0.0, "CITA": 0.0}
REL_DESCRIPTIONS = {
    "CITA": "Citação genérica",
    "REFERENCIA": "Menção sem efeito jurídico",
    "ALTERA_EXPRESSAMENTE": "Alteração expressa de dispositivo",
    "REVOGA_EXPRESSAMENTE": "Revogação expressa de dispositivo",
    "REGULAMENTA": "Regulamentação de norma superior",
    "DEPENDE_DE": "Dependência condicional",
    "EXCEPCIONA": "Exceção a regra geral",
    "REVOGA_TACITAMENTE": "Revogação tácita (requer análise manual)",
}

# --- norms that citations name --------------------------------------------------------------
#: (type, pattern; group 1 is the number, group 2 a year) in order of precedence, for Python's re with IGNORECASE.
NORMS = (
    ("LC", r"Lei\s+Complementar\s+(?:n[ºo°]?\s*)?(\d+[\d\.]*)"),
    ("LC", r"LC\s+(?:n[ºo°]?\s*)?(\d+[\d\.]*)"),
    ("LEI", r"Lei\s+(?:Federal\s+)?(?:n[ºo°]?\s*)?(\d+[\d\.]*)"),
    ("LEI", r"Lei\s+(\d+[\d\.]*)(?:/(\d{2,4}))?"),
    ("DL", r"Decreto[-\s]Lei\s+(?:n[ºo°]?\s*)?(\d+[\d\.]*)"),
    ("DL", r"DL\s+(?:n[ºo°]?\s*)?(\d+[\d\.]*)"),
    ("DECRETO", r"Decreto\s+(?:Federal\s+)?(?:n[ºo°]?\s*)?(\d+[\d\.]*)"),
    ("IN", r"Instru[çc][aã]o\s+Normativa\s+(?:[\w\-/]+\s+)?(?:n[ºo°]?\s*)?(\d+)"),
    ("IN", r"IN\s+(?:[\w\-/]+\s+)?(?:n[ºo°]?\s*)?(\d+)"),
    ("PORTARIA", r"Portaria\s+(?:[\w\-/]+\s+)?(?:n[ºo°]?\s*)?(\d+)"),
    ("RESOLUCAO", r"Resolu[çc][aã]o\s+(?:[\w\-/]+\s+)?(?:n[ºo°]?\s*)?(\d+)"),
    ("ACORDAO", r"Ac[oó]rd[aã]o\s+(?:n[ºo°]?\s*)?(\d+)"),
    ("ACORDAO", r"Ac[oó]rd[aã]o\s+(\d+)(?:/(\d{4}))?(?:\s*[-–]\s*(\w+))?"),
    ("MP", r"Medida\s+Provis[oó]ria\s+(?:n[ºo°]?\s*)?(\d+[\d\.]*)"),
    ("MP", r"MP\s+(?:n[ºo°]?\s*)?(\d+[\d\.]*)"),
    ("EC", r"Emenda\s+Constitucional\s+(?:n[ºo°]?\s*)?(\d+)"),
    ("EC", r"EC\s+(?:n[ºo°]?\s*)?(\d+)"),
    ("CF", r"Constitui[çc][aã]o\s+(?:Federal|da\s+Rep[úu]blica)?"),
    ("CF", r"\bCF(?:/\d{2,4})?\b"),
)
YEAR_AFTER = r"[/\s](\d{2,4})"
NORM_YEARS = {
    ("LEI", "8666"): 1993, ("LEI", "10520"): 2002, ("LEI", "12462"): 2011, ("LEI", "13303"): 2016, ("LEI", "14133"): 2021,
    ("LEI", "8429"): 1992, ("LEI", "9784"): 1999, ("LEI", "12527"): 2011, ("LEI", "13709"): 2018, ("LEI", "4320"): 1964,
    ("LEI", "8112"): 1990, ("LEI", "10406"): 2002, ("LEI", "5172"): 1966, ("LEI", "6404"): 1976, ("LEI", "9472"): 1997,
    ("LEI", "9478"): 1997, ("LEI", "11079"): 2004, ("LEI", "11107"): 2005, ("LEI", "8987"): 1995, ("LEI", "13019"): 2014,
    ("LC", "101"): 2000, ("LC", "123"): 2006, ("LC", "116"): 2003, ("LC", "87"): 1996,
    ("DECRETO", "10024"): 2019, ("DECRETO", "10947"): 2022, ("DECRETO", "7892"): 2013, ("DECRETO", "9507"): 2018,
    ("DECRETO", "8538"): 2015, ("DECRETO", "6170"): 2007, ("DECRETO", "93872"): 1986,
    ("IN", "5"): 2017, ("IN", "40"): 2020, ("IN", "58"): 2022, ("IN", "65"): 2021, ("IN", "73"): 2020, ("IN", "81"): 2022, ("IN", "98"): 2022,
    ("PORTARIA", "938"): 2022, ("PORTARIA", "8678"): 2021,
}
YEAR_BOUNDS = {"LEI": (1824, 2030), "LC": (1967, 2030), "DECRETO": (1889, 2030), "DL": (1937, 1988), "IN": (1990, 2030), "PORTARIA": (1950, 2030), "RESOLUCAO": (1950, 2030), "ACORDAO": (1990, 2030), "MP": (1988, 2030), "EC": (1992, 2030)}
YEAR_BOUNDS_ELSE = (1900, 2030)
COLLECTIONS = {"LEI": "leis", "DECRETO": "leis", "IN": "leis", "LC": "leis", "ACORDAO": "acordaos", "SUMULA": "sumulas"}
DEVICE_CITED = (
    r"(?:arts?\.?|artigos?)\s*(\d+)[ºo°]?(?:\s*,?\s*(?:§|par[aá]grafo)\s*(\d+|[úu]nico)[ºo°]?)?"
    r"(?:\s*,?\s*inciso\s+([IVXLCDM]+))?(?:\s*,?\s*al[ií]nea\s+['\"]?([a-z])['\"]?)?"
)
DEVICE_BEFORE = (
    r"(?:arts?\.?|artigos?)\s*(\d+)[ºo°]?((?:\s*,\s*\d+[ºo°]?)*(?:\s+(?:e|a)\s+\d+[ºo°]?)?)(?:\s*,?\s*(?:§|par[aá]grafo)\s*(\d+|[úu]nico)[ºo°]?)?"
    r"(?:\s*,?\s*inciso\s+([IVXLCDM]+))?(?:\s*,?\s*al[ií]nea\s+['\"]?([a-z])['\"]?)?\s*(?:,\s*)?(?:d[aoe]s?|n[aoe]s?)\s*$"
)
DEVICE_PARTS = (r"(?:arts?\.?|artigos?)\s*(\d+)[ºo°]?", r"(?:§|par[aá]grafo)\s*(\d+|[úu]nico)[ºo°]?", r"inciso\s+([IVXLCDM]+)", r"al[ií]nea\s+['\"]?([a-z])['\"]?")
EXTERNAL_HINTS = ("da lei", "do decreto", "da in", "da portaria", "desta")

# --- provenance -----------------------------------------------------------------------------
TRIGGERS = (
    "passa a vigorar acrescido do seguinte", "passa a vigorar com a seguinte redação", "passam a vigorar com a seguinte redação",
    "fica acrescido do seguinte", "fica acrescida do seguinte", "dá-se a seguinte redação", "a seguinte redação ao",
    "passa a vigorar acrescido de", "com a redação dada por", "na redação da",
)
#: (pattern, id type, has a date group, has a name group), in order.
REFERENCES = (
    (r"(?iuU)da Lei n[ºo°]\s*([\d.]+),?\s*de\s+(.+?)\s*\((.+?)\)", "LEI", True, True),
    (r"(?iuU)da Lei n[ºo°]\s*([\d.]+),?\s*de\s+(.+?)[.,;]", "LEI", True, False),
    (r"(?iuU)do Decreto-Lei n[ºo°]\s*([\d.]+),?\s*de\s+(.+?)\s*\((.+?)\)", "DL", True, True),
    (r"(?iuU)do Decreto n[ºo°]\s*([\d.]+)", "DEC", False, False),
    (r"(?iuU)da Lei Complementar n[ºo°]\s*([\d.]+)", "LC", False, False),
    (r"(?iuU)da Medida Provis[óo]ria n[ºo°]\s*([\d.]+)", "MP", False, False),
)
#: What every match of a kind's patterns begins with in lower case, up to a letter of which Unicode has other forms (i, s).
REFERENCE_STARTS = {"LEI": "da le", "DL": "do decreto-le", "DEC": "do decreto n", "LC": "da le", "MP": "da med"}
KNOWN_REFERENCES = {
    "2.848": ("DL-2848-1940", "Código Penal"),
    "13.105": ("LEI-13105-2015", "Código de Processo Civil"),
    "8.987": ("LEI-8987-1995", "Lei de Concessões"),
    "11.079": ("LEI-11079-2004", "Lei de PPPs"),
    "8.666": ("LEI-8666-1993", "Lei de Licitações (revogada)"),
    "10.520": ("LEI-10520-2002", "Lei do Pregão (revogada)"),
    "12.462": ("LEI-12462-2011", "RDC"),
    "13.303": ("LEI-13303-2016", "Lei das Estatais"),
    "12.232": ("LEI-12232-2010", "Lei de Publicidade Institucional"),
    "11.107": ("LEI-11107-2005", "Lei dos Consórcios Públicos"),
    "10.406": ("LEI-10406-2002", "Código Civil"),
    "5.172": ("LEI-5172-1966", "Código Tributário Nacional"),
    "9.784": ("LEI-9784-1999", "Lei do Processo Administrativo"),
}
ENTER, EXIT, ZONE_TTL, ZONE_WINDOW = 0.60, 0.40, 50, 800

ZONE_ARTICLE = r"(?iuU)Art\.\s*([\d.]+(?:-[A-Z])?)"
ZONE_QUOTE_OPEN = '["“]\\s*[A-Z]'
ZONE_QUOTED_CHAPTER = '(?iuU)["“](CAP[ÍI]TULO|Se[çc][ãa]o|T[ÍI]TULO|LIVRO|PARTE)'
ZONE_ANNEX = r"(?imuU)^\s*ANEXO\s+[IVXLCDM\d]+"
ZONE_NEW_WORDING = '["”]\\s*\\(NR\\)'
ZONE_QUOTE_CLOSE = '(?m)["”]\\s*$'

# --- matching normalisation -----------------------------------------------------------------
OCR_ONE = {
    "\u2013": "-", "\u2014": "-", "\u2015": "-", "\u2010": "-", "\u2011": "-", "\u2012": "-",
    "\u201c": '"', "\u201d": '"', "\u201e": '"', "\u201f": '"', "\u2018": "'", "\u2019": "'", "\u201a": "'", "\u201b": "'",
    "\u00ab": '"', "\u00bb": '"', "\u2039": "'", "\u203a": "'", "\u00ba": "o", "\u00aa": "a", "\u00b0": "o",
    "\u00a0": " ", "\u2002": " ", "\u2003": " ", "\u2009": " ", "\u200a": " ",
}
OCR_DROPPED = "\u00ad\u200b\ufeff"
OCR_ELLIPSIS = ("\u2026", "...")

# --- rulings --------------------------------------------------------------------------------
RULING_HEADER = {
    "processo": r"TC\s+(\d{3}\.\d{3}/\d{4}-\d)",
    "natureza": r"Natureza:\s*(.+?)(?:\n|$)",
    "relator": r"Relator:\s*(?:Ministro\s+)?(.+?)(?:\n|$)",
    "unidade_tecnica": r"(?iuU)Unidade\s+T[eé]cnica:\s*(.+?)(?:\n|$)",
    "data_sessao": r"Data\s+da\s+Sess[aã]o:\s*(\d{1,2}/\d{1,2}/\d{4})",
}
RULING_NUMBER = r"(?iuU)AC[OÓ]RD[AÃ]O\s+(?:N[°ºo.]?\s*)?(\d+)/(\d{4})"
RULING_BODY = r"(?iuU)(Plen[aá]rio|1[ªa]\s*C[aâ]mara|2[ªa]\s*C[aâ]mara|Primeira\s+C[aâ]mara|Segunda\s+C[aâ]mara)"
RULING_SUMMARY = r"(?isuU)SUM[AÁ]RIO:\s*(.+?)(?=\n\s*(?:RELAT[OÓ]RIO|VOTO|AC[OÓ]RD[AÃ]O)\s)"
RULING_OUTCOME = r"(?iuU)considerar\s+(?:a\s+\w+\s+)?(parcialmente\s+procedente|procedente|improcedente)"
RULING_MARKERS = {
    "relatorio": r"(?m)^\s*RELAT[OÓ]RIO\s*$",
    "voto": r"(?m)^\s*VOTO\s*$",
    "acordao": r"(?mi)^\s*AC[OÓ]RD[AÃ]O\s+(?:N[°ºo.]?\s*)?\d+",
}
SECTION_NAMES = {"ementa": "EMENTA", "relatorio": "RELATÓRIO", "voto": "VOTO", "acordao": "ACÓRDÃO"}
AUTHORITY = {"ementa": "metadado", "relatorio": "opinativo", "voto": "fundamentacao", "acordao": "vinculante"}
HEADING_DECIMAL = r"(?m)^([IVX]+\.\d+(?:\.\d+)*)\.\s+(.+)"
HEADING_ROMAN = r"(?m)^([IVX]+)\.\s+(.+)"
HEADING_UPPER = r"(?m)^([A-ZÁÀÂÃÉÊÍÓÔÕÚÇ][A-ZÁÀÂÃÉÊÍÓÔÕÚÇ\s]{3,})$"
NUMBERED = r"(?m)^(\d{1,3})\.\s+"
ITEM = r"(?m)^(\d+\.\d+(?:\.\d+)*)\.\s+"
EMENTA = r"(?si)SUM[AÁ]RIO\s*:\s*(.+?)(?:\n\n|\n(?=RELAT[OÓ]RIO))"

# --- graph and index ------------------------------------------------------------------------
DEVICE_ALIASES = {"art": "ART", "article": "ART", "artigo": "ART", "par": "PAR", "paragraph": "PAR", "paragrafo": "PAR", "parágrafo": "PAR", "inc": "INC", "inciso": "INC", "ali": "ALI", "alinea": "ALI", "alínea": "ALI"}
