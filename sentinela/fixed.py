"""Fixed values.

These values must equal the ones the original monthly jobs use, otherwise
results differ. They are stated here once, as plain text, in their natural
order. Everything else in the package is derived from them or passed in.
"""

# --- fixed values: disease case tables ------------------------------------

# Health region whose municipalities are kept (compared upper-case, no trim).
REGION = "SOROCABA"

# Month abbreviations of the wide case tables, January to December, and the
# two-digit month each stands for.
MONTHS = {
    "jan": "01", "fev": "02", "mar": "03", "abr": "04", "mai": "05", "jun": "06",
    "jul": "07", "ago": "08", "set": "09", "out": "10", "nov": "11", "dez": "12",
}

# Wrongly decoded municipality names and their repaired spelling.
TEXT_REPAIRS = {
    "AlumÃ­nio": "Alumínio",
    "AraÃ§ariguama": "Araçariguama",
    "AraÃ§oiaba da Serra": "Araçoiaba da Serra",
    "IbiÃºna": "Ibiúna",
    "IperÃ³": "Iperó",
    "SÃ£o Roque": "São Roque",
    "TapiraÃ­": "Tapiraí",
    "TietÃª": "Tietê",
}

# Leading municipality code removed from town names.
CODE_PREFIX = "^[0-9]+ "

# Bronze column names: coluna_0 is the municipality, coluna_1..coluna_36 the
# twelve monthly triples, coluna_37 the year.
BRONZE_PREFIX = "coluna_"
N_BRONZE_VALUES = 36
YEAR_COLUMN = "coluna_37"

# Page layouts of the published yearly tables, one row per disease and year:
# disease, year, first data row, end row (exclusive, None = to the end),
# region column, municipality column, value cells, strip leading code.
LAYOUT_TABLE = [
    ("dengue", 2020, 5, None, 5, 6, 36, True),
    ("dengue", 2021, 5, None, 2, 3, 36, False),
    ("dengue", 2022, 5, None, 5, 6, 36, True),
    ("dengue", 2023, 5, None, 5, 6, 36, True),
    ("dengue", 2024, 5, None, 5, 6, 15, True),
    ("chikungunya", 2020, 5, None, 5, 6, 36, True),
    ("chikungunya", 2021, 5, None, 2, 3, 36, False),
    ("chikungunya", 2022, 5, None, 5, 6, 36, True),
    ("chikungunya", 2023, 5, None, 5, 6, 36, True),
    ("chikungunya", 2024, 5, None, 5, 6, 15, True),
    ("zika", 2020, 4, 649, 5, 6, 36, True),
    ("zika", 2021, 5, None, 2, 3, 36, True),
    ("zika", 2022, 5, None, 2, 3, 36, True),
    ("zika", 2023, 5, None, 2, 3, 36, True),
    ("zika", 2024, 6, None, 2, 3, 15, False),
]

# --- fixed values: layer folders -------------------------------------------

LAND = "0. land"
BRONZE = "1. bronze"
SILVER = "2. silver"
GOLD = "3. gold"

# --- fixed values: weather station files -----------------------------------

STATION = "SE_SP_A713_SOROCABA"
EXTRA_STATION = "SE_SP_A713_IPERO"
EXTRA_WINDOW = ("2024-01-01", "2024-06-30")
WINDOWS_START = "2020-01-01"
STATION_FILE = "INMET_{station}_{start}_A_{end}.CSV"
STATION_FILE_DATE = "dd-MM-yyyy"
STATION_SEPARATOR = ";"
STATION_ENCODING = "ISO-8859-1"
STATION_PREAMBLE_LINES = 8
STATION_HEADER_FIRST_FIELD = "Data"

# Field position in a station line -> column name (position 1, the UTC hour,
# is read but not kept).
STATION_FIELDS = {
    0: "data",
    1: "hora_utc",
    2: "precipitacao_total",
    4: "pressao_atmosferica_max",
    5: "pressao_atmosferica_min",
    9: "temp_max",
    10: "temp_min",
    15: "umidade_relativa_ar",
}
STATION_MEASURES = [
    "precipitacao_total",
    "pressao_atmosferica_max",
    "pressao_atmosferica_min",
    "temp_max",
    "temp_min",
    "umidade_relativa_ar",
]
# Daily roll-up function per measure.
DAILY_AGGS = {
    "precipitacao_total": "sum",
    "pressao_atmosferica_max": "max",
    "pressao_atmosferica_min": "min",
    "temp_max": "max",
    "temp_min": "min",
    "umidade_relativa_ar": "mean",
}

# --- fixed values: missing-value spellings ---------------------------------

# Cell texts a spreadsheet reader takes for "missing" by default (pandas'
# public default NA list); they become NULL and later the bronze fill value.
NA_STRINGS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]
