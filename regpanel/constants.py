"""Fixed values.

These must equal the source's values for the results to match, so they are
stated here plainly, in natural order, in one place.
"""

# Text that precedes the measure name in cell (1, 1) of a crosstab sheet.
MEASURE_MARKER = "Variável - "

# Missing-value token in landed indicator files.
MISSING_TOKEN = "SIN DATOS"

# Region label meaning "no information" (dropped before shares).
NO_INFO_REGION = "Sin Información"

# Crosstab block layout — size bands per (year, sector) block and
# blocks per sheet row (years x sectors).
BLOCK_BANDS = 9
BLOCK_GROUPS = 336

# Size-band recode, applied in this order.
BAND_RECODE = [("-", " a "), ("GE", "+")]

# Quadrant labels (high/high, low/high, high/low, low/low).
QUADRANT_LABELS = ("A: Alto PyME / Alto PBI", "B: Bajo PyME / Alto PBI",
                   "C: Alto PyME / Bajo PBI", "D: Bajo PyME / Bajo PBI")

# Label truncation for legends (width, ellipsis, centre).
TRUNC_WIDTH = 20
TRUNC_ELLIPSIS = ".."

# Random seed of the exploratory samples.
SAMPLE_SEED = 1922

# Control period (inclusive years).
CONTROL_PERIOD = (2008, 2023)

# NUTS-2 codes of the Spanish regions.
ES_NUTS2 = ["ES11", "ES12", "ES13", "ES21", "ES22", "ES23", "ES24", "ES30", "ES41", "ES42",
            "ES43", "ES51", "ES52", "ES53", "ES61", "ES62", "ES63", "ES64", "ES70"]

# NUTS-2 codes of the Italian regions.
IT_NUTS2 = ["ITC1", "ITC2", "ITC3", "ITC4", "ITH1", "ITH2", "ITH3", "ITH4", "ITH5",
            "ITI1", "ITI2", "ITI3", "ITI4", "ITF1", "ITF2", "ITF3", "ITF4", "ITF5", "ITF6",
            "ITG1", "ITG2"]

# EU control datasets for Spain — (dataset id, measure name, dimension filters).
ES_EU_SPECS = [
    ("nama_10r_2hhinc", "renta_media_hogar", {"unit": "EUR_HAB", "direct": "BAL", "na_item": "B5N"}),
    ("nama_10r_3gdp", "pbi_per_capita", {"unit": "EUR_HAB"}),
    ("demo_r_d3dens", "densidad_pobl", {}),
]

# EU control datasets for Italy — (dataset id, measure name, dimension filters).
IT_EU_SPECS = [
    ("nama_10r_2hhinc", "renta_media_hogar", {"unit": "EUR_HAB", "direct": "BAL", "na_item": "B5N"}),
    ("nama_10r_3gdp", "pbi_per_capita", {"unit": "EUR_HAB"}),
    ("demo_r_d3dens", "densidad_pobl", {}),
    ("demo_r_pjangrp3", "poblacion_total", {"unit": "NR", "sex": "T", "age": "TOTAL"}),
    ("crim_gen_reg", "tasa_criminalidad", {"unit": "P_HTHAB"}),
    ("ilc_li41", "tasa_pobreza", {"unit": "PC"}),
]

# Spanish national files — (file stem, measure name, unit column).
ES_NATIONAL_FILES = [
    ("tasa_homicidios", "tasa_homicidios", "tipo de tasa"),
    ("tasa_criminalidad", "tasa_criminalidad", "tipo de tasa"),
    ("tasa_pobreza", "tasa_pobreza", "tasa de riesgo de pobreza"),
    ("poblacion_total", "pobl_total", "sexo"),
]

# Recode of national region names to the EU spelling (first match
# wins, default = the transliterated name), as the source writes it.
ES_REGION_RECODE = [
    ("Asturias", "Principado de Asturias"),
    ("Balears", "Illes Balears "),
    ("Castilla - La Mancha", "Castilla-La Mancha"),
    ("Valenciana", "Comunidad Valenciana"),
    ("Madrid", "Comunidad de Madrid"),
    ("Murcia", "Región de Murcia"),
    ("Navarra", "Comunidad Foral de Navarra"),
    ("Rioja", "La Rioja"),
    ("Ceuta", "Ciudad Autónoma de Ceuta"),
    ("Melilla", "Ciudad Autónoma de Melilla"),
]

# Brazilian state series — code -> output column.
BR_SERIES = {
    "PNADCA_GINIUF": "gini",
    "PIBPCE": "pib_per_capita",
    "PNADCA_TXPNUF": "tasa_pobr",
    "ADH12_POPTOT": "pobl_total",
    "PNADCT_TXINFORMUF": "tasa_informalidad",
    "IDHMRE": "idh",
    "SIS_RDPCMEDIO": "ingreso_medio",
    "PNADCA_NMAE25UF": "prom_anio_estudio",
    "THOMIC": "tasa_homicidios",
}
