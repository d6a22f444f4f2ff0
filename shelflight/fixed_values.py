"""Labels, codes, limits, patterns and mappings that results depend on.

Nothing here is computed.  The texts are part of the data contract (stored
category labels, spec names as shops print them, band labels in reports), so
they must stay letter for letter as they are.
"""

# Energy classes from worst to best; the code is the position, from 1.
ENERGY_CLASSES = ["G", "F", "E", "D", "C", "B", "A", "A+", "A++", "A+++"]

# Fixed value: script call that carries one chunk of a page's data as a JSON string.
SCRIPT_CHUNK = r'self\.__next_f\.push\(\[1,(".*?")\]\)'


# Price bands as (inclusive upper edge, label); the last one is open.
PRICE_BANDS = [
    (30_000, "≤ 30.000"),
    (100_000, "30.001–100.000"),
    (300_000, "100.001–300.000"),
    (None, "≥ 300.000"),
]

# Columns a clean record must have, and the optional technical ones.
OPTIONAL_COLUMNS = ["energetska_klasa", "dijagonala_inch", "kapacitet_kg", "zapremina_l", "snaga_w"]
MIN_OPTIONAL_FILLED = 0
MIN_PRICE = 1000.0
MIN_CLEAN_ROWS = 7000

# Possible range of each technical column.
TECHNICAL_RANGES = {
    "dijagonala_inch": (10, 120),
    "kapacitet_kg": (1, 30),
    "zapremina_l": (10, 1000),
    "snaga_w": (1, 12000),
}

# Numeric columns of the model, in their order.
TECHNICAL_COLUMNS = ["energetska_klasa_num", "dijagonala_inch", "kapacitet_kg", "zapremina_l", "snaga_w"]

# Names of the ten reports.
REPORT_NAMES = [
    "broj_po_kategoriji",
    "top10_brendovi",
    "energ_klasa_C_ili_bolje",
    "cena_do_50000",
    "top30_televizori_cena",
    "statistike_cena_po_kategoriji",
    "procenat_klasa_A_po_kategoriji",
    "top10_brendovi_po_ceni",
    "dostupnost_po_kategoriji",
    "frizideri_po_velicini",
]

# Volume labels of the size report.
SIZE_SMALL = "mali (< 200 l)"
SIZE_MEDIUM = "srednji (200-400 l)"
SIZE_LARGE = "veliki (> 400 l)"

# Fixed value: label of the remainder in share tables.
REMAINDER = "ostalo"

# Shops and their base addresses.
SHOP_BASES = {
    "tehnomanija.rs": "https://www.tehnomanija.rs",
    "gigatron.rs": "https://gigatron.rs",
    "metalac.rs": "https://www.market.metalac.com",
}

# Listing path of each shop -> category label.
CATEGORY_SLUGS = {
    "tehnomanija.rs": {
        "bela-tehnika/frizideri": "frizider",
        "bela-tehnika/zamrzivaci": "zamrzivac",
        "bela-tehnika/ves-masine": "ves_masina",
        "bela-tehnika/masine-za-sudove": "masina_za_sudove",
        "bela-tehnika/sporeti": "sporet",
        "bela-tehnika/ugradne-rerne-i-ploce": "ugradna_rerna",
        "bela-tehnika/mikrotalasne": "mikrotalasna",
        "bela-tehnika/aspiratori": "aspirator",
        "bela-tehnika/bojleri": "bojler",
        "tv-foto-audio-i-video/televizori": "televizor",
        "klima-uredjaji": "klima_uredjaj",
        "mali-kucni-aparati/usisivaci": "usisivac",
        "mali-kucni-aparati/pegle": "pegla",
        "mali-kucni-aparati/blenderi": "blender",
        "mali-kucni-aparati/seckalice": "seckalica",
        "mali-kucni-aparati/sokovnici-i-cediljke-za-citruse": "sokovnik",
        "mali-kucni-aparati/multipraktici-i-kuhinjski-roboti": "kuhinjski_robot",
        "mali-kucni-aparati/aparati-za-pripremu-hrane": "aparat_za_hranu",
        "mali-kucni-aparati/tosteri": "toster",
        "mali-kucni-aparati/mini-pekare": "mini_pekara",
        "mali-kucni-aparati/resoi": "reso",
        "mali-kucni-aparati/airfryeri-i-friteze": "friteza",
        "mali-kucni-aparati/aparati-za-vodu": "aparat_za_vodu",
        "mali-kucni-aparati/aparati-za-kafu": "aparat_za_kafu",
        "mali-kucni-aparati/masine-za-meso": "masina_za_meso",
        "mali-kucni-aparati/mikseri": "mikser",
        "mali-kucni-aparati/masine-za-sivenje": "masina_za_sivenje",
    },
    "gigatron.rs": {
        "bela-tehnika/ves-masine": "ves_masina",
        "bela-tehnika/frizideri": "frizider",
        "bela-tehnika/zamrzivaci": "zamrzivac",
        "bela-tehnika/sporeti": "sporet",
        "bela-tehnika/masine-za-pranje-sudova": "masina_za_sudove",
        "bela-tehnika/mikrotalasne-rerne": "mikrotalasna",
        "bela-tehnika/aspiratori": "aspirator",
        "bela-tehnika/bojleri": "bojler",
        "bela-tehnika/ugradna-tehnika": "ugradna_rerna",
        "bela-tehnika/grejna-tela": "grejno_telo",
        "mali-kucni-aparati/usisivaci": "usisivac",
        "mali-kucni-aparati/pegle": "pegla",
        "mali-kucni-aparati/ventilatori": "ventilator",
        "mali-kucni-aparati/parocistaci": "parocistac",
        "mali-kucni-aparati/masine-za-sivenje": "masina_za_sivenje",
        "mali-kucni-aparati/kucni-aparati": "kucni_aparat",
        "mali-kucni-aparati/aparati-za-tretiranje-vazduha": "precistac_vazduha",
    },
    "metalac.rs": {
        "kombinovani-frizideri": "frizider",
        "frizideri-sa-jednim-vratima": "frizider",
        "side-by-side-frizideri": "frizider",
        "ugradni-frizideri": "frizider",
        "horizontalni-zamrzivaci": "zamrzivac",
        "vertikalni-zamrzivaci": "zamrzivac",
        "masine-za-ves-sa-prednjim-punjenjem": "ves_masina",
        "masine-za-ves-sa-punjenjem-odozgo": "ves_masina",
        "masine-za-pranje-i-susenje-vesa": "ves_masina",
        "masine-za-susenje-vesa": "susilica",
        "samostojece-sudomasine": "masina_za_sudove",
        "ugradne-sudomasine": "masina_za_sudove",
        "elektricni-sporeti": "sporet",
        "kombinovani-sporeti": "sporet",
        "plinski-sporeti": "sporet",
        "ugradne-rerne": "ugradna_rerna",
        "ugradne-ploce": "ugradna_ploca",
        "samostalni-aspiratori": "aspirator",
        "ugradni-aspiratori": "aspirator",
        "samostalne-mikrotalasne": "mikrotalasna",
        "ugradne-mikrotalasne": "mikrotalasna",
        "bojleri": "bojler",
        "malolitrazni-bojleri": "bojler",
        "radijatori-i-grejalice": "grejno_telo",
        "masine-za-meso": "masina_za_meso",
    },
}

# Spec names a product page may use for one attribute, by preference.
SPEC_SYNONYMS = {
    "energetska_klasa": ["energetska klasa", "energetska klasa (eu 2021)"],
    "dijagonala_inch": ["dijagonala ekrana", "dijagonala"],
    "kapacitet_kg": ["kapacitet pranja", "kapacitet"],
    "zapremina_l": ["zapremina", "zapremina frižidera", "ukupna zapremina"],
    "snaga_w": ["snaga", "rashladna snaga"],
}

# Fixed value: spec row that holds a glued blob and is left out.
IGNORED_SPEC_KEYS = ["import specifikacija"]

# Attribute routing for nested offers, tried in this order:
# (target, text in the lower-case spec name, text needed in the lower-case value).
SPEC_ROUTES = [
    ("energetska_klasa", "energetska klasa", None),
    ("snaga_w", "snaga", None),
    ("zapremina_l", "zapremina", None),
    ("kapacitet_kg", "kapacitet", "kg"),
    ("dijagonala_inch", "dijagonal", None),
]

# Spec that tells availability, its default, and what counts as yes.
AVAILABILITY_SPEC = "Online kupovina"
AVAILABILITY_DEFAULT = "Yes"
AVAILABILITY_YES = ["yes", "da", "true"]

# Attribute patterns for free text (case-insensitive).  [\p{L}\d_]
# is a word character in any alphabet.
TEXT_PATTERNS = {
    "energetska_klasa": r"Energetsk[\p{L}\d_]+\s+(?:klas[\p{L}\d_]+|razred)[:\s]*([A-G](?:\+{1,3})?)",
    "kapacitet_kg": r"Kapacitet[^:]{0,25}[:\s]+([\d.,]+)\s*kg",
    "zapremina_l": r"(?:Zapremina|Bruto zapremina|Neto zapremina)[^:]{0,25}[:\s]+([\d.,]+)\s*(?:l(?:[^\p{L}\d_]|$)|lit)",
    "snaga_w": r"(?:Snaga|Priključna snaga)[^:]{0,25}[:\s]+([\d.,]+)\s*W",
    "dijagonala_inch": r"Dijagonala[^:]{0,25}[:\s]+([\d.,]+)",
}

# Similarity block weights.
BLOCK_WEIGHTS = {"tehnicke": 1.0, "cena": 0.9, "naziv": 0.7, "brend": 0.5}

# Clustering presets (name, K, weights in percent) and the default set.
CLUSTER_PRESETS = [
    ("Cena vs efikasnost", 3, {"cena": 60, "energetska_klasa_num": 40}),
    ("Cena i zapremina", 4, {"cena": 50, "zapremina_l": 30, "energetska_klasa_num": 20}),
    ("Cena i snaga", 3, {"cena": 60, "snaga_w": 40}),
]
CLUSTER_DEFAULT = {"cena": 50, "energetska_klasa_num": 30, "zapremina_l": 20}
CLUSTER_DEFAULT_K = 4

# Sample inputs of the price estimate.
ESTIMATE_SAMPLES = [
    {"kategorija": "frizider", "brend": "Samsung", "dijagonala_inch": "", "kapacitet_kg": "",
     "zapremina_l": "300", "snaga_w": "", "energetska_klasa_num": "7"},
    {"kategorija": "televizor", "brend": "LG", "dijagonala_inch": "55", "kapacitet_kg": "",
     "zapremina_l": "", "snaga_w": "120", "energetska_klasa_num": "5"},
    {"kategorija": "ves_masina", "brend": "Bosch", "dijagonala_inch": "", "kapacitet_kg": "8",
     "zapremina_l": "", "snaga_w": "2000", "energetska_klasa_num": "8"},
]

# Cluster description, (text before, decimals, thousands separator, text after).
CLUSTER_TEXTS = {
    "cena": ("prosečna cena ≈ ", 0, True, " RSD"),
    "zapremina_l": ("prosečna zapremina ≈ ", 0, False, " l"),
    "kapacitet_kg": ("prosečan kapacitet ≈ ", 1, False, " kg"),
    "dijagonala_inch": ("prosečna dijagonala ≈ ", 0, False, '"'),
    "snaga_w": ("prosečna snaga ≈ ", 0, False, " W"),
}
# Description of the energy class code, good from 6 on.
CLUSTER_GRADE_FROM = 6
CLUSTER_GRADE_TEXTS = ("bolje energ. klase (", "lošije energ. klase (", 1, "/10)")
