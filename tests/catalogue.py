"""Made-up items that several test modules share."""

from __future__ import annotations

import pandas as pd

CATALOGUE_TYPES = ("id long, url string, naziv string, brend string, kategorija string, cena double, na_lageru boolean, "
                   "energetska_klasa string, energetska_klasa_num double, dijagonala_inch double, "
                   "kapacitet_kg double, zapremina_l double, snaga_w double, datum_preuzimanja timestamp_ntz")


def catalogue_frame(n: int = 60, shift: int = 0) -> pd.DataFrame:
    """Items made by counting: each kind has its own measure, every seventh grade and every fourth power is missing."""
    kinds = {"frizider": "zapremina_l", "televizor": "dijagonala_inch", "ves_masina": "kapacitet_kg"}
    brands = ["ALFATEC", "LG", "MERIDIAN", "BOSCH", "SAMSUNG", "OBLAK", "ZVEZDA"]
    rows = []
    for k in range(n):
        i = k * 37 + shift
        kind = list(kinds)[i % 11 % 3]
        brand = brands[i % 13 % 7]
        row = {"id": k + 1, "url": f"https://prodavnica.example/artikal/{k}", "naziv": f"{brand.title()} serija {i % 9} tip T{k}",
               "brend": brand, "kategorija": kind, "cena": 9_000.0 + 811.25 * (i % 173), "na_lageru": i % 5 < 3,
               "energetska_klasa": "ABCDEFG"[i % 7], "energetska_klasa_num": None if i % 7 == 6 else float(8 - i % 6),
               "dijagonala_inch": None, "kapacitet_kg": None, "zapremina_l": None, "snaga_w": None if i % 4 == 1 else 350.0 + 90 * (i % 17),
               "datum_preuzimanja": pd.Timestamp("2024-03-02")}
        row[kinds[kind]] = {"frizider": 90.0 + 5 * (i % 61), "televizor": 24.0 + i % 41, "ves_masina": 4.0 + i % 15 / 2}[kind]
        rows.append(row)
    numbers = ["energetska_klasa_num", *kinds.values(), "snaga_w"]
    return pd.DataFrame(rows).astype({c: float for c in numbers})
