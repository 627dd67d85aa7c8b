"""The seed rows of FIXTURES.md, section 2."""

from datetime import date
from decimal import Decimal

CUSTOMERS = [
    ("1", "Antonio", "1998-08-04", "2025-03-01 14:24:40.012"),
    ("2", "Brandon", "2001-04-21", "2025-03-02 08:12:54.003"),
    ("3", "Charlie", "1980/11/15", "2025-03-02 11:20:02.391"),
    ("4", "Dominikus", "14/01/1995", "2025-03-03 09:50:41.852"),
    ("5", "Erik", "1900-01-01", "2025-03-03 17:22:03.198"),
    ("6", "PT Black Bird", None, "2025-03-04 12:52:16.122"),
]
BIRTH_DATES = {
    "1": date(1998, 8, 4),
    "2": date(2001, 4, 21),
    "3": date(1980, 11, 15),
    "4": date(1995, 1, 14),
    "5": date(1900, 1, 1),
    "6": None,
}
SALES = [
    ("JIS8135SAD", "1", "RAIZA", "2025-03-01", "350.000.000", "2025-03-01 14:24:40.012"),
    ("MAS8160POE", "3", "RANGGO", "2025-05-19", "430.000.000", "2025-05-19 14:29:21.003"),
    ("JLK1368KDE", "4", "INNAVO", "2025-05-22", "600.000.000", "2025-05-22 16:10:28.120"),
    ("JLK1869KDF", "6", "VELOS", "2025-08-02", "390.000.000", "2025-08-02 14:04:31.021"),
    ("JLK1962KOP", "6", "VELOS", "2025-08-02", "390.000.000", "2025-08-02 15:21:04.201"),
]
AFTER_SALES = [
    ("T124-kgu1", "MAS8160POE", "3", "RANGGO", "2025-07-11", "BP", "2025-07-11 09:24:40.012"),
    ("T560-jga1", "JLK1368KDE", "4", "INNAVO", "2025-08-04", "PM", "2025-08-04 10:12:54.003"),
    ("T521-oai8", "POI1059IIK", "5", "RAIZA", "2026-09-10", "GR", "2026-09-10 12:45:02.391"),
]
_CREATED = "2026-03-01 14:24:40.012"
ADDRESSES = [
    ("1", "1", "Jalan Mawar V RT 1/RW 2", "Bekasi", "Jawa Barat", _CREATED),
    ("2", "3", "Jl Ababil Indah", "Tangerang Selatan", "Jawa Barat", _CREATED),
    ("3", "4", "Jl. Kemang Raya 1 No 3", "JAKARTA PUSAT", "DKI JAKARTA", _CREATED),
    ("4", "6", "Astra Tower Jalan Yos Sudarso 12", "Jakarta Utara", "DKI Jakarta", _CREATED),
]
SALES_MART = {
    ("2025-03", "MEDIUM", "RAIZA", Decimal("350000000.00000")),
    ("2025-05", "HIGH", "INNAVO", Decimal("600000000.00000")),
    ("2025-05", "HIGH", "RANGGO", Decimal("430000000.00000")),
    ("2025-08", "MEDIUM", "VELOS", Decimal("780000000.00000")),
}
SERVICE_MART = {
    (2025, "MAS8160POE", "Charlie", "Jl Ababil Indah", 1, "LOW"),
    (2025, "JLK1368KDE", "Dominikus", "Jl. Kemang Raya 1 No 3", 1, "LOW"),
    (2026, "POI1059IIK", "Erik", None, 1, "LOW"),
}
