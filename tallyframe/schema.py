"""Vocabulary of a sheet: box labels, key columns and their widths."""

from __future__ import annotations

# The box labels of a sheet, in the order of the form.
CANDIDATES = [f"cand_{n:02d}" for n in range(1, 14)]
LEVELLING = ["TOTAL_E11", "TOTAL_URNA", "TOTAL_INCINERADOS"]
AGGREGATES = ["BLANCO", "NULO", "NO_MARCADO", "SUMA_TOTAL"]
LABELS = LEVELLING + CANDIDATES + AGGREGATES
#: The boxes of the arithmetic identities, in the order in which ties are broken.
IDENTITY = [*CANDIDATES, "BLANCO", "NULO", "NO_MARCADO", "SUMA_TOTAL", "TOTAL_E11"]
# The second round's boxes as (label, centre, height), relative to the page; the column's left and right.
SECOND_ROUND = [
    ("TOTAL_E11", 0.263, 0.032),
    ("TOTAL_URNA", 0.295, 0.032),
    ("TOTAL_INCINERADOS", 0.327, 0.032),
    ("CANDIDATO_01", 0.460, 0.050),
    ("CANDIDATO_02", 0.615, 0.050),
    ("BLANCO", 0.726, 0.032),
    ("NULO", 0.758, 0.032),
    ("NO_MARCADO", 0.789, 0.032),
    ("SUMA_TOTAL", 0.820, 0.032),
]
SECOND_ROUND_X = (0.720, 0.975)
# The aggregates of the first form as (label, top, bottom) relative to the page; the column's left and right, and the margin at its right.
FIRST_ROUND_AGGREGATES = [("BLANCO", 0.768, 0.798), ("NULO", 0.798, 0.823), ("NO_MARCADO", 0.823, 0.847), ("SUMA_TOTAL", 0.847, 0.877)]
FIRST_ROUND_X = (0.66, 0.985)
FIRST_ROUND_MARGIN = 0.04
PLACE = ["dep", "muni", "zona", "puesto"]
TABLE = [*PLACE, "mesa"]
#: Digits to which each code is padded.
WIDTHS = {"dep": 2, "muni": 3, "zona": 3, "puesto": 2, "mesa": 3, "corporacion": 3}
# The candidates' rows of the first form's pages 1 and 2 as (top, bottom), and the levelling rows, relative to the page.
FIRST_ROUND_CANDIDATES = {
    1: [(0.364, 0.445), (0.450, 0.529), (0.535, 0.614), (0.620, 0.700), (0.705, 0.785), (0.790, 0.870), (0.875, 0.955)],
    2: [(0.251, 0.330), (0.335, 0.415), (0.421, 0.500), (0.506, 0.586), (0.592, 0.672), (0.677, 0.757)],
}
FIRST_ROUND_LEVELLING = [("TOTAL_E11", 0.243, 0.275), ("TOTAL_URNA", 0.275, 0.299), ("TOTAL_INCINERADOS", 0.299, 0.329)]
# The centres of a box's three digits, by cell type, and the width of a digit's window, relative to the box.
DIGIT_CENTRES = {"CAND": (0.31, 0.57, 0.82), "AGREG": (0.19, 0.50, 0.79)}
DIGIT_WINDOW = 0.26
NOTES = "CONSTANCIAS"
