"""Arithmetic identities, flags and levels as column expressions. Results are flags for review, never verdicts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyframe.schema import CANDIDATES


def total(columns: list[Column]) -> Column:
    """A sum that is null if any part is."""
    return reduce(lambda a, b: a + b, columns)


def arithmetic_check(candidates: list[Column], blank: Column, null: Column, unmarked: Column, written: Column, registered: Column) -> Column:
    """Residuals and three-valued checks of the two identities, with the level of alert.

    Null is "not read": a check that needs it is null, and parts that aren't all
    read make a sheet incomplete.
    """
    parts = total([*candidates, blank, null, unmarked])
    sum_ok, e11_ok = parts == written, written == registered
    return F.struct(
        parts.alias("calculada"), (parts - written).alias("dif_suma"), (written - registered).alias("dif_e11"),
        sum_ok.alias("cuadra_suma"), e11_ok.alias("cuadra_e11"), parts.isNull().alias("incompleta"), alert_level(parts.isNull(), sum_ok, e11_ok).alias("alerta"),
    )


def alert_level(incomplete: Column, *checks: Column) -> Column:
    """INCOMPLETO, else by failed checks: 2 ALTA, 1 MEDIA, 0 NINGUNA. A check that can't be made hasn't failed."""
    failed = total([F.coalesce(~c, F.lit(False)).cast("int") for c in checks])
    return F.when(incomplete, "INCOMPLETO").when(failed >= 2, "ALTA").when(failed == 1, "MEDIA").otherwise("NINGUNA")


def alert_rank(level: Column) -> Column:
    return F.when(level == "ALTA", 0).when(level == "MEDIA", 1).when(level == "INCOMPLETO", 2).when(level == "NINGUNA", 3).otherwise(9)


def filled(value: Column, present: Column, policy: str) -> Column:
    """``strict``: null stays; ``zero_absent``: an absent label is 0; ``zero_all``: an unreadable one too."""
    if policy == "zero_all":
        return F.coalesce(value, F.lit(0))
    if policy == "zero_absent":
        return F.when(F.coalesce(present, F.lit(False)), value).otherwise(0)
    if policy != "strict":
        raise ValueError(policy)
    return value


def has_ink(value: Column, least: float = 1.0) -> Column:
    return F.coalesce(value > least, F.lit(False))


def ink_flags(ink: dict[str, Column]) -> dict[str, Column]:
    """Six flags, their number and the review priority, from the share of ink in each box."""
    has = {k: has_ink(v) for k, v in ink.items()}
    n = total([has[c].cast("int") for c in CANDIDATES if c in has])
    some, whole, e11 = has["BLANCO"] | has["NULO"] | has["NO_MARCADO"], has["SUMA_TOTAL"], has["TOTAL_E11"]
    of = sum(c in has for c in CANDIDATES)
    flags = {
        "suma_vacia_con_votos": ~whole & (n > 0),
        "sin_ningun_voto": (n == 0) & ~some,
        "suma_con_todo_vacio": whole & (n == 0) & ~some,
        "todos_candidatos_llenos": n == of,
        "agregados_sin_suma": some & ~whole,
        "e11_vacio_con_votos": ~e11 & (n > 0),
    }
    names = list(flags)
    out = {k: v.cast("int") for k, v in flags.items()}
    priority = F.when(reduce(lambda a, b: a | b, [flags[k] for k in names[:3]]), "ALTA").when(reduce(lambda a, b: a | b, [flags[k] for k in names[3:]]), "MEDIA").otherwise("OK")
    return out | {"n_banderas": total(list(out.values())), "n_candidatos": n, "prioridad": priority}


def multiple_of_100(diff: Column) -> Column:
    return (F.pmod(F.abs(diff), F.lit(100)) == 0) & (diff != 0)


def participation(votes: Column, eligible: Column, high: float = 0.95) -> tuple[Column, Column]:
    """(ratio, flag): EXCEDE above the census, else ALTO from ``high`` on, SIN_CENSO without a census row."""
    ratio = F.when(eligible.isNull(), None).when(eligible == 0, 0.0).otherwise(votes / eligible)
    flag = F.when(eligible.isNull(), "SIN_CENSO").when(votes > eligible, "EXCEDE").when(ratio >= high, "ALTO").otherwise("")
    return F.bround(ratio, 4), flag


def block_type(width: Column, height: Column, fill: Column) -> Column:
    """What a block of ink is, by its size relative to the box."""
    return (
        F.when(width.isNull() | height.isNull(), "vacio").when((height < 0.18) & (width > 2.2 * height), "guion")
        .when((fill > 0.5) & (height < 0.30), "punto").when((fill <= 0.45) | (height >= 0.40), "digito").otherwise("marca")
    )


def box_flags(types: Column, expected: int = 3) -> Column:
    """Flags of a box from the array of its blocks' types."""
    n = F.size(types)
    digits, dashes = F.size(F.filter(types, lambda t: t == "digito")), F.size(F.filter(types, lambda t: t == "guion"))
    flags = [
        F.when(n == 0, F.lit("casilla_vacia")),
        F.when(n > expected, F.lit(f"mas_de_{expected}_posiciones")),
        F.when(F.array_contains(types, "marca"), F.lit("posicion_ambigua")),
        F.when(dashes > 0, F.lit("contiene_guion")),
        F.when((digits == 0) & (dashes == 0), F.lit("espacio_sin_anular")),
    ]
    return F.filter(F.array(*flags), lambda f: f.isNotNull())


def backoff(attempt: Column, base: float = 1.0, cap: float = 60.0) -> Column:
    """Seconds before a retry, without jitter."""
    return F.least(F.lit(cap), F.lit(base) * F.pow(F.lit(2.0), attempt - 1))
