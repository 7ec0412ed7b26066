"""Codes, paths and names as column expressions. All stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyframe.schema import TABLE, WIDTHS


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_key(c: Column | str) -> Column:
    """Trimmed; without leading zeros if all ASCII digits ("007" is "7", "A07" stays)."""
    t = F.trim(col(c).cast("string"))
    return F.when(t.rlike("^[0-9]+$"), F.regexp_replace(t, "^0+(?=[0-9])", "")).otherwise(t)


def pad_code(c: Column | str, width: int) -> Column:
    """Zero-padded to at least ``width``, never cut; null is the empty code."""
    t = F.coalesce(F.trim(col(c).cast("string")), F.lit(""))
    return F.when(F.length(t) >= width, t).otherwise(F.lpad(t, width, "0"))


def digits_only(c: Column | str) -> Column:
    """The digits of a text; null is the empty text."""
    return F.regexp_replace(F.coalesce(col(c).cast("string"), F.lit("")), "[^0-9]", "")


def parse_int(c: Column | str) -> Column:
    """Signed integers with spaces around; anything else is null."""
    return F.trim(col(c).cast("string")).try_cast("int")


def parse_digits(c: Column | str) -> Column:
    """Integers of digits only, no sign and no spaces; anything else is null."""
    t = col(c).cast("string")
    return F.when(t.rlike("^[0-9]+$"), t.try_cast("int"))


def pdf_name(c: Column | str) -> Column:
    """A file name that ends in .pdf, in any case."""
    t = F.trim(col(c))
    return F.when(F.lower(t).endswith(".pdf"), t).otherwise(F.concat(t, F.lit(".pdf")))


def parse_path(c: Column | str) -> Column:
    """Copy and five codes from the six directories above a file; all empty if there are fewer."""
    parts = F.split(col(c), "/")
    names = ["ejemplar", *TABLE]
    return F.struct(*[F.when(F.size(parts) >= 7, F.get(parts, F.size(parts) - 7 + k)).otherwise("").alias(n) for k, n in enumerate(names)])


# Fixed value: the name of a third-copy file.
TOKENS = "(?i)E14_PRE_([0-9]+)_([0-9]+)_([0-9]+)_([0-9]+)_([0-9]+)_([0-9]+)_([0-9]+)"


def second_round_key(c: Column | str) -> Column:
    """The five codes from a third copy's file name, else the five directories after PRE, else nulls."""
    path = col(c)
    parts = F.split(path, "/")
    name = F.element_at(parts, -1)
    at = F.array_position(parts, "PRE")
    by_name = name.rlike(TOKENS)
    by_dir = (at > 0) & (F.size(parts) >= at + 5)
    group = {"dep": 1, "muni": 2, "zona": 3, "puesto": 4, "mesa": 6}
    fields = [F.when(by_name, F.regexp_extract(name, TOKENS, group[n])).when(by_dir, F.get(parts, (at + k).cast("int"))).alias(n) for k, n in enumerate(TABLE)]
    reason = F.when(by_name | by_dir, F.lit(None)).otherwise(F.lit("no codes in the path"))
    return F.struct(*fields, reason.alias("reason"))


def third_copy_codes(c: Column | str) -> Column:
    """Place codes of a third copy's path; empty if it has fewer than seven parts."""
    parts = F.split(F.regexp_replace(F.trim(col(c)), "^/+", ""), "/")
    return F.struct(*[F.when(F.size(parts) >= 7, F.get(parts, F.lit(2 + k))).otherwise("").alias(n) for k, n in enumerate(TABLE[:4])])


def route_class(c: Column | str) -> Column:
    """documentos, consolidado, avance or otro; the first that fits."""
    t = col(c)
    bare = F.regexp_replace(t, "/+$", "")
    return (
        F.when(t.contains("actas-documentos") & bare.endswith("mesas"), "documentos")
        .when(t.contains("actas-publicadas/consolidado"), "consolidado").when(t.contains("avance-actas"), "avance").otherwise("otro")
    )


def percent_encoded(c: Column | str) -> Column:
    """Everything but letters, digits and ``_.-~`` as %XX."""
    t = F.replace(F.url_encode(col(c)), F.lit("+"), F.lit("%20"))
    return F.replace(F.replace(t, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def record_url(base: str, folder: str = "PRE", token: Column | None = None) -> Column:
    """Where a manifest record's file is; ``token`` is the cache-busting value, if one is wanted."""
    url = F.concat_ws("/", F.lit(base.rstrip("/") + "/assets/temis/pdf"), *TABLE, F.lit(folder), percent_encoded("expected_name"))
    return url if token is None else F.concat(url, F.lit("?uuid="), token)


def record_path(root: str, folder: str = "PRE") -> Column:
    return F.concat_ws("/", F.lit(root), F.lit(folder), *TABLE, F.col("expected_name"))


def padded_codes(*names: str) -> list[Column]:
    return [pad_code(n, WIDTHS[n]).alias(n) for n in names or WIDTHS]


def snapshot_time(c: Column | str) -> Column:
    """The time in a snapshot's file name."""
    return F.try_to_timestamp(F.regexp_extract(col(c), "([0-9]{8}_[0-9]{6})", 1), F.lit("yyyyMMdd_HHmmss")).cast("timestamp_ntz")


def is_pdf(content: Column | str, least: int = 800) -> Column:
    c = col(content)
    return F.coalesce((F.length(c) >= least) & (F.hex(F.substring(c, 1, 4)) == "25504446"), F.lit(False))


def is_json(content: Column | str, least: int = 2) -> Column:
    c = col(content).cast("string")
    # the parser stops after one value, so what follows it only shows inside brackets and braces
    whole = F.try_parse_json(F.concat(F.lit("["), c, F.lit("]"))).isNotNull() & F.try_parse_json(F.concat(F.lit('{"x":'), c, F.lit("}"))).isNotNull()
    return F.coalesce((F.octet_length(c) >= least) & whole, F.lit(False))


def copy_filter(values: str, column: str, width: int | None = None) -> Column:
    """A comma list as a predicate; an empty list lets all pass."""
    wanted = [v.strip().zfill(width or 0) for v in values.split(",") if v.strip()]
    return F.col(column).isin(wanted) if wanted else F.lit(True)
