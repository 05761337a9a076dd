"""Text -> typed value. Malformed text gives NULL, also under ANSI mode."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beneflow.functions import fixed

MONEY_TYPE = T.DecimalType(12, 2)


def named(name: str) -> Column:
    """A column whose name may hold dots, spaces or accents."""
    return F.col("`" + name.replace("`", "``") + "`")


def money(text: Column) -> Column:
    """``1.621,00`` -> 1621.00: one pass drops the dots and turns the comma into a point."""
    return F.translate(text, ",.", ".").try_cast(MONEY_TYPE)


def day(text: Column) -> Column:
    return F.try_to_date(text, fixed.DATE_PATTERN)


def clean_text(field: T.StructField) -> Column:
    """Trim business text; in categorical columns turn "no information" into NULL."""
    column = named(field.name)
    if not isinstance(field.dataType, T.StringType) or field.name.startswith("_"):
        return column
    trimmed = F.trim(column)
    if field.name in fixed.CATEGORICAL_COLUMNS:
        trimmed = F.when(~trimmed.isin(*fixed.NULL_MARKERS), trimmed)
    return trimmed.alias(field.name)


def leading_code(text: Column) -> Column:
    """What stands before the first dash; the whole text when there is none."""
    return F.substring_index(text, "-", 1)


def bank(text: Column) -> dict[str, Column]:
    """``104-Caixa Economica`` -> 104, ``Caixa Economica``."""
    return {
        "banco_codigo": leading_code(text).try_cast("int"),
        "banco_nome": F.regexp_replace(text, r"^\d+-", ""),
    }


def municipality(text: Column, prefix: str) -> dict[str, Column]:
    """``28043-To-Miracema`` -> ``28043``, ``TO``, ``Miracema``."""
    return {
        f"{prefix}_codigo": leading_code(text),
        f"{prefix}_sg_uf": F.upper(F.get(F.split(text, "-", 3), F.lit(1))),
        f"{prefix}_nome": F.regexp_replace(text, r"^\d+-[A-Za-z]+-", ""),
    }


def text_literal(value: str) -> str:
    """A text as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def lookup(entries: Mapping[str, str], key: Column) -> Column:
    """Literal map lookup of text -> SQL expression; an unmapped key gives NULL."""
    pairs = ", ".join(f"{text_literal(name)}, {value}" for name, value in entries.items())
    return F.expr(f"map({pairs})")[key]


def state_code(name: Column) -> Column:
    return lookup({state: text_literal(c) for state, c in fixed.STATE_CODES.items()}, name)


def payment_means(text: Column) -> dict[str, Column]:
    """``Ccl  -  Loterica`` -> ``CCL`` and its description; unmapped means give NULLs."""
    entries = {
        prefix: f"named_struct('codigo', {text_literal(code)}, 'descricao', {text_literal(label)})"
        for prefix, (code, label) in fixed.PAYMENT_MEANS.items()
    }
    entry = lookup(entries, F.get(F.split(text, r"\s+-\s+", 2), F.lit(0)))
    return {
        "meio_pag_codigo": entry.getField("codigo"),
        "meio_pag_descricao": entry.getField("descricao"),
    }


def species_group_sql(code: str) -> str:
    """Business group of a species code column as SQL; unlisted and missing codes are the rest."""
    cases = " ".join(
        f"WHEN {code} IN ({', '.join(map(str, codes))}) THEN {text_literal(group)}"
        for group, codes in fixed.SPECIES_GROUPS.items()
    )
    return f"CASE {cases} ELSE {text_literal(fixed.OTHER_GROUP)} END"


def species_group(code: str) -> Column:
    return F.expr(species_group_sql(code))
