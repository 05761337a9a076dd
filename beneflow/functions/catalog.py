"""Functions of the data contract under SQL names, the same for SQL and DataFrame users.

Their bodies are SQL, so the optimizer sees through them; nothing runs in Python.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from beneflow.functions import fixed
from beneflow.functions.parsing import species_group_sql, text_literal

_STATE_PAIRS = ", ".join(f"{text_literal(name)}, {text_literal(code)}" for name, code in fixed.STATE_CODES.items())

# Name -> (parameters, type, body).
FUNCTIONS = {
    "grupo_especie": ("codigo INT", "STRING", species_group_sql("codigo")),
    "valor_monetario": ("texto STRING", "DECIMAL(12,2)", "try_cast(translate(texto, ',.', '.') AS DECIMAL(12,2))"),
    "sigla_uf": ("nome STRING", "STRING", f"map({_STATE_PAIRS})[nome]"),
    "parte_codigo": ("texto STRING", "STRING", "substring_index(texto, '-', 1)"),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Make the functions known to a session, as temporary ones; SQL calls them by name, DataFrames by
    ``F.call_function``. Safe to call again."""
    for name, (parameters, kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    return list(FUNCTIONS)
