"""Deterministic synthetic people, one per id, generated where the ids are.

Every field is arithmetic on the id, so the same id gives the same person at any parallelism and
on any retry. No random generator, no Python per row, nothing built on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beneflow.functions.fixed import STATE_CODES

GIVEN_NAMES = ("Ana", "Bruno", "Carla", "Diego", "Elisa", "Fabio", "Gabriela", "Hugo", "Iara",
               "Joao", "Karina", "Lucas", "Marina", "Nelson", "Olivia", "Paulo", "Rita", "Sergio")
FAMILY_NAMES = ("Almeida", "Barros", "Cardoso", "Duarte", "Esteves", "Ferreira", "Gomes", "Lima",
                "Moreira", "Nunes", "Oliveira", "Pereira", "Ramos", "Silva", "Teixeira", "Vieira")
STREETS = ("Rua das Flores", "Avenida Central", "Travessa do Porto", "Alameda dos Ipes",
           "Rua Sete de Abril", "Praca da Matriz", "Estrada Velha")
CITIES = ("Aurora", "Bela Vista", "Campo Novo", "Lagoa Grande", "Monte Alto", "Porto Seco",
          "Rio Claro", "Santa Luzia", "Vila Nova")
COMPANY_KINDS = ("Ltda.", "S.A.", "e Filhos", "Comercial", "Servicos")
JOBS = ("Analista", "Arquiteto", "Contador", "Eletricista", "Enfermeiro", "Engenheiro",
        "Motorista", "Professor", "Programador", "Vendedor")

_PRIME = 2_147_483_647


def _mix(ids: Column, salt: int) -> Column:
    """Spread an id over 0..2^31-2; every product stays below 2^62."""
    step = (F.pmod(ids, F.lit(_PRIME)) * F.lit(48271) + F.lit(salt * 7919 + 17)) % _PRIME
    squared = (step * step + F.lit(salt)) % _PRIME
    return (squared * F.lit(69621) + F.lit(salt * 104729)) % _PRIME


def _mixed(salt: int) -> Column:
    return F.col(f"_mixed_{salt}")


def _pick(salt: int, choices: Sequence[str]) -> Column:
    index = (_mixed(salt) % len(choices)).cast("int")
    return F.get(F.array(*[F.lit(choice) for choice in choices]), index)


def _digits(salt: int, width: int) -> Column:
    return F.lpad((_mixed(salt) % 10**width).cast("string"), width, "0")


def _check_digit(digits: Sequence[Column]) -> Column:
    """Modulo-11 check digit with weights counting down to 2; a remainder of 0 or 1 gives 0."""
    weights = range(len(digits) + 1, 1, -1)
    total = sum((digit * weight for digit, weight in zip(digits, weights, strict=True)), F.lit(0))
    return (F.lit(11) - total % 11) % 11 % 10


def _with_cpf(df: DataFrame) -> DataFrame:
    """``123.456.789-09`` from nine digits and two check digits, the second over the first."""
    number = F.lpad((_mixed(3) % 10**9).cast("string"), 9, "0")
    df = df.withColumn("_number", number)
    digits = [F.substring("_number", i, 1).cast("int") for i in range(1, 10)]
    df = df.withColumn("_first", _check_digit(digits))
    df = df.withColumn("_second", _check_digit([*digits, F.col("_first")]))
    groups = [F.substring("_number", i, 3) for i in (1, 4, 7)]
    checks = F.concat(F.col("_first").cast("string"), F.col("_second").cast("string"))
    return df.withColumn("cpf", F.concat_ws("-", F.concat_ws(".", *groups), checks))


def people(ids: DataFrame, id_column: str, as_of: str, run_ts: str) -> DataFrame:
    """One person per id, 18 to 90 years old on ``as_of`` (an ISO date)."""
    key = F.col(id_column).cast("bigint")
    mixed = ids.select(key.alias("id"), *[_mix(key, n).alias(f"_mixed_{n}") for n in range(1, 18)])
    given, family = _pick(1, GIVEN_NAMES), _pick(2, FAMILY_NAMES)
    email = F.concat(given, F.lit("."), family, F.col("id").cast("string"), F.lit("@example.com"))
    # 18 years plus up to 72 years less a day, in days.
    age_days = F.lit(18 * 366) + _mixed(9) % (72 * 365 - 18)
    return _with_cpf(mixed).select(
        "id",
        F.concat_ws(" ", given, family).alias("nome"),
        F.lower(email).alias("email"),
        "cpf",
        F.concat(F.lit("("), (_mixed(4) % 89 + 11).cast("string"), F.lit(") 9"),
                 _digits(5, 4), F.lit("-"), _digits(6, 4)).alias("telefone"),
        F.concat(_pick(7, STREETS), F.lit(", "), (_mixed(8) % 2000 + 1).cast("string"))
        .alias("endereco"),
        _pick(10, CITIES).alias("cidade"),
        _pick(11, list(STATE_CODES.values())).alias("estado"),
        F.concat(_digits(12, 5), F.lit("-"), _digits(13, 3)).alias("cep"),
        F.date_sub(F.lit(as_of).cast("date"), age_days.cast("int")).cast("string")
        .alias("data_nascimento"),
        F.concat_ws(" ", _pick(14, FAMILY_NAMES), _pick(15, COMPANY_KINDS)).alias("empresa"),
        _pick(16, JOBS).alias("cargo"),
        ((F.lit(180_000) + _mixed(17) % 2_320_001) / 100.0).alias("salario"),
        F.lit(run_ts).alias("_ingestion_ts"),
    )
