import datetime

from beneflow.functions.fixed import STATE_CODES
from beneflow.sources.people import people


def test_same_people_at_any_parallelism(spark):
    one = people(spark.range(0, 500, 1, 1), "id", "2026-01-31", "ts").collect()
    many = people(spark.range(0, 500, 1, 13), "id", "2026-01-31", "ts").collect()
    assert sorted(map(str, one)) == sorted(map(str, many))


def test_fields_are_plausible(spark):
    rows = people(spark.range(5000), "id", "2026-01-31", "ts").collect()
    as_of = datetime.date(2026, 1, 31)
    assert len({r["id"] for r in rows}) == len({r["email"] for r in rows}) == 5000
    assert len({r["cpf"] for r in rows}) > 4900
    assert len({r["nome"] for r in rows}) > 200
    assert {r["estado"] for r in rows} == set(STATE_CODES.values())
    for row in rows:
        digits = [int(c) for c in row["cpf"] if c.isdigit()]
        assert len(digits) == 11 and len(row["cpf"]) == 14
        for n in (9, 10):
            rest = 11 - sum(d * w for d, w in zip(digits[:n], range(n + 1, 1, -1), strict=True)) % 11
            assert digits[n] == (0 if rest >= 10 else rest)
        born = datetime.date.fromisoformat(row["data_nascimento"])
        age = as_of.year - born.year - ((as_of.month, as_of.day) < (born.month, born.day))
        assert 18 <= age < 90
        assert 1800 <= row["salario"] <= 25000
        assert len(row["cep"]) == 9 and len(row["telefone"]) == 15


def test_large_ids_do_not_overflow(spark):
    ids = spark.range(2**62, 2**62 + 5)
    assert people(ids, "id", "2026-01-31", "ts").count() == 5
    assert all(r["cpf"] for r in people(ids, "id", "2026-01-31", "ts").collect())
