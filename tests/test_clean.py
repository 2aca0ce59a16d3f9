from pyspark.sql import functions as F
from pyspark.sql import types as T

from equigauge.functions import codebook
from equigauge.functions.scalar import canonical_code, slug
from equigauge.operators import clean
from equigauge.roles import ROLES


def test_numbers_and_what_is_none(spark):
    texts = ["12", " 7 ", "b", "", "1d", "1e3", "-.5", "NaN", None, "1_000"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, age string")
    got = [r.age for r in clean.coerce_numeric(df, ["age"]).orderBy("i").collect()]
    assert got == [12.0, 7.0, None, None, None, 1000.0, -0.5, None, None, None]
    assert clean.coercion_report(df, ["age"]).first().unparseable == 5


def test_validity_edges(spark):
    rows = [(-1.0, 30.0), (0.0, 30.0), (None, 30.0), (5.0, 17.0), (5.0, 18.0), (5.0, None)]
    df = spark.createDataFrame(rows, "wage_income double, age double")
    kept = clean.drop_invalid(df, clean.validity_rules()).collect()
    assert [(r.wage_income, r.age) for r in kept] == [(0.0, 30.0), (5.0, 18.0)]
    audit = {r.rule: r for r in clean.row_audit(df, clean.validity_rules()).collect()}
    assert (audit["total"].before, audit["total"].after) == (6, 2)
    parts = [a.dropped for n, a in audit.items() if n != "total"]
    assert sum(parts) == audit["total"].dropped == 4


def test_canonical_codes_meet_and_stay_apart(spark):
    texts = spark.createDataFrame([("20",), ("20.0",), ("0010",), ("10",), (None,)], "c string")
    got = [r[0] for r in texts.select(canonical_code("c")).collect()]
    assert got == ["20", "20", "0010", "10", None]
    number = spark.createDataFrame([(20.0,)], "c double").select(canonical_code("c")).first()[0]
    assert number == "20"


def test_label_is_inclusive(spark):
    df = spark.createDataFrame([(74_999.99,), (75_000.0,)], "wage_income double")
    got = clean.label(df, "wage_income", 75_000, "high_income").collect()
    assert [r.high_income for r in got] == [0, 1]


def test_separate_hides_label_source(spark):
    df = spark.createDataFrame(
        [(1, 30.0, "1", "2", "1", 80_000.0, 1)],
        "person_id long, age double, race string, sex string, nativity string, "
        "wage_income double, high_income int",
    )
    model, sensitive = clean.separate(df)
    assert model.columns == ["person_id", "age", "high_income"]
    assert sensitive.columns == ["person_id", "race", "sex", "nativity", "high_income"]
    assert set(model.columns) & set(sensitive.columns) == {ROLES.key, ROLES.label}


def test_slug(spark):
    names = ["race: Native Hawaiian / Pacific Islander alone", "sex: Male"]
    df = spark.createDataFrame([(n,) for n in names], "g string")
    got = [r[0] for r in df.select(slug("g")).collect()]
    assert got == ["native_hawaiian___pacific_islander_alone", "male"]


def test_decode_all_books(spark):
    assert len(codebook.RACE) == 8 and "5" not in codebook.RACE
    assert len(codebook.EDUCATION) == 24 and len(codebook.OCCUPATION) == 25
    df = spark.createDataFrame([("1",), ("5",), (None,)], "race string")
    got = clean.decode(df, "race", codebook.RACE).collect()
    assert [r.race_label for r in got] == ["White alone", None, None]


def test_domain_reasons(spark):
    df = spark.createDataFrame(
        [(18, "1"), (96, "7"), (None, "5")], "age int, marital_status string"
    )
    rules = [
        clean.Domain("age", 18, 95),
        clean.Domain("marital_status", codes=tuple(codebook.MARITAL_STATUS)),
    ]
    got = clean.check_domain(df, rules).collect()
    assert [r.violations for r in got] == [[], ["age", "marital_status"], ["age"]]
    assert [r.valid for r in got] == [True, False, False]


def test_contract(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "a int, c string, d double")
    want = T.StructType.fromDDL("a int, b double, c string")
    got = {r.column: r.status for r in clean.check_contract(df, want).collect()}
    assert got == {"a": "ok", "b": "missing", "c": "order_differs", "d": "unexpected"}


def test_drop_and_rename_are_tolerant(spark):
    df = spark.createDataFrame([("1", "2")], "AGEP string, state string")
    out = clean.drop_present(clean.rename_present(df, codebook.FIELD_NAMES), ["state", "nope"])
    assert out.columns == ["age"]
    assert out.select(F.col("age")).first()[0] == "1"
