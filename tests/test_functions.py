import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vigia.functions.dates import _exclusive, _places, _shape, calendar_parts, parse_date, period_label, week_start
from vigia.functions.measures import (
    age_in_years,
    bucket_label,
    indicator,
    level,
    rate,
    weighted_index,
    zero_if_missing,
)
from vigia.functions.text import canonical_name, fold_text, is_label, label_or, normalise_header, pad_code
from vigia.model import DATE_FORMATS, DEPARTMENT_ALIASES, DEPARTMENT_SUBSTRINGS, EXTRA_DATE_FORMATS


def values(spark, data, schema, *columns):
    df = spark.createDataFrame(data, schema)
    return [tuple(r) for r in df.select(*columns).collect()]


def single(spark, data, type_, build):
    rows = spark.createDataFrame([(v,) for v in data], f"v {type_}")
    return [r[0] for r in rows.select(build(F.col("v"))).collect()]


def test_dates_in_all_formats(spark):
    texts = ["2020-03-06 00:00:00", "2020-03-06", "06/03/2020", "6/3/2020 0:00:00", "junk", None,
             "2020-13-45", "31/02/2020", " 2020-03-06", "2020-03-06T00:00:00.000", "2020-03-06 25:00:00"]
    day = dt.date(2020, 3, 6)
    expected = [day, day, day, None, None, None, None, None, None, None, None]
    assert single(spark, texts, "string", parse_date) == expected
    more = single(spark, texts, "string", lambda c: parse_date(c, DATE_FORMATS + EXTRA_DATE_FORMATS))
    assert more[3] == day and more[9] == day and more[4] is None


def test_dates_agree_with_trying_every_format(spark):
    texts = ["2020-03-06 10:11:12", "1999-12-31", "01/01/2001", "1/1/2001", "2020-3-6", "20200306", "", "06-03-2020",
             "2020/03/06", "12020-03-06", "2020-02-29", "2021-02-29", "2020-03-06 1:2:3"]
    plain = single(spark, texts, "string", lambda c: F.coalesce(
        *[F.try_to_timestamp(c, F.lit(f)) for f in DATE_FORMATS]).cast("date"))
    assert single(spark, texts, "string", parse_date) == plain


def test_iso_week_at_year_end(spark):
    day = F.lit("2021-01-01").cast("date")
    parts = calendar_parts(day)
    row = spark.range(1).select(*[c.alias(n) for n, c in parts.items()], week_start(day).alias("lunes")).first()
    assert (row.anio, row.mes, row.semana, row.lunes) == (2021, 1, 53, dt.date(2020, 12, 28))


def test_period_label(spark):
    assert values(spark, [(2020, 3), (2021, 12)], "y int, m int", period_label(F.col("y"), F.col("m"))) == [
        ("2020-03",), ("2021-12",)]


def test_age_units(spark):
    data = [("24", "2"), ("365", "3"), ("5", "9"), ("x", "1"), ("40", "1"), (None, "1"), ("7", None)]
    got = values(spark, data, "e string, u string", age_in_years(F.col("e"), F.col("u")))
    assert [g[0] for g in got] == [2.0, 1.0, None, None, 40.0, None, None]


def test_age_groups_at_the_edges(spark):
    ages = [17.9, 18.0, 29.9, 30.0, 49.9, 50.0, 64.9, 65.0, None]
    expected = ["0-17", "18-29", "18-29", "30-49", "30-49", "50-64", "50-64", "65+", "65+"]
    assert single(spark, ages, "double", bucket_label) == expected
    assert single(spark, ages, "double", lambda c: bucket_label(c, null_label=None))[-1] is None
    assert single(spark, ages, "double", lambda c: bucket_label(c, null_label="?"))[-1] == "?"


def test_codes_are_padded_and_cut(spark):
    codes = ["5", "05", "8001", "13001", None]
    assert single(spark, codes, "string", lambda c: pad_code(c, 2)) == ["05", "05", "80", "13", None]
    assert single(spark, ["5001"], "string", lambda c: pad_code(c, 5)) == ["05001"]


def test_department_aliases(spark):
    names = ["BOGOTÁ", " bogota d.e. ", "BARRANQUILLA", "ARCHIPIELAGO DE SAN ANDRES", "la guajira", " meta ", None]
    got = single(spark, names, "string", lambda c: canonical_name(c, DEPARTMENT_ALIASES, DEPARTMENT_SUBSTRINGS))
    assert got == ["BOGOTA D.C.", "BOGOTA D.C.", "ATLANTICO", "SAN ANDRES", "GUAJIRA", "META", None]


@pytest.mark.parametrize(("header", "name"), [
    ("fecha reporte web", "fecha_reporte_web"),
    ("Código DIVIPOLA departamento", "codigo_divipola_departamento"),
    (" Ubicación del caso ", "ubicacion_del_caso"),
    ("Fecha de inicio de síntomas", "fecha_de_inicio_de_sintomas"),
    ("fecha_de_notificaci_n", "fecha_de_notificaci_n"),
])
def test_headers(header, name):
    assert normalise_header(header) == name


def test_text_helpers(spark):
    assert single(spark, [" Bogotá "], "string", fold_text) == ["bogota"]
    labels = ["Andina", "", None, "null"]
    assert single(spark, labels, "string", lambda c: label_or(c, "-")) == ["Andina", "-", "-", "null"]
    assert single(spark, labels, "string", is_label) == [True, False, False, False]


def test_flags_are_case_sensitive(spark):
    assert single(spark, ["Fallecido", "fallecido", None], "string", lambda c: indicator(c, ["Fallecido"])) == [1, 0, 0]


def test_levels_rates_and_indexes(spark):
    steps = [(5, "ALTA"), (3, "MEDIA")]
    assert single(spark, [5.1, 5.0, 3.0, None], "double", lambda c: level(c, steps, "BAJA")) == [
        "ALTA", "MEDIA", "BAJA", "BAJA"]
    got = values(spark, [(1, 4), (1, 0), (1, None)], "a int, b int", rate(F.col("a"), F.col("b"), 1000))
    assert got == [(250.0,), (None,), (None,)]
    index = weighted_index([(F.col("a"), 0.4), (F.col("b"), 0.6)])
    assert values(spark, [(10.0, 20.0)], "a double, b double", index) == [(16.0,)]


def test_missing_numbers_become_zero(spark):
    data = [1.5, None, float("nan"), float("inf"), float("-inf")]
    assert single(spark, data, "double", lambda c: zero_if_missing(c, "double")) == [1.5, 0, 0, 0, 0]
    assert single(spark, [7, None], "bigint", lambda c: zero_if_missing(c, "bigint")) == [7, 0]


def test_dates_by_places_equal_the_parser(spark):
    """Texts that patterns read and texts that look like it, against Spark's own parser."""
    formats = (*DATE_FORMATS, "yyyy-MM-dd'T'HH:mm:ss.SSS", "dd.MM.yyyy", "MM/yyyy/dd")
    rng = random.Random(5)
    texts = ["2020-02-30", "2020-02-29 23:59:59", "2021-02-29", "2020-01-01 24:00:00", "2020-01-01 23:60:00", "2020-01-01 23:59:60", "0000-01-01", "0001-01-01",
             "9999-12-31", "31/12/1999", "32/12/1999", "12/31/1999", "2020-1-01", " 2020-01-01", "2020-01-01 ", "2020-01-01\n", "٢٠٢٠-01-01", "2020/01/01",
             "2020-01-01T10:11:12.345", "2020-13-01", "1.1.2020", "01.01.2020", "", "sin fecha", None, "2020-00-10", "2020-10-00", "-020-01-01", "02/2020/30", "02/2020/03"]
    for _ in range(600):
        base = rng.choice(["2020-02-28", "2019-11-05 12:34:56", "07/08/2015", "2020-01-01T10:11:12.345", "01.01.2020", "02/2020/03"])
        k = rng.randrange(len(base))
        texts.append(base[:k] + rng.choice("0123456789-/: .T") + base[k + 1:])
    df = spark.createDataFrame([(t,) for t in texts], "t string")

    def by_parser(f):
        return F.when(F.col("t").rlike(_shape(f)), F.try_to_timestamp("t", F.lit(f))).cast("date")

    for f in formats:
        assert _places(f) is not None
        rows = df.select("t", parse_date(F.col("t"), [f]).cast("string").alias("a"), by_parser(f).cast("string").alias("b")).collect()
        assert [(r.t, f) for r in rows if r.a != r.b] == []
    assert _places("d/M/yyyy H:mm:ss") is None and _places("yyyy-MM-dd yyyy") is None and _places("HH:mm:ss") is None
    plan = df.select(parse_date(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert "timestamp" not in plan.lower()


def test_patterns_no_text_fits_twice():
    assert _exclusive(DATE_FORMATS) and _exclusive(["dd/MM/yyyy", "yyyy-MM-dd"])
    assert not _exclusive(["dd/MM/yyyy", "MM/dd/yyyy"]) and not _exclusive(["yyyyMMdd", "ddMMyyyy"])


def test_patterns_of_one_shape_are_tried_in_order(spark):
    rows = spark.createDataFrame([("13/02/2020",), ("02/13/2020",), ("03/04/2020",), ("40/40/2020",), (None,)], "t string")
    found = rows.select(parse_date(F.col("t"), ["dd/MM/yyyy", "MM/dd/yyyy"]).alias("d")).collect()
    assert [r.d for r in found] == [dt.date(2020, 2, 13), dt.date(2020, 2, 13), dt.date(2020, 4, 3), None, None]
