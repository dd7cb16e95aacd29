import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from territory_analytics import fixed_values as V
from territory_analytics.functions import casts, colours, labels, numbers
from territory_analytics.operators.dimensions import label_scale, property_types, split_cities


def one_column(spark, values, kind):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


NUMBERS = {
    "1975.0": 1975.0, "1975.6": 1975.6, "2.5": 2.5, "-2.5": -2.5, "1e3": 1000.0, " 12 ": 12.0,
    ".5": 0.5, "7.": 7.0, "95d": None, "95f": None, "": None, "abc": None, "NaN": None,
    "Infinity": None, "0x10": None, "1,5": None, None: None,
}


def test_number_text(spark):
    df = one_column(spark, list(NUMBERS), "string")
    assert values(df, casts.number(F.col("x"))) == list(NUMBERS.values())


def test_whole_number_text(spark):
    cases = {"1975.0": 1975, "1975.6": 1976, "2.5": 3, "-2.5": -3, "1e3": 1000, "99999999999": None,
             "95d": None, "": None, None: None}
    df = one_column(spark, list(cases), "string")
    assert values(df, casts.whole_number(F.col("x"))) == list(cases.values())


def test_whole_from_double_rounds_to_even(spark):
    df = one_column(spark, [1975.5, 2.5, 3.5, -2.5, 1e12], "double")
    assert values(df, casts.whole_from_double(F.col("x"))) == [1976, 2, 4, -2, None]


def test_calendar_date(spark):
    cases = {
        "2026-01-08": dt.date(2026, 1, 8), "2026-1-8": dt.date(2026, 1, 8),
        "2026-01-08T10:00:00": dt.date(2026, 1, 8), "2026": None, "2026-01": None,
        "2026-13-01": None, "": None, "08/01/2026": None, None: None,
    }
    df = one_column(spark, list(cases), "string")
    assert values(df, casts.calendar_date(F.col("x"))) == list(cases.values())


def test_strip_takes_all_white_space(spark):
    df = one_column(spark, [" a\t", "\nb c \r\n", ""], "string")
    assert values(df, casts.strip(F.col("x"))) == ["a", "b c", ""]


@pytest.mark.parametrize("digits", [0, 1, 2, 3])
def test_half_away_equals_sql_round(spark, digits):
    inputs = [i * 0.005 for i in range(-400, 400)] + [1.005, 2.675, -2.5, 0.5, 1.5, 2.5, -0.03, 0.0]
    df = one_column(spark, inputs, "double")
    got = values(df, numbers.half_away(F.col("x"), digits))
    con = duckdb.connect()
    expected = [con.execute(f"SELECT round(?::DOUBLE, {digits})", [v]).fetchone()[0] for v in inputs]
    assert got == expected


def test_half_even(spark):
    df = one_column(spark, [0.25, 0.35, 0.75, 52.0], "double")
    assert values(df, numbers.half_even(F.col("x"), 1)) == [0.2, 0.4, 0.8, 52.0]


def test_zero_divisor_gives_null(spark):
    df = one_column(spark, [0.0, 4.0], "double")
    assert values(df, numbers.ratio(F.lit(2.0), F.col("x"))) == [None, 0.5]
    assert values(df, numbers.percent_gap(F.lit(5.0), F.col("x"))) == [None, 25.0]


def test_slots_keep_order(spark):
    inputs = sorted([-1e300, -5.5, -1e-9, 0.0, 1e-300, 0.1, 0.2, 199.9, 200.0, 1e18, 1.7e308])
    slots = values(one_column(spark, inputs, "double"), numbers.ordered_slot(F.col("x")))
    assert slots == sorted(slots)
    nan = values(one_column(spark, [float("nan")], "double"), numbers.ordered_slot(F.col("x")))
    assert nan[0] > max(slots)


def test_bands_and_types(spark):
    sizes = [0.5, 39.9, 40.0, 69.9, 70.0, 99.0, 100.0, 149.0, 150.0, 900.0, None]
    expected = ["<40", "<40", "40-70", "40-70", "70-100", "70-100", "100-150", "100-150", "150+",
                "150+", "150+"]
    assert values(one_column(spark, sizes, "double"), labels.band(F.col("x"))) == expected
    kinds = one_column(spark, ["appartement", "un appart", "maison", "immeuble", None], "string")
    assert values(kinds, labels.property_type(F.col("x"))) == [
        "appartement", "appartement", "maison", "autre", "autre"]


def test_score_and_wording(spark):
    df = spark.createDataFrame(
        [(-1.4, 25.0), (0.2, 5.0), (None, 50.0), (-2.0, None)], "z double, p double"
    )
    z, p = F.col("z"), F.col("p")
    assert values(df, labels.opportunity_score(z, p)) == [52.0, 2.0, 20.0, 60.0]
    flag = labels.underpriced(z, 1.0)
    assert values(df, flag) == [True, False, None, True]
    assert values(df, labels.mart_wording(flag, p)) == [
        V.LABEL_RENOVATION, V.LABEL_OVERPRICED, V.LABEL_OVERPRICED, V.LABEL_UNDERPRICED]
    assert values(df, labels.serving_wording(p)) == [
        V.LABEL_DOUBLE_SIGNAL, V.LABEL_UNDERPRICED, V.LABEL_DOUBLE_SIGNAL, V.LABEL_UNDERPRICED]


def test_badges(spark):
    df = spark.createDataFrame(
        [(-1.0, 25.0), (-1.0, 5.0), (1.0, 20.0), (1.0, 1.0), (None, None)], "g double, p double"
    )
    assert values(df, labels.badges(F.col("g"), F.col("p"))) == [
        "sous-cotee · parc passoires", "sous-cotee", "parc passoires", "", ""]


def test_colours(spark):
    df = one_column(spark, [0.0, 5.0, 10.0, 20.0, -3.0, None, float("nan")], "double")
    colour = colours.fill_colour(F.col("x"), F.lit(0.0), F.lit(10.0), V.PALETTE_PRICE)
    got = values(df, colour)
    assert got[0] == [69, 117, 180, 185]
    # Both channels lie half-way; halves go to the even number.
    assert got[1] == [156, 113, 124, 185]
    assert got[2] == got[3] == [244, 109, 67, 185]
    assert got[4] == got[0]
    assert got[5] == got[6] == [160, 166, 176, 150]


def test_label_position(spark):
    df = one_column(spark, ["G", "A", "Z"], "string")
    assert values(df, labels.label_position(F.col("x"))) == [7, 1, 0]


def test_constant_dimensions(spark):
    scale = {r["etiquette"]: r for r in label_scale(spark).collect()}
    assert list(scale) == list("ABCDEFG")
    assert [k for k, r in scale.items() if r["label_passoire"]] == ["F", "G"]
    assert (scale["E"]["conso_min"], scale["E"]["conso_max"]) == (251, 330)
    assert [r[0] for r in property_types(spark).collect()] == ["appartement", "maison", "autre"]


def test_split_cities(spark):
    members = split_cities(spark).collect()
    assert len(members) == 45
    by_code = {r["code_insee"]: r["member"] for r in members}
    assert by_code["75101"] == "Paris 1er Arrondissement"
    assert by_code["75120"] == "Paris 20e Arrondissement"
    assert by_code["69389"] == "Lyon 9e Arrondissement"
    assert by_code["13216"] == "Marseille 16e Arrondissement"
