import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridsight.functions import parsing


def parsed(spark, function, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r.v for r in df.select("i", function(F.col("t")).alias("v")).orderBy("i").collect()]


def at(*parts):
    return dt.datetime(*parts)


CASES = [
    (parsing.null_placeholder,
     [".", "-", "Undefined", "Not found", " .", "undefined", "x", None],
     [None, None, None, None, " .", "undefined", "x", None]),
    (parsing.month_abbr_date,
     ["5-Mar-23", "05-mar-23", "31-Feb-23", "LL", "", None, "7-Jan-98"],
     [at(2023, 3, 5), at(2023, 3, 5), None, None, None, None, at(1998, 1, 7)]),
    (parsing.month_abbr_timestamp,
     ["5-Mar-23 04:05:06", "5-Mar-23", None], [at(2023, 3, 5, 4, 5, 6), None, None]),
    (parsing.day_month_year,
     ["5/3/2023", "05/03/23", "31/12/2022", "13/13/2023", None, "01/02/99"],
     [at(2023, 3, 5), at(2023, 3, 5), at(2022, 12, 31), None, None, at(1999, 2, 1)]),
    (parsing.outage_timestamp,
     ["3/5/2023 4:05", "03/05/2023 14:05", "2023-03-05 04:05:06", "2023/03/05", "25/25/2023 1:00", None],
     [at(2023, 3, 5, 4, 5), at(2023, 3, 5, 14, 5), at(2023, 3, 5, 4, 5, 6), None, None, None]),
    (parsing.clock_minutes,
     ["1:02:03", "abc", None, "1:02", "a:b:c", "1:2:3:4", "0:0:30"],
     [62.05, None, None, None, None, None, 0.5]),
    (parsing.hours_as_minutes, ["2", "1.5", "x", None], [120.0, 90.0, None, None]),
    (parsing.month_number, ["Jan", "Dec", "jan", "January", None], [1, 12, None, None, None]),
    (parsing.number_with_commas, ["1,234.5", "7", "n/a", None, "NaN", "-Infinity"], [1234.5, 7.0, None, None, None, None]),
    (parsing.digits_or_null, ["12", "1.5", "-3", "LL", "", " ", None],
     [True, False, False, False, False, False, True]),
    (parsing.blank_as_zero, [None, "", "  ", "1", "x"], [0, 0, 0, 1, None]),
    (parsing.yes_flag, ["YES", "yes", "NO", None], [1, 0, 0, 0]),
    (parsing.billing_month_date, ["202304", "202313", "abc", None], [dt.date(2023, 4, 1), None, None, None]),
    (parsing.billing_month, ["202304", "202313", "abcd", None], [4, 13, None, None]),
    (parsing.month_in_path,
     ["file:/in/Ageing_202304.csv", "file:/in/batch=Ageing_202304/part-0.csv", "file:/x_111111/Ageing.csv/part-0",
      "file:/a_202301/b/c.csv", "file:/in/Ageing_2023045.csv"],
     ["202304", "202304", None, None, None]),
    (lambda c: parsing.respell(c, parsing.CENTRE_SPELLINGS),
     ["Liaquatabad", "FB Area", "Other", None], ["Liaqatabad", "F.B. Area", "Other", None]),
]


@pytest.mark.parametrize("function, texts, expected", CASES, ids=range(len(CASES)))
def test_parsing(spark, function, texts, expected):
    assert parsed(spark, function, texts) == pytest.approx(expected, nan_ok=True) if all(
        isinstance(e, float) for e in expected
    ) else parsed(spark, function, texts) == expected
