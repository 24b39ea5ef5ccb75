"""Golden rows of the text functions."""

from pyspark.sql import functions as F

from affilspark.functions import text as X
from affilspark.functions.country import country_map


def run(spark, expr, *values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_norm_text(spark):
    rows = ["  A   B   C ", "a\t\nb  c", " x　", "a\x0bb", "", None, "\tx", "İ"]
    assert run(spark, X.norm_text("c"), *rows) == ["a b   c", "a b  c", "x", "a\x0bb", None, None, " x", "i̇"]
    assert run(spark, X.norm_text("c", collapse="all"), "  A   B   C ") == ["a b c"]
    assert run(spark, X.norm_text("c", empty_to_null=False), None, " ") == ["", ""]
    assert run(spark, X.norm_text("c", trimmed=False), "  A  B") == [" a  b"]


def test_tokens(spark):
    assert run(spark, X.token_set("c"), "a b a", "  ", "", "x   y") == [["a", "b"], [], [], ["x", "y"]]
    assert run(spark, X.first_token("c"), " a b", "  ", "b") == ["a", "", "b"]
    shared, size, ratio = X.token_overlap(F.split("c", " "), F.array(F.lit("a"), F.lit("z")))
    assert run(spark, F.struct(shared, size, ratio), "a b", "q") == [(1, 2, 0.5), (0, 1, 0.0)]


def test_dates(spark):
    df = spark.createDataFrame([(None, None, None), ("2010", "3", None), (None, "5", None), ("7", "1", "2")], "y string, m string, d string")
    assert [r[0] for r in df.select(X.partial_date("y", "m", "d")).collect()] == [None, "2010-03-00", "0000-05-00", "0007-01-02"]
    assert run(spark, X.start_year("c"), "2010-03-00", "20", None, "0000-05-00") == [2010, None, None, 0]
    assert run(spark, X.year_dir("c"), 2010, 7, None, 0, kind="int") == ["2010", "0007", "null", "0000"]


def test_keys(spark):
    df = spark.createDataFrame([("ROR", "X1", "n", "c", "t"), ("ROR", None, "N", "C", "T"), (None, None, "n", "c", "t"), (None, None, None, "", "t")], "s string, i string, n string, c string, t string")
    a, b, c, d = (r[0] for r in df.select(X.org_key("s", "i", "n", "c", "t")).collect())
    assert a == "ror:x1" and b == c and d != c
    one, two = run(spark, X.row_key("c"), None, "")
    assert one != two
    null, empty = run(spark, X.lower_key("c"), None, "")
    assert null == empty


def test_identifiers(spark):
    df = spark.createDataFrame([("FUNDREF", "http://dx.doi.org/10.13039/501"), ("fundref", "none"), ("GRID", "GRID.1.2"), ("Ringgold", "RIN123abc4"), ("ror", "HTTPS://X"), ("other", "1")], "s string, i string")
    assert [r[0] for r in df.select(X.org_identifier("s", "i")).collect()] == ["501", "", "grid.1.2", "123", "https://x", None]
    assert run(spark, X.norm_isni("c"), "0000 0001-2345 678x") == ["000000012345678X"]
    assert run(spark, X.clean_domain("c"), ' "A.org" ', "b", '""') == ["a.org", "b", ""]
    assert run(spark, X.blank_to_null("c"), " a ", "  ", None) == ["a", None, None]
    assert run(spark, X.percent(F.col("c"), F.lit(0)), 1, kind="int") == [None]


def test_country_map(spark):
    raw = ["US", "us", " u s ", "ＵＳ", "XK", "NA", "ZZ", "U1", "Kosovo", "", None]
    counted = spark.createDataFrame([(r, 1) for r in raw], "organization_country string, cnt long")
    iso = spark.createDataFrame([("US",), ("NA",), ("RS",)], "alpha2 string")
    terr = spark.createDataFrame([("XK", "RS"), ("KOSOVO", "RS"), ("QQ", "WW")], "`from` string, alpha2 string")
    got = {r[0]: (r[1], r[2]) for r in country_map(counted, iso, terr).collect()}
    iso2, none = ("US", "iso2"), (None, "fallback")
    assert got == {"US": iso2, "us": iso2, " u s ": iso2, "ＵＳ": iso2, "XK": ("RS", "territorial"), "NA": ("NA", "iso2"), "ZZ": none, "U1": none, "Kosovo": ("RS", "territorial"), "": none, None: none}
