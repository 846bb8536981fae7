"""Column expressions and frame helpers on edge inputs."""

from __future__ import annotations

import hashlib
import itertools
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimlake.functions import columns as C
from claimlake.functions import naming as N
from claimlake.operators import dimensions as D
from claimlake.operators import facts, frames, kpi
from claimlake.operators import standardize as S


def one_column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def apply(df, expression):
    return [r[0] for r in df.select(expression).collect()]


# Published keys of business ids.
KEYS = {
    "100": "ad57366865126e55649ecb23ae1d48887544976efea46a48eb5d85a6eeb4d306",
    "200": "27badc983df1780b60c2b3fa9d3a19a00e46aac798451f0febdca52920faaddf",
    "PHARM_1000": "e703a795b6ef4f7bb1509f049366de9126ee522b6811a5ef0c378a11da3584e9",
    "0001": "888b19a43b151683c87895f6211d9f8640f97bdc8ef32f03dbe057c8f5e56d32",
    "28-30": "16808b65dfc4be7a5e10724f1f8ec69922af238003bfc1e9f041af7c815368a6",
    None: "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855",
}


def test_keys(spark):
    assert apply(one_column(spark, KEYS), C.stable_key("v")) == list(KEYS.values())
    assert apply(one_column(spark, [100], "bigint"), C.stable_key("v")) == [KEYS["100"]]


def test_compound_key(spark):
    df = spark.sql("select 'CLM1000000' c, 'MBR100000' m, date '2024-01-01' d, 1 n, cast(null as string) x")
    assert apply(df, C.stable_key("c", "m", "d", "n")) == [
        "e72533c8f8f9fe9ba9be0bba13eb73f1926654b3c59a2d213a965c0e86ed702d"]
    assert apply(df, C.stable_key("c", "x", "n")) == [hashlib.sha256(b"CLM1000000||||1").hexdigest()]
    with pytest.raises(ValueError):
        C.stable_key()


def test_dates(spark):
    cases = {
        "2024-03-05": date(2024, 3, 5), "03/05/2024": date(2024, 3, 5), "3/5/2024": date(2024, 3, 5),
        "25-12-2024": date(2024, 12, 25), "25/12/2024": date(2024, 12, 25),
        "2024-03-05 00:00:00": None, "2024-3-5": None, "3/25/24": None, "2024-02-30": None,
        "13/13/2024": None, "junk": None, "": None, None: None,
    }
    assert apply(one_column(spark, cases), C.parse_date("v")) == list(cases.values())


def test_dates_equal_trying_every_format(spark):
    """Sending a value to one format by its shape loses nothing against trying all five in turn."""
    parts = ["", "0", "00", "1", "01", "02", "2", "12", "13", "29", "30", "31", "32", "99", "003", "x"]
    years = ["2024", "2023", "24", "0000", "02024", "+12024", "1900", "x"]
    texts = [f"{a}{s}{b}{t}{y}" for a, b, y in itertools.product(parts, parts, years)
             for s, t in (("/", "/"), ("-", "-"), ("/", "-"))]
    texts += [f"{y}-{a}-{b}" for a, b, y in itertools.product(parts, parts, years)]
    texts += ["2024/03/05", " 2024-03-05", "2024-03-05 ", "-2024-03-05", "05-Mar-2024", "N/A", "-", "/", "//"]
    tried = F.coalesce(*(F.try_to_date("v", f) for f in C.DATE_FORMATS))
    df = one_column(spark, texts).repartition(8)
    different = df.select("v", tried.alias("a"), C.parse_date("v").alias("b")).filter("not (a <=> b)")
    assert different.collect() == []


def test_safe_casts(spark):
    texts = ["12.345", "12.344", "3.0", "7", " 7 ", "abc", "", "99999999999999999999", "-1.005", None]
    df = spark.createDataFrame([(t, t) for t in texts], "line_charge string, units string")
    rows = S.standardize(df).collect()
    assert [r["line_charge"] for r in rows] == [
        Decimal("12.35"), Decimal("12.34"), Decimal("3.00"), Decimal("7.00"), Decimal("7.00"), None, None,
        None, Decimal("-1.01"), None]
    assert [r["units"] for r in rows] == [None, None, None, 7, 7, None, None, None, None, None]


def test_trim_takes_spaces_only(spark):
    df = one_column(spark, ["  a  ", "a\t", "a\u00a0", "   ", None])
    assert apply(S.standardize(df, S.TRIM_ONLY), "v") == ["a", "a\t", "a\u00a0", "", None]


def test_standardize_ignores_case_and_missing_columns(spark):
    df = spark.sql("select ' e11 ' as DIAGNOSIS_CODE, '1.5' as Line_Charge, 7 as other")
    out = S.standardize(df)
    assert out.columns == ["DIAGNOSIS_CODE", "Line_Charge", "other"]
    assert tuple(out.first()) == ("E11", Decimal("1.50"), 7)


def test_standardize_keeps_dates_that_are_dates(spark):
    df = spark.sql("select date '2024-01-02' admission_date, timestamp '2024-01-03 04:05:06' paid_date")
    assert tuple(S.standardize(df).first()) == (date(2024, 1, 2), date(2024, 1, 3))


def test_rejects(spark):
    df = spark.createDataFrame(
        [("1", "a"), (None, "a"), ("", "a"), ("   ", "a"), ("2", None), ("\t", "b")],
        "claim_id string, member_id string")
    clean, rejects = S.split_rejects(df)
    assert [r["claim_id"] for r in clean.collect()] == ["1", "\t"]
    assert rejects.count() == 4
    assert rejects.select("reject_reason").distinct().collect()[0][0] == "MISSING_REQUIRED_KEY"


def test_raw_condition_misses_no_reject(spark):
    texts = [None, "", " ", "    ", "\t", " \t ", " a", "a ", "!", "0", "\u00a0", "é"]
    df = spark.createDataFrame([(a, b) for a in texts for b in texts], "claim_id string, member_id string")
    _, rejects = S.split_rejects(S.standardize(df))
    _, narrowed = S.split_rejects(S.standardize(df.filter(S.may_be_rejected(df))))
    assert rejects.count() == 12 * 12 - 8 * 8
    assert rejects.exceptAll(narrowed).isEmpty()
    assert spark.range(3).filter(S.may_be_rejected(spark.range(3))).isEmpty()


def test_rejects_without_any_key_column(spark):
    clean, rejects = S.split_rejects(spark.range(3))
    assert clean.count() == 3
    assert rejects.count() == 0 and rejects.columns == ["id", "reject_reason"]


def test_rejects_with_one_key_column(spark):
    clean, rejects = S.split_rejects(spark.createDataFrame([("1",), (None,)], "MEMBER_ID string"))
    assert (clean.count(), rejects.count()) == (1, 1)


def test_impute(spark):
    df = spark.createDataFrame([(None, 1), (Decimal("2.50"), None)], "line_charge decimal(18,2), units int")
    out = facts.apply_rules(df)
    assert out.columns == [
        "line_charge", "units", "line_charge_imputed_flag", "units_imputed_flag", "is_rx_claim"]
    assert [tuple(r) for r in out.collect()] == [
        (Decimal("0.00"), 1, 1, 0, None), (Decimal("2.50"), 0, 0, 1, None)]


def test_rx(spark):
    df = one_column(spark, ["rx", "Pharmacy", "IP", "", None])
    assert apply(df, C.rx_flag("v")) == [1, 1, 0, 0, 0]


def test_date_key(spark):
    df = one_column(spark, [date(2024, 3, 5), date(987, 1, 2), None], "date")
    assert apply(df, C.date_key("v")) == [20240305, 9870102, None]


def test_calendar(spark):
    days = one_column(spark, [date(2024, 12, 28), date(2024, 12, 30), date(2025, 1, 1)], "date")
    rows = days.select(*(c.alias(n) for n, c in C.calendar_columns("v").items())).collect()
    assert [tuple(r) for r in rows] == [
        (20241228, 2024, 4, 12, "December", 28, 7, "Sat", 52, 1),
        (20241230, 2024, 4, 12, "December", 30, 2, "Mon", 1, 0),
        (20250101, 2025, 1, 1, "January", 1, 4, "Wed", 1, 0),
    ]


def test_dim_date_has_every_day_once(spark):
    claims = one_column(spark, [date(2024, 2, 27), None, date(2024, 3, 2)], "date").toDF("admission_date")
    days = [r["date_day"] for r in D.dim_date(claims).orderBy("date_day").collect()]
    assert days == [date(2024, 2, 27), date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1), date(2024, 3, 2)]
    assert D.dim_date(claims.filter("admission_date is null")).count() == 0


def test_first_integer_and_code_list(spark):
    df = one_column(spark, ["73-80", "x", " 5 ", None, "a12b34"])
    assert apply(df, C.first_integer("v")) == ["73", None, "5", None, "12"]
    assert apply(D.first_codes(df, "v"), "code") == ["73", "5", "12"]
    with pytest.raises(ValueError, match="no number in any code"):
        D.first_codes(one_column(spark, ["a", None]), "v")
    assert apply(D.code_list(df, "v"), "code") == ["73-80", "x", "5", "a12b34"]


def test_age_counts_years_of_365_days(spark):
    df = spark.sql("select date '2000-03-03' b, date '2026-03-02' a, date '2030-01-01' later")
    assert apply(df, C.age_in_years("b", "a")) == [26]
    assert apply(df, C.age_in_years("later", "a")) == [-4]


def test_amounts_and_days(spark):
    df = spark.sql("select cast(10.05 as decimal(18,2)) a, cast(0.5 as decimal(4,2)) r, date '2024-02-28' d, 2 n")
    assert apply(df, C.share_of_amount("a", F.col("r"))) == [Decimal("5.03")]
    assert apply(df, C.days_later("d", "n")) == [date(2024, 3, 1)]


def test_headers():
    cases = {
        " HCPC": "hcpc", "LONG DESCRIPTION": "long_description",
        "Place of Service Code(s)": "place_of_service_code_s", "A__b-": "a_b",
    }
    assert {k: N.normalize_header(k) for k in cases} == cases


def test_header_clashes(spark):
    with pytest.raises(ValueError, match="duplicate"):
        N.normalize_headers(spark.range(1).selectExpr("id as `A b`", "id as `a-b`"))


def test_names(spark):
    df = spark.range(1).selectExpr("id as `Code`", "id as `a.b`")
    assert N.find_column(df, "CODE") == "Code" and N.find_column(df, "x") is None
    assert frames.select_existing(df, ["a.b", "nope", "code"]).columns == ["a.b", "code"]
    assert N.rename_existing(df, {"CODE": "revenue_code", "nope": "x"}).columns == ["revenue_code", "a.b"]
    assert N.upper_names(df).columns == ["CODE", "A.B"]


def test_latest_batch(spark):
    df = spark.sql("""select * from values ('a', timestamp '2024-01-02'), ('b', timestamp '2024-01-03'),
        ('c', timestamp '2024-01-03'), ('d', null) as t(run_id, ts)""")
    assert frames.choose_batch(df, "run_id", "ts") == "c"
    assert frames.choose_batch(df, "run_id", "ts", " LATEST ") == "c"
    assert frames.choose_batch(df, "run_id", "ts", " Run-X ") == "Run-X"
    with pytest.raises(ValueError, match="no batch"):
        frames.choose_batch(df.limit(0), "run_id", "ts")
    with pytest.raises(ValueError, match="missing columns"):
        frames.choose_batch(df, "run_id", "other")


def test_dedupe_keeps_the_smallest_row(spark):
    df = spark.createDataFrame(
        [("k", "b", 1), ("k", "a", 3), ("k", "a", 2), (None, "z", 1), (None, "y", 1), ("j", None, 5), ("j", "a", 0)],
        "id string, name string, n int")
    rows = {tuple(r) for r in frames.dedupe_by_key(df, ["ID"]).collect()}
    assert rows == {("k", "a", 2), (None, "y", 1), ("j", None, 5)}
    rows = {tuple(r) for r in frames.dedupe_by_key(df, ["id"], order_by=["n"]).collect()}
    assert rows == {("k", "b", 1), (None, "y", 1), ("j", "a", 0)}
    assert frames.dedupe_by_key(df.select("id"), ["id"]).count() == 3


def test_duplicates(spark):
    df = one_column(spark, ["a", "a", None, None, None, "b"])
    assert {tuple(r) for r in frames.duplicate_groups(df, ["v"]).collect()} == {("a", 2), (None, 3)}


def test_grain(spark):
    assert facts.resolve_grain(spark.range(1).selectExpr("id as CLAIM_LINE_ID", "id as claim_id")) == ["claim_line_id"]
    assert facts.resolve_grain(spark.range(1).selectExpr("id as claim_id", "id as service_line_number")) == [
        "claim_id", "service_line_number"]
    with pytest.raises(ValueError, match="grain"):
        facts.resolve_grain(spark.range(1).selectExpr("id as claim_id"))


def test_plan_key_prefers_health_plan_id(spark):
    df = spark.sql("""select '1' claim_id, '2' member_id, '100' plan_id, '200' health_plan_id,
        date '2024-01-01' admission_date""")
    assert facts.fact_claims(facts.apply_rules(df)).first()["plan_key"] == KEYS["200"]


def test_flags_on_request(spark):
    df = facts.apply_rules(spark.sql("select '1' claim_id, '2' member_id, 1 units, date '2024-01-01' admission_date"))
    assert "units_imputed_flag" not in facts.fact_claims(df).columns
    assert "units_imputed_flag" in facts.fact_claims(df, include_flags=True).columns


def test_dimension_of_codes_is_upper_case(spark):
    source = spark.sql("select * from values ('e11', 'b', 'x'), ('E11', 'a', 'y') as t(diagnosis_code, short_description, long_description)")
    (row,) = D.build_dim(source, D.DIAGNOSIS_CODES).collect()
    assert (row["DIAGNOSIS_CODE"], row["SHORT_DESCRIPTION"]) == ("E11", "a")
    assert row["diagnosis_code_key"] == hashlib.sha256(b"E11").hexdigest()


def test_dimension_renames(spark):
    source = spark.sql("select '0001' CODE, 'Total' DESCRIPTION, 'r' run_id")
    dim = D.build_dim(source, D.REVENUE_CODES)
    assert dim.columns == ["revenue_code", "DESCRIPTION", "revenue_code_key"]
    assert dim.first()["revenue_code_key"] == KEYS["0001"]
    assert D.build_dim(source.withColumn("CODE", F.lit("097x")), D.REVENUE_CODES).first()["revenue_code"] == "097x"
    with pytest.raises(ValueError, match="no column"):
        D.build_dim(source.drop("CODE"), D.REVENUE_CODES)


def test_ranges(spark):
    df = one_column(spark, ["28-30", "1", None, "9-7", "a-b", "5-5", "01-03", "10000-10002", " 98 - 100 ", "008-11"])
    out = D.expand_code_ranges(df.withColumn("n", F.lit(1)), "v")
    assert [r["v"] for r in out.collect()] == [
        "28", "29", "30", "1", None, "9-7", "a-b", "5", "01", "02", "03", "10000", "10001", "10002",
        "98", "99", "100", "008", "009", "010", "011"]
    for text in ("1-100001", "1-" + "9" * 19):
        with pytest.raises(Exception, match="range of more than"):
            D.expand_code_ranges(one_column(spark, [text]), "v").collect()


def test_status_is_optional(spark):
    assert kpi.by_status(spark.range(1)) is None


def test_keys_hashed_together_are_the_same(spark):
    df = spark.sql("select * from values ('a', 1, date'2024-01-01'), (null, null, null), ('', 0, null), ('a||b', 2, null) as t(s, n, d)")
    apart = [C.stable_key("s"), C.stable_key("n"), C.stable_key("s", "n", "d")]
    both = df.select(F.array(*apart).alias("apart"), C.stable_keys([["s"], ["n"], ["s", "n", "d"]]).alias("together")).collect()
    assert all(r.apart == r.together for r in both)
    with pytest.raises(ValueError):
        C.stable_keys([[]])
