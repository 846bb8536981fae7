"""The test tables seen as claims and lookups.

``lineitem`` with its orders, customer, part and supplier plays the raw claim lines, all text, with
dirt projected in over the whole table: missing keys, blanks, mixed case, five date layouts,
unparsable amounts. The other tables play the lookups.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

AS_OF = "2026-03-02"

# Raw column -> (expression, tables it needs besides lineitem).
_RAW_CLAIM = {
    "claim_id": (
        "case when l_orderkey % 97 = 0 then '   ' when l_orderkey % 89 = 0 then null"
        " else cast(l_orderkey as string) end", ()),
    "service_line_number": ("cast(l_linenumber as string)", ()),
    "member_id": (
        "case when o_custkey % 101 = 0 then null else concat(' ', cast(o_custkey as string), ' ') end",
        ("orders",)),
    "provider_id": ("cast(l_suppkey as string)", ()),
    "pharmacy_id": ("cast(s_nationkey as string)", ("supplier",)),
    "plan_id": ("cast(c_nationkey as string)", ("orders", "customer")),
    "procedure_code": ("cast(l_partkey as string)", ()),
    "diagnosis_code": (
        "case when l_partkey % 61 = 0 then null else concat(' ', lower(p_brand)) end", ("part",)),
    "revenue_code": ("o_orderpriority", ("orders",)),
    "place_of_service_std_id": (
        "case when l_partkey % 61 = 0 then null else substr(o_orderpriority, 1, 1) end", ("orders",)),
    "claim_type": ("case l_returnflag when 'A' then 'IP' when 'N' then 'OP' else 'rx' end", ()),
    "claim_status": ("o_orderstatus", ("orders",)),
    "admission_date": (
        "case l_orderkey % 5"
        " when 0 then date_format(cast(o_orderdate as date), 'yyyy-MM-dd')"
        " when 1 then date_format(cast(o_orderdate as date), 'MM/dd/yyyy')"
        " when 2 then date_format(cast(o_orderdate as date), 'dd-MM-yyyy')"
        " when 3 then date_format(cast(o_orderdate as date), 'dd/MM/yyyy')"
        " else 'unknown' end", ("orders",)),
    "discharge_date": ("date_format(cast(l_shipdate as date), 'yyyy-MM-dd')", ()),
    "line_charge": (
        "case when l_partkey % 53 = 0 then 'N/A' when l_partkey % 59 = 0 then null"
        " else concat(cast(cast(l_extendedprice as decimal(18,2)) as string), '5') end", ()),
    "line_allowed": (
        "cast(cast(cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(4,2)))"
        " as decimal(18,4)) as string)", ()),
    "units": (
        "case when l_linenumber = 7 then '3.0' else cast(cast(l_quantity as int) as string) end", ()),
}
# Joins to lineitem, in their order: it moves while it is narrow, and orders come last, with most of the columns.
_JOINS = {
    "supplier": ("l_suppkey", "s_suppkey"),
    "part": ("l_partkey", "p_partkey"),
    "orders": ("l_orderkey", "o_orderkey"),
}


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table. Its schema is looked up once per path, as each look-up is a job."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def raw_claims(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None) -> DataFrame:
    """All claim lines as raw text. Joins only the tables the wanted columns come from; customers are joined to
    orders, which are a quarter of the lines."""
    columns = list(_RAW_CLAIM) if columns is None else list(columns)
    needed = {t for c in columns for t in _RAW_CLAIM[c][1]}
    joined = table(spark, sf_dir, "lineitem")
    for name, (left, right) in _JOINS.items():
        if name in needed:
            other = table(spark, sf_dir, name)
            if name == "orders" and "customer" in needed:
                other = other.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
            joined = joined.join(other, F.col(left) == F.col(right))
    return joined.select(*(F.expr(_RAW_CLAIM[c][0]).alias(c) for c in columns))


def lookup(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the eight lookup tables, by the name the dimension specs use."""
    sources, expressions = _LOOKUPS[name]
    df = table(spark, sf_dir, sources[0])
    if len(sources) > 1:
        df = df.join(table(spark, sf_dir, sources[1]), F.expr("n_regionkey = r_regionkey"))
    return df.selectExpr(*expressions)


_BORN = "date_add(date '1940-01-01', cast(c_custkey % 25000 as int))"
# Lookup -> (tables it comes from, columns).
_LOOKUPS = {
    "members": (("customer",), (
        "cast(c_custkey as string) as member_id",
        "c_name as member_name",
        f"cast({_BORN} as string) as member_dob",
        "case when c_mktsegment < 'F' then 'F' else 'M' end as member_gender",
        f"cast(floor(datediff(date '{AS_OF}', {_BORN}) / 365) as bigint) as member_age",
    )),
    "providers": (("supplier",), (
        "cast(s_suppkey as string) as provider_id",
        "1000000000 + s_suppkey as npi",
        "concat('SPECIALTY_', cast(s_nationkey as string)) as provider_specialty",
        "substr(s_name, 10, 3) as provider_state",
    )),
    "pharmacies": (("nation", "region"), (
        "cast(n_nationkey as string) as pharmacy_id",
        "n_name as pharmacy_name",
        "r_name as pharmacy_state",
    )),
    "health_plans": (("nation", "region"), (
        "cast(n_nationkey as bigint) as plan_id",
        "n_name as plan_name",
        "substr(r_name, 1, 2) as plan_state",
        "r_name as payer_type",
    )),
    "ref_icd10_diagnosis": (("part",), (
        "lower(p_brand) as DIAGNOSIS_CODE",
        "p_type as SHORT_DESCRIPTION",
        "concat(p_type, ' ', p_name) as LONG_DESCRIPTION",
    )),
    "ref_hcpcs": (("part",), (
        "cast(p_partkey as string) as hcpc",
        "concat(p_name, ' ', p_type) as long_description",
        "p_name as short_description",
    )),
    "ref_revenue_codes": (("orders",), (
        "o_orderpriority as CODE",
        "concat('Priority ', substr(o_orderpriority, 3)) as DESCRIPTION",
    )),
    "ref_place_of_service": (("orders",), (
        "case when o_orderkey % 61 = 0 then null"
        " when substr(o_orderpriority, 1, 1) in ('3', '4') then '3-4'"
        " else substr(o_orderpriority, 1, 1) end as Place_of_Service_Code",
        "substr(o_orderpriority, 3) as Place_of_Service_Name",
        "concat('Status ', o_orderstatus) as Place_of_Service_Description",
    )),
}
