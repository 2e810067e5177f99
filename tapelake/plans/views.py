"""Logical views over the test tables, in both languages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.isin import luhn_is_valid
from ..functions.numbers import strict_decimal, strict_integer
from ..functions.text import norm
from ..session import fixed, table

_SHAPE = r"^IN[A-Z0-9]{9}[0-9]\z"


def rows(spark: SparkSession, sf: str) -> DataFrame:
    """Canonical rows as delivered, with their file, normalised code, ticker and identity."""
    m = table(spark, sf, "members").select("member_id", "feed", "root", "file_name", F.col("date_from_filename").alias("trade_date"))
    p = table(spark, sf, "price_rows").join(m, "member_id")
    p = p.withColumn("isin_n", F.coalesce(norm(F.col("isin")), F.lit("")))
    i = F.col("isin_n")
    validity = (
        F.when(i == "", "BLANK").when(F.length(i) != 12, "LEN").when(~i.startswith("IN"), "PREFIX").when(~i.rlike(_SHAPE), "CHARSET")
        .when(~luhn_is_valid(i), "CHECKDIGIT").otherwise("VALID")
    )
    legacy = F.col("format_family") == "legacy13"
    ticker = F.when(legacy | ((F.col("sgmt") == "CM") & (F.col("fininstrmtp") == "STK")), F.col("symbol"))
    return p.select(
        "row_id", "member_id", "source_line_number", "format_family", "symbol", "series", "isin", "isin_n", validity.alias("validity"), "sgmt", "src", "fininstrmtp",
        "price_open", "price_high", "price_low", "price_close", "price_last", "price_prev_close", "tottrdqty", "tottrdval", "totaltrades", "raw_biz_dt", "loaded_at",
        "feed", "root", "file_name", "trade_date", F.year("trade_date").alias("year"),
        strict_integer(F.col("tottrdqty")).alias("quantity"), (strict_decimal(F.col("price_close")) * 100).try_cast("bigint").alias("close_paise"),
        F.when(ticker.rlike(r"\S"), ticker).alias("ticker"),
    ).withColumn("identity", F.when(F.col("validity") == "VALID", F.col("isin_n")))


def once(df: DataFrame, column: str) -> DataFrame:
    """`df` with a computed column that is used several times worked out once a row."""
    return fixed(df.withColumnRenamed(column, "_once"), **{column: F.col("_once")}).drop("_once")


_LUHN = """list_sum(list_transform(list_reverse(string_split(list_aggregate(list_transform(string_split(isin_n, ''),
    lambda c: case when c between 'A' and 'Z' then cast(ord(c) - 55 as varchar) else c end), 'string_agg', ''), '')),
    lambda c, k: case when k % 2 = 1 then cast(c as int) when cast(c as int) > 4 then cast(c as int) * 2 - 9 else cast(c as int) * 2 end)) % 10 = 0"""
ROWS = rf"""
r0 as (
  select p.*, m.feed, m.root, m.file_name, m.date_from_filename as trade_date, cast(year(m.date_from_filename) as int) as year,
    coalesce(upper(regexp_replace(p.isin, '^\s+|\s+$', '', 'g')), '') as isin_n,
    case when regexp_full_match(tottrdqty, '-?[0-9]+') then try_cast(tottrdqty as bigint) end as quantity,
    case when regexp_full_match(price_close, '-?[0-9]+(\.[0-9]+)?') then cast(floor(cast(price_close as decimal(28, 10)) * 100) as bigint) end as close_paise,
    case when (format_family = 'legacy13' or (sgmt = 'CM' and fininstrmtp = 'STK')) and regexp_matches(symbol, '\S') then symbol end as ticker
  from price_rows p join members m using (member_id)),
r1 as (
  select *, case when isin_n = '' then 'BLANK' when length(isin_n) <> 12 then 'LEN' when isin_n not like 'IN%' then 'PREFIX'
    when not regexp_full_match(isin_n, 'IN[A-Z0-9]{{9}}[0-9]') then 'CHARSET' when not ({_LUHN}) then 'CHECKDIGIT' else 'VALID' end as validity from r0),
rows as (select *, case when validity = 'VALID' then isin_n end as identity from r1)"""
