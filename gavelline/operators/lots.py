"""Lot rows: cleaning at read, weights, and the prepared sales and offers."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavelline.constants import PLACEHOLDER
from gavelline.functions.numbers import bytes_number, exact_sum, no_nan, plain_number
from gavelline.functions.text import clean_text, not_noise, strip

KEYS = ["broker", "lot_number", "sale_number", "sale_date"]
_TEXT = ["mark", "grade", "broker", "lot_number", "sale_number", "buyer"]
_NUMBERS = ["price", "valuation_or_rp", "quantity_kgs", "package_count"]


def clean_columns(df: DataFrame, columns=_TEXT) -> DataFrame:
    """Trim, upper-case and null the noise words of the named text columns."""
    return df.withColumns({c: clean_text(F.col(c)) for c in columns if c in df.columns})


def number_columns(df: DataFrame) -> DataFrame:
    """Stored numbers as doubles, whether they were kept as numbers, text or bytes."""
    kinds = dict(df.dtypes)
    readers = {"binary": bytes_number, "string": plain_number, "double": no_nan, "float": no_nan}
    return df.withColumns({
        c: readers.get(kinds[c], lambda x: x)(F.col(c)).cast("double") for c in _NUMBERS if c in kinds
    })


def key_filter(df: DataFrame) -> DataFrame:
    """Drop rows that lack a broker, lot number, sale number or sale date."""
    return df.na.drop(subset=[k for k in KEYS if k in df.columns])


def stored_lots(df: DataFrame) -> DataFrame:
    """A stored lot table as the analysis reads it: numbers as doubles, texts cleaned, rows without a key dropped.

    Keys are tested on the stored texts, where the test can move towards the scan; what passes needs no second test.
    """
    keys = [k for k in KEYS if k in _TEXT and k in df.columns]
    tests = [not_noise(F.col(k)) for k in keys] + [F.col("sale_date").isNotNull() for _ in {"sale_date"} & set(df.columns)]
    df = number_columns(df.filter(reduce(Column.__and__, tests)) if tests else df)
    df = df.withColumns({k: F.upper(strip(F.col(k))) for k in keys})
    return clean_columns(df, [c for c in _TEXT if c not in keys])


def package_factor(package_count: Column) -> Column:
    """Packages per lot; a missing count or one below 1 counts as 1."""
    return F.greatest(F.coalesce(package_count, F.lit(1.0)), F.lit(1.0))


def total_weight(df: DataFrame) -> DataFrame:
    """Weight of the whole lot; a null quantity stays null."""
    packages = F.col("package_count") if "package_count" in df.columns else F.lit(None).cast("double")
    return df.withColumn("total_weight_kgs", F.col("quantity_kgs") * package_factor(packages))


def is_priced() -> Column:
    """True for a weighed row that counts in price analysis."""
    good = (F.col("total_weight_kgs") > 0) & (F.col("price") > 0) & F.col("lot_number").isNotNull()
    return F.coalesce(good & F.col("sale_number").isNotNull(), F.lit(False))


def mark_sales(raw: DataFrame) -> DataFrame:
    """Sales with their weight and value, labels in place of missing names, and a flag `priced` for those that count.

    Rows that do not count stay, as their sales exist all the same.
    """
    df = total_weight(raw)
    df = df.withColumns({"priced": is_priced(), "value_usd": F.col("price") * F.col("total_weight_kgs")})
    names = {c: F.coalesce(F.col(c), F.lit(PLACEHOLDER)) for c in ("mark", "grade", "buyer", "broker") if c in df.columns}
    return df.withColumns(names)


def prepare_sales(raw: DataFrame) -> DataFrame:
    """Sales with a positive weight and price, their value, and labels in place of missing names."""
    return mark_sales(total_weight(raw).filter(is_priced())).drop("priced")


def prepare_offers(raw: DataFrame) -> DataFrame:
    """Offers with a positive weight."""
    return total_weight(raw).filter(F.col("total_weight_kgs") > 0)


def lots_with_number(df: DataFrame) -> DataFrame:
    """Only rows that carry a lot number."""
    return df.filter(F.col("lot_number").isNotNull())


_SHARED = [
    "source_location", "sale_date", "sale_number", "broker", "mark", "grade", "lot_number", "invoice_number",
    "quantity_kgs", "package_count",
]
_TRACE = ["source_file_identifier", "processed_timestamp"]


def split_lots(df: DataFrame, keep: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(offers, sales): every lot was offered, a lot with a price was also sold."""
    trace = [*_TRACE, *keep]
    offers = df.select(*[c for c in _SHARED + ["valuation_or_rp"] + trace if c in df.columns])
    sales = df.filter(F.col("price").isNotNull())
    return offers, sales.select(*[c for c in _SHARED + ["price", "buyer"] + trace if c in df.columns])


def raw_export(prepared: DataFrame) -> DataFrame:
    """Rows for download under their display names."""
    return prepared.select(
        "sale_number",
        F.col("mark").alias("Mark"),
        F.col("grade").alias("Grade"),
        F.coalesce(F.col("lot_number"), F.lit("")).alias("Lot"),
        no_nan(F.col("total_weight_kgs")).alias("KGs"),
        no_nan(F.col("price")).alias("Price (USD)"),
        F.col("buyer").alias("Buyer"),
        F.col("broker").alias("Broker"),
    )


def grade_summary(offers: DataFrame) -> DataFrame:
    """Distinct lots and kilograms per sale, auction type and grade."""
    keys = ["sale_number", "auction_type", "grade"]
    per_lot = offers.groupBy(*keys, "lot_number").agg(exact_sum(F.col("quantity_kgs")).alias("kgs"))
    return per_lot.groupBy(*keys).agg(F.count("lot_number").alias("lots"), exact_sum(F.col("kgs")).alias("quantity_kgs"))
