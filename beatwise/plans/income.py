"""Income per person by postal area.

Census features are flattened and summed per postal area (partial + final
aggregate, so a populous area is pre-summed in every task), areas without
population are dropped, and the result is joined to the cleaned income
table.  The join strategy is left to the optimizer by default (AQE turns it
into a broadcast when the income side is measured small at run time) or
chosen by the caller; with ``merge`` / ``shuffle_hash`` the aggregate's
shuffle on the postal code is reused by the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatwise.functions.columns import clean_money
from beatwise.operators.features import explode_features, flatten_properties
from beatwise.operators.joins import join_by_key

ZIP = "ZCTA20"
POP = "POP20"
HOUSING = "HOUSING20"


def census_from_docs(docs: DataFrame) -> DataFrame:
    """Documents with a ``features`` array -> one row per feature, properties as columns."""
    return flatten_properties(explode_features(docs), "properties")


def census_by_zip(features: DataFrame) -> DataFrame:
    """``(ZCTA20, HOUSING20, POP20)`` summed per area, areas with ``POP20 > 0`` only.

    An area whose housing values are all null keeps a null housing sum (and
    therefore a null result later on).
    """
    return (features.groupBy(ZIP)
            .agg(F.sum(HOUSING).alias(HOUSING), F.sum(POP).alias(POP))
            .filter(F.col(POP) > 0))


def clean_income(income: DataFrame, money_col: str = "Estimated_Median_Income") -> DataFrame:
    """Money text -> double; rows whose income does not parse are dropped."""
    return (income.withColumn(money_col, clean_money(money_col))
                  .filter(F.col(money_col).isNotNull()))


def per_person(census: DataFrame, income: DataFrame, strategy: str | None = None,
               zip_col: str = "Zip_Code", money_col: str = "Estimated_Median_Income") -> DataFrame:
    """``(Zip_Code, per_person_income)`` = income x housing units / population."""
    joined = join_by_key(census, income, ZIP, zip_col, strategy)
    return joined.select(
        F.col(zip_col).alias("Zip_Code"),
        (F.col(money_col) * F.col(HOUSING) / F.col(POP)).alias("per_person_income"),
    )


def income_per_person(docs: DataFrame, income_text: DataFrame,
                      strategy: str | None = None) -> DataFrame:
    """The DataFrame form: parsed documents + income CSV rows -> per-person income."""
    return income_per_person_flat(census_from_docs(docs), income_text, strategy)


def income_per_person_flat(features: DataFrame, income_text: DataFrame, strategy: str | None = None) -> DataFrame:
    """The same from flat feature rows, such as ``ingest_census`` writes."""
    return per_person(census_by_zip(features), clean_income(income_text), strategy)


def income_per_person_lenient(docs: DataFrame, income_fields: DataFrame) -> DataFrame:
    """The text-scan form, with its own parsing rules.

    Missing population / housing count as 0, rows without a postal code are
    dropped before summing, and only incomes that are digits after removing
    ``$`` / ``,`` and blanks are used.
    """
    features = (census_from_docs(docs)
                .filter(F.col(ZIP).isNotNull())
                .select(ZIP,
                        F.coalesce(F.col(POP), F.lit(0)).alias(POP),
                        F.coalesce(F.col(HOUSING), F.lit(0)).alias(HOUSING)))
    digits = F.trim(F.translate(F.col("Estimated_Median_Income"), "$,", ""))
    income = (income_fields
              .select("Zip_Code", digits.alias("_digits"))
              .filter(F.col("_digits").rlike("^[0-9]+$"))
              .select("Zip_Code", F.col("_digits").cast("double").alias("Estimated_Median_Income")))
    return per_person(census_by_zip(features), income)
