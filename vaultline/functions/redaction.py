"""Masking of secrets in free text and of personal columns."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The credential forms that must not reach a log, in the order they are masked.
CREDENTIALS = (
    r"(password[:=]\s*)([^\s,;&]+)",
    r"(secret[:=]\s*)([^\s,;&]+)",
    r"(token[:=]\s*)([^\s,;&]+)",
    r"(api[-_]?key[:=]\s*)([^\s,;&]+)",
    r"(aws_secret_access_key[:=]\s*)([^\s,;&]+)",
)
DATABASE_URLS = (
    r"(postgres://[^\s:]+:)([^@]+)(@)",
    r"(postgresql://[^\s:]+:)([^@]+)(@)",
)
MASK = "[REDACTED]"
#: A text that a pattern matches holds one of these, in upper or lower case.
WORDS = ("password", "secret", "token", "api", "postgres")


def redact(text: Column) -> Column:
    """Mask credential values and database passwords wherever they stand in the text.

    Texts without any word that a pattern needs are passed through, which is found out without a pattern.
    """
    # in upper, then in lower case: as patterns compare letters, with those that have a case form in common
    folded = F.lower(F.upper(text))
    may_match = reduce(or_, [F.contains(folded, F.lit(word)) for word in WORDS])
    masked = text
    for pattern in CREDENTIALS:
        masked = F.regexp_replace(masked, f"(?iU){pattern}", f"$1{MASK}")
    for pattern in DATABASE_URLS:
        masked = F.regexp_replace(masked, f"(?iU){pattern}", f"$1{MASK}$3")
    return F.when(may_match, masked).otherwise(text)


def mask_personal(customers: DataFrame) -> DataFrame:
    """Customer rows for a reader without clearance: e-mail, phone and income are hidden.

    The mail domain and the last two digits of the phone stay, which reports still need.
    """
    masks = {
        "email": F.concat(F.lit("***@"), F.substring_index(F.col("email"), "@", -1)),
        "phone": F.when(
            F.col("phone").isNotNull(), F.concat(F.lit("******"), F.right(F.col("phone"), F.lit(2)))
        ),
        "annual_income": F.lit(None).cast(customers.schema["annual_income"].dataType),
    }
    return customers.select(*[masks.get(c, F.col(c)).alias(c) for c in customers.columns])
