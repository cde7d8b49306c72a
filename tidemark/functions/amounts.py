"""Money amounts in several notations, read in steps of plain expressions so that all of it is generated code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Signs, currency codes and words for a missing amount.
SIGNS = {"$": "USD", "€": "EUR", "£": "GBP", "₫": "VND", "¥": "JPY"}
CODES = ("USD", "EUR", "GBP", "VND", "JPY", "SGD", "THB")
MISSING = ("", "-", "N/A", "n/a", "NULL", "null", "none")
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_WORD = r"(?i)\b(" + "|".join(CODES) + r")\b"


def with_amount(df: DataFrame, text: str, into: str) -> DataFrame:
    """df with into: struct(amount decimal(18,2), currency, format, is_negative, note) of the column text; format is US, EU, VN, CLEAN, AMBIGUOUS or INVALID.

    A currency sign counts at the start alone, else the first code anywhere; one level of minus or brackets goes. With both separators the
    last one is the decimal point. One separator before exactly three digits could be either: that is AMBIGUOUS, without amount, unless
    the currency is VND, which has no cents. Repeated separators group thousands. nan and inf are INVALID. Each step is a column of its own
    that the next ones use, so that nothing is worked out twice.
    """
    t, sign, code, bare, body, kind, plain, number = (F.col(f"__{c}") for c in ("t", "sign", "code", "bare", "body", "kind", "plain", "number"))
    given = t.isNotNull() & ~t.isin(*MISSING)
    bracketed, minus = F.col("__bracketed"), F.col("__minus")
    dots, commas = F.col("__dots"), F.col("__commas")
    last_dot = F.char_length(F.substring_index(body, ".", -1)) < F.char_length(F.substring_index(body, ",", -1))
    three = F.char_length(F.substring_index(F.translate(body, ",", "."), ".", -1)) == 3
    steps: list[dict[str, Column]] = [
        {"t": F.trim(text)},
        {"sign": F.coalesce(*[F.when(F.substring(t, 1, 1) == s, F.lit(c)) for s, c in SIGNS.items()]), "code": F.when(given & t.rlike("[A-Za-z]"), F.upper(F.nullif(F.regexp_extract(t, _WORD, 1), F.lit(""))))},
        {"bare": F.trim(F.when(sign.isNotNull(), F.substring(t, 2, 1 << 20)).when(code.isNotNull(), F.regexp_replace(t, _WORD, "")).otherwise(t))},
        {"bracketed": bare.startswith("(") & bare.endswith(")") & (F.char_length(bare) > 1), "minus": bare.startswith("-")},
        {"body": F.translate(F.when(bracketed, F.substring(bare, F.lit(2), F.char_length(bare) - 2)).when(minus, F.substring(bare, 2, 1 << 20)).otherwise(bare), "  ", "")},
        {"dots": F.char_length(body) - F.char_length(F.translate(body, ".", "")), "commas": F.char_length(body) - F.char_length(F.translate(body, ",", ""))},
        {
            "kind": F.when((dots == 0) & (commas == 0), "CLEAN")
            .when((dots > 0) & (commas > 0), F.when(last_dot, "US").otherwise("EU"))
            .when(dots > 1, "VN")
            .when(commas > 1, "US")
            .when(three, F.when(F.coalesce(sign, code) == "VND", "VN").otherwise("AMBIGUOUS"))
            .when(dots == 1, "CLEAN")
            .otherwise("EU")
        },
        {"plain": F.when(kind == "VN", F.translate(body, ".,", "")).when(kind == "US", F.translate(body, ",", "")).when(kind == "EU", F.translate(body, ",.", ".")).otherwise(body)},
        {"number": F.when(given & plain.rlike(_NUMBER), plain.try_cast("double"))},
    ]
    out = df
    for step in steps:
        out = out.withColumns({f"__{k}": v for k, v in step.items()})
    ambiguous, lost = given & (kind == "AMBIGUOUS"), ~given | number.isNull()
    negative = given & (bracketed | minus)
    value = F.when(given & ~ambiguous, F.when(negative, -number).otherwise(number)).try_cast("decimal(18,2)")
    note = F.when(t.isNull(), "null input").when(~given, "no amount").when(ambiguous, "one separator before three digits").when(number.isNull(), "not a number")
    found = F.struct(
        value.alias("amount"),
        F.when(given, F.coalesce(sign, code)).alias("currency"),
        F.when(ambiguous, "AMBIGUOUS").when(lost, "INVALID").otherwise(kind).alias("format"),
        F.coalesce(negative, F.lit(False)).alias("is_negative"),
        note.alias("note"),
    )
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c != into], found.alias(into))
