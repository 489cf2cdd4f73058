"""Language names and codes: a fixed table, small enough to broadcast whatever the data's size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Code, name, three-letter code.
LANGUAGES = (
    ("af", "Afrikaans", "afr"), ("ar", "Arabic", "ara"), ("bg", "Bulgarian", "bul"), ("ca", "Catalan", "cat"), ("cs", "Czech", "ces"), ("da", "Danish", "dan"), ("de", "German", "deu"),
    ("el", "Greek", "ell"), ("en", "English", "eng"), ("es", "Spanish", "spa"), ("et", "Estonian", "est"), ("fa", "Persian", "fas"), ("fi", "Finnish", "fin"), ("fr", "French", "fra"),
    ("he", "Hebrew", "heb"), ("hi", "Hindi", "hin"), ("hr", "Croatian", "hrv"), ("hu", "Hungarian", "hun"), ("id", "Indonesian", "ind"), ("it", "Italian", "ita"), ("ja", "Japanese", "jpn"),
    ("ko", "Korean", "kor"), ("lt", "Lithuanian", "lit"), ("lv", "Latvian", "lav"), ("nl", "Dutch", "nld"), ("no", "Norwegian", "nor"), ("pl", "Polish", "pol"), ("pt", "Portuguese", "por"),
    ("ro", "Romanian", "ron"), ("ru", "Russian", "rus"), ("sk", "Slovak", "slk"), ("sl", "Slovenian", "slv"), ("sv", "Swedish", "swe"), ("th", "Thai", "tha"), ("tr", "Turkish", "tur"),
    ("uk", "Ukrainian", "ukr"), ("ur", "Urdu", "urd"), ("vi", "Vietnamese", "vie"), ("zh", "Chinese", "chi_sim"),
)
RIGHT_TO_LEFT = ("ar", "fa", "ur", "he")


def language_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LANGUAGES), "code string, name string, code3 string")


def language_code(c: Column) -> Column:
    """Code of a name in any case, or of a code; anything else raises."""
    known = F.create_map(*[F.lit(x) for code, name, _ in LANGUAGES for x in (name.lower(), code)])
    found = F.coalesce(F.get(F.array(*[F.lit(c2) for c2, _, _ in LANGUAGES]), F.array_position(F.array(*[F.lit(c2) for c2, _, _ in LANGUAGES]), F.lower(c)).cast("int") - 1), F.try_element_at(known, F.lower(c)))
    return F.when(c.isNull() | found.isNotNull(), found).otherwise(F.raise_error(F.concat(F.lit("unknown language: "), c)))


def unique_languages(langs: Column) -> Column:
    """Of an array of arrays, each language once, in order of first occurrence."""
    return F.array_distinct(F.flatten(langs))


def is_right_to_left(code: Column) -> Column:
    return code.isin(*RIGHT_TO_LEFT)
