"""Text as columns: words, shingles, folds, detectors. Everything stays on the JVM side but nfc() and unaccented()."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Letters, digits and underscore, spelled out: \w differs between engines.
WORD = r"[\p{L}\p{N}_]+"
LETTERS = r"\p{L}+"
#: Soft hyphen, zero-width characters, word joiner, byte order mark.
INVISIBLE = "­​‌‍⁠﻿"

# The commonest function words of Spanish (the measure is of running prose, not of language).
FUNCTION_WORDS_ES = """
de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si sin sobre este ya entre
cuando todo esta ser son dos también fue había era muy hasta desde está mi porque qué sólo solo han yo hay vez puede todos así
nos ni parte tiene él uno donde bien mismo ese ahora cada e otro después te otros aunque esa eso hace otra tan durante siempre
tanto ella sí sido según menos les fueron estos estas cual quien ante tras hacia contra mientras pues u ya que sea será
""".split()


@F.pandas_udf(StringType())
def nfc(text: pd.Series) -> pd.Series:
    """Unicode composition, which Spark has no function for."""
    return text.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


@F.pandas_udf(StringType())
def unaccented(text: pd.Series) -> pd.Series:
    """Compatibility decomposition without combining marks."""
    return text.map(lambda t: "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)), na_action="ignore")


def words(text: Column, pattern: str = WORD) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({pattern})"), 1)


def composed(text: Column) -> Column:
    """Unicode composition. Characters below U+0300 are composed as they stand, so only texts with others go to Python."""
    return F.coalesce(nfc(F.when(text.rlike(r"[^\x00-\u02ff]"), text)), text)


def canonical(text: Column) -> Column:
    """Invisible characters out, white space folded. Composed input is assumed (composed() makes it)."""
    return F.trim(F.regexp_replace(F.translate(text, INVISIBLE, ""), r"[\s ]+", " "))


def grams(words_: Column, n: int) -> Column:
    """Space-joined n-grams in order, with repeats; none below n words. The words are bound once: an expression named inside the
    inner function would be worked out again for each n-gram."""
    joined = lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.array_join(F.slice(w, i, n), " "))
    return F.transform(F.array(words_), lambda w: F.when(F.size(w) >= n, joined(w)).otherwise(F.array().cast("array<string>")))[0]


def short_hash(text: Column) -> Column:
    """First 16 hexadecimal digits of SHA-256."""
    return F.substring(F.sha2(text, 256), 1, 16)


def count_if(array: Column, test) -> Column:
    return F.size(F.filter(array, test))


def share(part: Column, whole: Column) -> Column:
    """part / whole, zero where whole is."""
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def joined_reasons(*pairs: tuple[str, Column]) -> Column:
    """Names, in order, of the conditions that hold, joined by commas; empty if none does."""
    return F.array_join(F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in pairs]), lambda x: x.isNotNull()), ",")
