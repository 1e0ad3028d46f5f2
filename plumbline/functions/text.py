"""Text cleaning, header names, keyword flags and categories."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters Unicode calls white space.
UNICODE_SPACES = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim every Unicode space, not only U+0020.

    Looking for 25 characters costs several times a plain trim. A text that begins and ends with
    visible ASCII, as most do, is left alone at the price of two comparisons each.
    """
    text = col(c).cast("string")
    last = F.right(text, F.lit(1))
    clean = (text >= "!") & (text < "\x7f") & (last >= "!") & (last < "\x7f")
    return F.when(clean, text).otherwise(F.trim(text, F.lit(UNICODE_SPACES)))


def clean_text(c: Column | str) -> Column:
    """Trimmed text; blank becomes null (EXP-02)."""
    return F.nullif(strip(c), F.lit(""))


def upper_text(c: Column | str) -> Column:
    return F.upper(clean_text(c))


def null_tokens(c: Column | str, tokens: tuple[str, ...]) -> Column:
    """Several spellings of "no value" become null (SRC-02)."""
    return F.when(~col(c).isin(*tokens), col(c))


def digits_only(c: Column | str) -> Column:
    return F.regexp_replace(col(c), "[^0-9]", "")


def contains_any(c: Column | str, *stems: str) -> Column:
    """Case-blind keyword flag; null text is false (EXP-12)."""
    lowered = F.lower(F.coalesce(col(c), F.lit("")))
    found = F.lit(False)
    for stem in stems:
        found = found | lowered.contains(stem)
    return found


def extract(c: Column | str, pattern: str, group: int = 1) -> Column:
    """Regex group; no match is null (EXP-11)."""
    return F.nullif(F.regexp_extract(col(c).cast("string"), pattern, group), F.lit(""))


def city_of(c: Column | str) -> Column:
    return strip(extract(c, r"^(.*?)\s*-\s*([A-Z]{2})$", 1))


def state_of(c: Column | str) -> Column:
    return extract(c, r"^(.*?)\s*-\s*([A-Z]{2})$", 2)


def title_of(*parts: Column | str) -> Column:
    """``sigla numero ano`` with missing parts kept as empty places (EXP-33)."""
    filled = [F.coalesce(col(p).cast("string"), F.lit("")) for p in parts]
    return F.concat_ws(" ", *filled)


# Accepted spellings of the two truth values.
TRUE_WORDS = ("true", "sim", "s", "1", "yes")
FALSE_WORDS = ("false", "não", "nao", "n", "0", "no")


def boolean_word(c: Column | str) -> Column:
    word = F.lower(strip(c))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def fold_vote(c: Column | str) -> Column:
    """Lower case without the accents that occur in vote words (EXP-09)."""
    return F.translate(F.lower(strip(c)), "ãçéíóú", "aceiou")


def document_kind(c: Column | str) -> Column:
    size = F.length(col(c))
    return F.when(size == 14, "CNPJ").when(size == 11, "CPF").otherwise("OUTRO")


def _without_accents(name: str) -> str:
    return "".join(ch for ch in unicodedata.normalize("NFKD", name) if not unicodedata.combining(ch))


def header_name(name: str) -> str:
    """``Código  Órgão`` -> ``codigo_orgao`` (EXP-01a)."""
    return re.sub(r"[^a-zA-Z0-9]+", "_", _without_accents(name)).strip("_").lower()


def camel_name(name: str) -> str:
    """``ultimoStatus_idOrgao`` -> ``ultimo_status_id_orgao``; runs of capitals stay glued (EXP-01b)."""
    return re.sub(r"(?<=[^\W_A-Z])(?=[A-Z])", "_", name).lower()


def snake_name(name: str) -> str:
    return header_name(re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", _without_accents(name)))


def rename_all(df: DataFrame, rule) -> DataFrame:
    return df.toDF(*[rule(name) for name in df.columns])
