"""Diagnosis-code (CID-10) normalisation and classification.

Four sources write the codes in four ways, hence four normalisers.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from occrisk.functions import labels as L
from occrisk.functions.text import lookup


def _dotted(code: Column) -> Column:
    return F.concat(F.left(code, F.lit(3)), F.lit("."), F.substr(code, F.lit(4)))


def basic_cause(col: Column) -> Column:
    """Basic cause of death: four characters get a dot, the filler X stays."""
    code = F.trim(col)
    return F.when(F.length(code) == 4, _dotted(code)).otherwise(code)


def certificate_code(col: Column) -> Column:
    """One code of a certificate line; NULL when its length is none of 3..6."""
    code = F.ltrim(col, F.lit("*"))
    size = F.length(code)
    return (
        F.when((size == 4) & code.endswith("X"), F.left(code, F.lit(3)))
        .when(size == 4, _dotted(code))
        .when(size.isin(3, 5, 6), code)
    )


def comorbidity_code(token: Column) -> Column:
    """Part-II token: upper-cased, shorter than 3 or injury/external -> NULL."""
    code = F.upper(F.trim(token))
    size = F.length(code)
    usable = (size >= 3) & ~chapter(code).isin(*L.NOT_A_COMORBIDITY)
    clean = (
        F.when((size == 4) & code.endswith("X"), F.left(code, F.lit(3)))
        .when(size == 4, _dotted(code))
        .otherwise(code)
    )
    return F.when(usable, clean)


def dictionary_code(col: Column) -> Column:
    """Code of the CID dictionary: a dot after the third character."""
    code = F.trim(col)
    return F.when(F.length(code) >= 4, _dotted(code)).otherwise(code)


def undotted(col: Column) -> Column:
    return F.replace(col, F.lit("."))


def chapter(code: Column) -> Column:
    return F.left(code, F.lit(1))


def category(code: Column) -> Column:
    return F.left(code, F.lit(3))


def death_category(cause: Column, work_accident: Column) -> Column:
    """Insurance-coverage category of a death; the first matching rule wins."""
    letter = chapter(cause)
    rules = [(letter.isin(*L.WORK_DEATH_LETTERS) & (work_accident == "Sim"), L.WORK_DEATH)]
    rules += [(letter == key, label) for key, label in L.TRANSPORT_AND_FALL_DEATH.items()]
    rules += [(cause.between(lo, hi), label) for (lo, hi), label in L.DEATH_BY_RANGE.items()]
    first, *rest = rules
    chain = reduce(lambda acc, rule: acc.when(*rule), rest, F.when(*first))
    return chain.otherwise(lookup(L.DEATH_BY_LETTER, letter, L.UNCLASSIFIED))
