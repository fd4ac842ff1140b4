"""Product weights in mixed units, to kilograms."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import HEAVIEST_CLASS, WEIGHT_CLASSES, WEIGHT_UNITS
from .numbers import strict_double


def _by_unit(weight: Column, place: int, usual: float | None = None) -> Column:
    """An entry of the unit the text ends in; only units that differ from `usual` are tested."""
    tested = [(weight.endswith(u[0]), F.lit(u[place])) for u in WEIGHT_UNITS if u[place] != usual]
    return reduce(lambda chain, branch: chain.when(*branch), tested, F).otherwise(F.lit(usual))


def to_kg(weight: Column) -> Column:
    """Weight text to kilograms; text in no known unit, or with no readable number, is null.

    `3 x 2g` is a pack, always of grams; in any other unit it cannot be read. Unit
    letters are cut from both ends in any order, so `.5g .` reads as 5. The text is cut
    and parsed once whatever its unit: a branch per unit would make a method too large
    for the JVM to compile.
    """
    amount = strict_double(F.btrim(weight, _by_unit(weight, 0)))
    single = amount * _by_unit(weight, 1, 1.0) / _by_unit(weight, 2, 1000.0)
    pack = F.split(F.btrim(weight, F.lit("g")), " ")
    packed = strict_double(F.get(pack, F.lit(0))) * strict_double(F.get(pack, F.lit(2))) / 1000.0
    other_units = [weight.endswith(unit) for unit, *_ in WEIGHT_UNITS if unit != "g"]
    is_pack = weight.contains("x") & ~reduce(lambda a, b: a | b, other_units)
    return F.when(is_pack, packed).otherwise(single)


def weight_class(kg: Column) -> Column:
    """Delivery class of a weight in kilograms; null stays null."""
    (limit, name), *rest = WEIGHT_CLASSES
    chain = reduce(lambda c, lc: c.when(kg < lc[0], lc[1]), rest, F.when(kg < limit, name))
    return chain.when(kg >= rest[-1][0], HEAVIEST_CLASS)
