"""Colours of marked tokens and distances of boxes (layout helpers)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Steps of the palette along red, green and blue (fixed values).
STEPS = (50, 51, 51)


def palette(n: Column) -> Column:
    """The n-th colour of the cyclic palette as an array of red, green and blue, from multiples of five."""
    r, g, b = STEPS
    k = F.pmod(n, F.lit(r * g * b)).cast("int")
    return F.array(
        (F.floor(k / (g * b)) + 1).cast("int") * 5, F.pmod(F.floor(k / b), F.lit(g)).cast("int") * 5, F.pmod(k, F.lit(b)).cast("int") * 5
    )


def is_inserted(colour: Column) -> Column:
    """Whether a colour is none of the palette."""
    return F.exists(colour, lambda x: x % 5 != 0)


def box_distance(x1: Column, y1: Column, x2: Column, y2: Column, alpha: float = 10.0) -> Column:
    """Distance of two centres, rows counting ``alpha`` times as much."""
    return F.sqrt(F.pow(x1 - x2, 2) + alpha * F.pow(y1 - y2, 2))


#: Tokens of a TeX text that keep their form; what is left between them is words (fixed values).
_KEPT = r"\\[A-Za-z]+\*?(?:\[[^\]]*\])?|[{}$&#^_~%]|\s+"


def coloured(text: Column, start: Column) -> Column:
    """A TeX text each word of which has the next colour of the palette (V3, V4). Commands, braces and blanks stay."""
    parts = F.regexp_extract_all(text, F.lit(rf"{_KEPT}|[^\\{{}}$&#^_~%\s]+"), F.lit(0))
    word = F.transform(parts, lambda p: (~p.rlike(rf"^(?:{_KEPT})$")).cast("int"))

    def one(p: Column, i: Column) -> Column:
        before = F.aggregate(F.slice(word, 1, i), F.lit(0), lambda a, x: a + x)
        c = F.array_join(palette(start + before), ",")
        return F.when(F.get(word, i) == 1, F.concat(F.lit("{\\color[RGB]{"), c, F.lit("}"), p, F.lit("}"))).otherwise(p)

    return F.array_join(F.transform(parts, one), "")


def before(a: Column, b: Column) -> Column:
    """Whether a colour comes before another, part by part (V1)."""
    return F.struct(*(F.get(a, F.lit(i)) for i in range(3))) < F.struct(*(F.get(b, F.lit(i)) for i in range(3)))
