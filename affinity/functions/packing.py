"""Small numbers carried many to a word through a shuffle.

A row that meets its partner in another task is sent once a pair, and most of its
bytes are favourites, attributes and demographics: small numbers, eight bytes each.
Columns whose values all fit a lane (whole numbers from 0, days from 1970, or doubles
that are small multiples of a half) travel as one word: nine numbers, five doubles or
four days where they fit their lanes, else four numbers or doubles in wider lanes, and
where one of them does not fit, they travel as they are. ``unpacked`` gives back the same values in any case.

A column takes its eight bytes in a row even where it is null, so ``folded`` puts what
the narrow words do not hold into two, which are null where there is nothing to hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: per tier and type: bits of a lane, lanes of a word
TIERS = {"tight": {"long": (7, 9), "double": (12, 5), "date": (15, 4)},
         "packed": {"long": (15, 4), "double": (15, 4)}}


def _kind(df: DataFrame, c: str) -> str:
    return df.schema[c].dataType.typeName()


def _groups(df: DataFrame, columns: list[str], tier: str) -> dict[str, tuple[int, list[str]]]:
    """The tier's words: name -> (bits of a lane, the columns that a word holds)."""
    out = {}
    for kind, (bits, lanes) in TIERS[tier].items():
        found = [c for c in columns if _kind(df, c) == kind]
        out |= {f"{tier}_{found[i]}": (bits, found[i:i + lanes]) for i in range(0, len(found), lanes)}
    return out


def _lane(df: DataFrame, c: str, bits: int) -> tuple[Column, Column]:
    """(whether the value fits its lane, its lane): the largest lane is a missing value, 0.0 the middle one, as doubles may be negative."""
    top, kind = (1 << bits) - 1, _kind(df, c)
    null = F.lit(top).cast("bigint")
    if kind != "double":
        whole = F.col(c) if kind == "long" else F.unix_date(c).cast("bigint")
        return F.coalesce(whole.between(0, top - 1), F.lit(True)), F.coalesce(whole, null)
    halves = F.col(c) * 2 + (1 << (bits - 1))
    # the cast is not reached by a value outside the lane; 0.0 may have a sign, which a lane has not
    fits = halves.between(0, top - 1) & (F.floor(halves).cast("double") == halves) & ~F.col(c).cast("string").eqNullSafe("-0.0")
    return F.coalesce(fits, F.lit(True)), F.coalesce(halves.cast("bigint"), null)


def packed(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with the words of ``columns``; what a word holds is null in the wider words and the columns themselves."""
    held: dict[str, Column] = {}
    words: dict[str, Column] = {}
    for tier in TIERS:
        now: dict[str, Column] = {}
        for name, (bits, group) in _groups(df, columns, tier).items():
            fits, word = F.lit(True), F.lit(0).cast("bigint")
            for j, c in enumerate(group):
                fit, lane = _lane(df, c, bits)
                fits, word = fits & fit, word.bitwiseOR(F.shiftleft(lane, bits * j))
            use = fits & _any([~held[c] if c in held else F.lit(True) for c in group])
            words[name] = F.when(use, word)
            now |= {c: use | held[c] if c in held else use for c in group}
        held |= now
    return df.select(*[F.when(~held[c], F.col(c)).alias(c) if c in held else F.col(c) for c in df.columns],
                     *[w.alias(n) for n, w in words.items()])


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def _value(df: DataFrame, c: str, columns: list[str]) -> Column:
    value, kind = F.col(c), _kind(df, c)
    for tier in reversed(TIERS):
        for name, (bits, group) in _groups(df, columns, tier).items():
            if c in group:
                top = (1 << bits) - 1
                lane = F.nullif(F.shiftright(name, bits * group.index(c)).bitwiseAND(F.lit(top)), F.lit(top).cast("bigint"))
                of = {"long": lane, "date": F.date_from_unix_date(lane.cast("int")), "double": (lane - (1 << (bits - 1))) / F.lit(2.0)}[kind]
                value = F.when(F.col(name).isNotNull(), of).otherwise(value)
    return value


def unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of ``packed`` with their values, without the words. A row that a left join found no partner for has nulls."""
    words = {w for tier in TIERS for w in _groups(df, columns, tier)}
    return df.select(*[(_value(df, c, columns) if c in columns else F.col(c)).alias(c) for c in df.columns if c not in words])


#: the two columns of ``folded``: the wider words, and the columns that no word holds
_WIDE, _REST = "packed_wide", "packed_rest"


def folded(df: DataFrame, columns: list[str]) -> DataFrame:
    """``packed`` with the wider words as one column and the columns that no word holds as another, null where nothing is in them."""
    small, wide = packed(df, columns), list(_groups(df, columns, "packed"))
    inside = [c for _, group in _groups(df, columns, "tight").values() for c in group]
    kept = [c for c in small.columns if c not in (*wide, *inside)]
    some = lambda names: F.when(_any([F.col(c).isNotNull() for c in names] or [F.lit(False)]), F.struct(*names))
    return small.select(*kept, some(wide).alias(_WIDE), some(inside).alias(_REST))


def unfolded(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of ``folded`` with their values, behind the others."""
    parts = [F.col(f"{part}.{f.name}").alias(f.name) for part in (_REST, _WIDE) for f in df.schema[part].dataType]
    return unpacked(df.select(*[c for c in df.columns if c not in (_WIDE, _REST)], *parts), columns)


def packed_text(text: Column) -> Column:
    """A text of digits and colons as bytes of two characters each; null for any other text."""
    digits = F.translate(text, ":", "A")
    return F.when(text.rlike("^[0-9:]*\\z"), F.unhex(F.concat(digits, F.when(F.length(digits) % 2 == 1, "F").otherwise(""))))


def unpacked_text(packed: Column) -> Column:
    return F.translate(F.hex(packed), "AF", ":")
