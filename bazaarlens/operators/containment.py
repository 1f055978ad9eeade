"""Which needle texts are contained, ignoring case, in which texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import is_small, written

# Up to this many needles travel inside the plan as one array; more are joined.
MAX_INLINE_NEEDLES = 1000
MAX_INLINE_BYTES = 1024 * 1024


def inline(needles: DataFrame) -> bool:
    return is_small(needles, MAX_INLINE_NEEDLES, MAX_INLINE_BYTES)
# Needles of so few lengths are found by cutting the texts at each length; those of more by an index.
FEW_LENGTHS = 16
# Lengths of the index' pieces: a needle is looked up by its rarest piece of the greatest length it has.
# Needles shorter than the least have no piece and are looked up whole.
GRAMS = (8, 3)


def pieces(texts: DataFrame, lengths: list[int]) -> DataFrame:
    """(folded_text, folded_needle): the substrings of each text that have one of the given lengths.

    A row holds at most the start positions of one length, never the substrings themselves.
    """
    listed = F.array(*[F.lit(n) for n in lengths]).cast("array<int>")
    sized = texts.select("folded_text", F.explode(listed).alias("_n")).filter(F.col("_n") <= F.length("folded_text"))
    last = F.when(F.col("_n") == 0, F.lit(1)).otherwise(F.length("folded_text") - F.col("_n") + 1)
    placed = sized.select("folded_text", "_n", F.explode(F.sequence(F.lit(1), last)).alias("_i"))
    return placed.select("folded_text", F.substring("folded_text", F.col("_i"), F.col("_n")).alias("folded_needle"))


def _starting(texts: DataFrame, needles: DataFrame, lengths: list[int]) -> DataFrame:
    """``pieces`` of these lengths, none empty, but only where a needle's first characters stand in the text.

    All needles have as many first characters as the shortest has characters. If there are too many different ones
    to be a lookup, every piece is kept.
    """
    least = min(lengths)
    heads = written(needles.select(F.substring("folded_needle", 1, least).alias("_head")).distinct(), "heads")
    if not is_small(heads):
        return pieces(texts, lengths)
    long_enough = texts.select("folded_text").filter(F.length("folded_text") >= least)
    starts = F.sequence(F.lit(1), F.length("folded_text") - (least - 1))
    placed = long_enough.select("folded_text", F.explode(starts).alias("_i"))
    placed = placed.withColumn("_head", F.substring("folded_text", F.col("_i"), F.lit(least)))
    # Measured small just above.
    placed = placed.join(F.broadcast(heads), "_head", "left_semi").select("folded_text", "_i")
    listed = F.array(*[F.lit(n) for n in lengths]).cast("array<int>")
    sized = placed.select("folded_text", "_i", F.explode(listed).alias("_n"))
    sized = sized.filter(F.col("_i") + F.col("_n") - 1 <= F.length("folded_text"))
    return sized.select("folded_text", F.substring("folded_text", F.col("_i"), F.col("_n")).alias("folded_needle"))


def _grams(text: str, size: int) -> Column:
    """The distinct pieces of ``size`` characters of a column."""
    starts = F.sequence(F.lit(1), F.length(text) - (size - 1))
    cut = F.array_distinct(F.transform(starts, lambda i: F.substring(F.col(text), i, F.lit(size))))
    return F.when(F.length(text) >= size, cut).otherwise(F.array().cast("array<string>"))


def posted(texts: DataFrame, size: int) -> DataFrame:
    """The index: (folded_text, gram) for every distinct piece of every text."""
    return texts.select("folded_text", F.explode(_grams("folded_text", size)).alias("gram"))


def rarest_grams(needles: DataFrame, index: DataFrame, size: int) -> DataFrame:
    """(folded_needle, gram): of each needle's pieces the one that fewest texts have.

    A needle with a piece that no text has is in no text, and is left out.
    """
    frequency = index.groupBy("gram").agg(F.count("*").alias("texts"))
    asked = needles.select("folded_needle", F.explode(_grams("folded_needle", size)).alias("gram"))
    texts = F.coalesce("texts", F.lit(0).cast("long"))
    least = F.min(F.struct(texts.alias("texts"), "gram")).alias("least")
    return asked.join(frequency, "gram", "left").groupBy("folded_needle").agg(least).filter("least.texts > 0").select(
        "folded_needle", "least.gram"
    )


def _short_pieces(texts: DataFrame) -> DataFrame:
    """(folded_text, folded_needle): the distinct substrings of each text that are shorter than a piece of the index."""
    parts = [F.array(F.lit("")), *[_grams("folded_text", size) for size in range(1, GRAMS[-1])]]
    return texts.select("folded_text", F.explode(F.array_distinct(F.concat(*parts))).alias("folded_needle"))


def _indexed(texts: DataFrame, needles: DataFrame) -> DataFrame:
    """The pairs by the index: texts and needles meet in the needle's rarest piece and are then compared."""
    size = F.length("folded_needle")
    short = needles.filter(size < GRAMS[-1])
    found = _short_pieces(texts).join(short, "folded_needle").select("folded_text", "folded_needle")
    for gram, above in zip(GRAMS, (None, *GRAMS), strict=False):
        own = needles.filter((size >= gram) & (size < above if above else F.lit(True)))
        index = posted(texts, gram)
        met = index.join(rarest_grams(own, index, gram), "gram").filter(F.contains("folded_text", "folded_needle"))
        found = found.unionByName(met.select("folded_text", "folded_needle"))
    return found


def occurrences(texts: DataFrame, needles: DataFrame, few_lengths: int = FEW_LENGTHS) -> DataFrame:
    """Pairs (folded_text, folded_needle) with the needles' other columns, once or several times for each row of a needle.
    ``needles`` is read several times.

    With needles of few lengths every substring of a text of such a length is looked up by equality, so each pair
    that leaves the join is a result; where the needles' beginnings are few, only substrings that begin so. With more lengths that would cut each text too often: an index of short
    pieces then takes as many rows as the texts have characters, and the join as many as texts have a needle's
    rarest piece. Nothing is compared all-against-all.
    """
    lengths = needles.select(F.length("folded_needle").alias("n")).distinct().limit(few_lengths + 1).collect()
    if len(lengths) > few_lengths:
        found = _indexed(texts, needles.select("folded_needle").distinct())
        return found.join(needles, "folded_needle").select("folded_text", *needles.columns)
    sizes = sorted(r["n"] for r in lengths)
    empty, rest = [n for n in sizes if n == 0], [n for n in sizes if n]
    cut = pieces(texts, empty) if empty else None
    if rest:
        starting = _starting(texts, needles.filter(F.length("folded_needle") > 0), rest)
        cut = cut.unionByName(starting) if cut is not None else starting
    if cut is None:
        cut = pieces(texts, [0]).limit(0)
    return cut.join(needles, "folded_needle").select("folded_text", *needles.columns)


def containing_pairs(texts: DataFrame, needles: DataFrame, few_lengths: int = FEW_LENGTHS) -> DataFrame:
    """The distinct pairs (folded_text, folded_needle) of ``occurrences``."""
    return occurrences(texts, needles, few_lengths).select("folded_text", "folded_needle").distinct()
