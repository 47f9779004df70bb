"""Rows that may hold one of many keys, told by a broadcast bitmap instead of an exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.functions.stored import stored

BITMAP_BITS = 1 << 28  # 32 MB when broadcast


def maybe_among(df: DataFrame, key: str, wanted: DataFrame, n: int, most_bits: int = BITMAP_BITS) -> DataFrame:
    """The rows of ``df`` whose ``key`` (a 64-bit hash) is one of the ``n`` of ``wanted`` and a few others, found without a shuffle of ``df``.

    A bit of a broadcast bitmap stands for each wanted hash; of 16 times as many bits about one in 16 is set, so as many rows pass
    besides. Beyond ``most_bits`` more pass, none that is wanted is lost.
    """
    bits = min(most_bits, 1 << (16 * n - 1).bit_length())
    at = F.pmod(F.col(key), F.lit(bits))
    word, bit = F.shiftright(at, 6), at.bitwiseAND(63).cast("int")
    # words of 64 bits, 64 of them to a line of the broadcast table
    words = wanted.select(word.alias("_word"), F.expr(f"shiftleft(1L, CAST(pmod({key}, 64) AS INT))").alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    lines = words.groupBy(F.shiftright("_word", 6).alias("_line")).agg(F.map_from_entries(F.collect_list(F.struct(
        F.col("_word").bitwiseAND(63).cast("int"), F.col("_bits")))).alias("_set"))
    full = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda k: F.coalesce(F.try_element_at("_set", k), F.lit(0).cast("long")))
    lines = stored(lines.select("_line", full.alias("_bitmap")), "bitmap")
    here = df.withColumn("_line", F.shiftright(word, 6))
    held = F.get("_bitmap", word.bitwiseAND(63).cast("int"))
    return here.join(F.broadcast(lines), "_line").where(F.getbit(held, bit) == 1).drop("_line", "_bitmap")
