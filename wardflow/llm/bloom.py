"""A blocked Bloom filter as a small table: one row of eight 64-bit words per block.

A key sets one bit in each word of one block, so a probe is one lookup of a row. The table is
broadcast: it never has more than ``MAX_BLOCKS`` rows. With more keys than fit it lets more
strangers pass, never fewer members; an exact join follows in any case.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 8
MAX_BLOCKS = 1 << 16   # 4.7 MB of rows
KEYS_PER_BLOCK = 32    # 16 bits a key: about one stranger in a thousand passes


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _mask(key: Column, word: int) -> Column:
    """One bit of the word, from six bits of a second hash."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit("bits")), 6 * word).bitwiseAND(F.lit(63))
    return F.call_function("shiftleft", F.lit(1).cast("long"), bits.cast("int"))


def build(keys: DataFrame, key: str, n_keys: int) -> tuple[DataFrame, int]:
    """The filter's table and its number of blocks; ``n_keys`` only sizes it. Null keys and
    repeated ones are allowed; no keys give a filter that lets nothing pass."""
    blocks = max(1, min(MAX_BLOCKS, -(-n_keys // KEYS_PER_BLOCK)))
    words = [F.bit_or(_mask(F.col(key), w)).alias(f"_bloom_{w}") for w in range(WORDS)]
    return keys.groupBy(_block(F.col(key), blocks).alias("_bloom_block")).agg(*words), blocks


def flagged(rows: DataFrame, key: Column, built: tuple[DataFrame, int], flag: str) -> DataFrame:
    """The rows with a column ``flag``: may the key be among the filter's keys?"""
    table, blocks = built
    held = reduce(Column.__and__, [
        F.col(f"_bloom_{w}").bitwiseAND(F.col(f"_bloom_mask_{w}")) == F.col(f"_bloom_mask_{w}")
        for w in range(WORDS)])
    masks = {f"_bloom_mask_{w}": _mask(key, w) for w in range(WORDS)}
    probed = rows.withColumns({"_bloom_block": _block(key, blocks), **masks})
    return probed.join(F.broadcast(table), "_bloom_block", "left").select(
        *rows.columns, F.coalesce(held, F.lit(False)).alias(flag))


def possible(rows: DataFrame, key: Column, built: tuple[DataFrame, int]) -> DataFrame:
    """The rows whose key may be among the filter's keys, columns as they were.

    Let an inner join on the keys follow: the optimiser moves a left semi join in front of the
    filter, which then saves nothing.
    """
    return flagged(rows, key, built, "_bloom_held").where("_bloom_held").drop("_bloom_held")
