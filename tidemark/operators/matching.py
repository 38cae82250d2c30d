"""Matching of observations whose positions differ slightly, by windows over blocks of positions and without a join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: A block of positions is at least this many tolerances long.
BLOCK = 64


def at_home(rows: DataFrame, position: Column, tolerance: int, block: int | None = None) -> DataFrame:
    """rows with `_at` (their position) and `_home`, where the block of that position starts."""
    at = F.col("_at")
    return rows.withColumn("_at", position.cast("long")).withColumn("_home", at - F.pmod(at, F.lit(max(block or 0, BLOCK * tolerance))))


def in_blocks(rows: DataFrame, position: Column, tolerance: int, block: int | None = None) -> DataFrame:
    """rows at_home() with `_block`, where rows within two tolerances of a block's ends are copied into its neighbour.

    So each block sees all that decides the rows at home in it.
    """
    size, reach = max(block or 0, BLOCK * tolerance), 2 * tolerance
    at, home = F.col("_at"), F.col("_home")
    first, last = at - home < reach, home + size - at <= reach
    seen = F.when(first, F.array(home, home - size)).when(last, F.array(home, home + size)).otherwise(F.array(home))  # no row is near both ends
    return at_home(rows, position, tolerance, block).withColumn("_block", F.explode(seen))


def with_partners(rows: DataFrame, keys: Sequence[str], position: Column, tolerance: int, roles: Mapping[str, tuple[Column, Column]], payload: Column | None = None, block: int | None = None) -> DataFrame:
    """rows with a boolean for each role: has the row a partner, each of the two being the other's only candidate?

    A role is a pair of conditions that no row meets both of. Candidates of a row that meets one are the rows with equal keys
    that meet the other and lie elsewhere, at most `tolerance` away (whole numbers). Positions are cut into blocks (in_blocks()): all roles
    cost one shuffle by keys and block, and no key is one task. With `payload` rows of a role's first condition also get
    `<role>_partner`, their partner's payload. A tolerance of 0 pairs nothing.
    """
    if tolerance <= 0:
        return unpaired(rows, roles, payload)
    return partners_in_blocks(in_blocks(rows, position, tolerance, block), keys, tolerance, roles, payload)


def unpaired(rows: DataFrame, roles: Mapping[str, tuple[Column, Column]], payload: Column | None = None) -> DataFrame:
    """rows as with_partners() gives them where nothing has a partner."""
    kind = None if payload is None else rows.select(payload.alias("p")).schema[0].dataType
    return rows.withColumns({n: F.lit(False) for n in roles} | ({} if kind is None else {f"{n}_partner": F.lit(None).cast(kind) for n in roles}))


def partners_in_blocks(rows: DataFrame, keys: Sequence[str], tolerance: int, roles: Mapping[str, tuple[Column, Column]], payload: Column | None = None, unique: bool = False) -> DataFrame:
    """with_partners() of rows that in_blocks() gave; rows already dealt by keys and block aren't shuffled again.

    `unique` says that no two rows of a block share keys and position, so that no row has to be left out at a row's own position.
    """
    kept = [c for c in rows.columns if c not in ("_at", "_home", "_block")]
    marks = {f"_{side}_{n}": F.coalesce(c, F.lit(False)) for n, pair in roles.items() for side, c in zip("ab", pair, strict=True)}
    ordered = W.partitionBy(*keys, "_block").orderBy("_at")
    frames = [ordered.rangeBetween(-tolerance, tolerance)] if unique else [ordered.rangeBetween(-tolerance, -1), ordered.rangeBetween(1, tolerance)]
    over = lambda c: reduce(lambda a, b: a + b, (F.coalesce(c.over(f), F.lit(0)) for f in frames))
    x = rows.withColumns(marks)
    x = x.withColumns({f"_n{side}_{n}": over(F.count_if(F.col(f"_{other}_{n}"))) for n in roles for side, other in ("ab", "ba")})
    met = {}
    for n in roles:
        for side, other in ("ab", "ba"):
            back = over(F.sum(F.when(F.col(f"_{other}_{n}"), F.col(f"_n{other}_{n}"))))
            met[f"_m{side}_{n}"] = F.coalesce(F.col(f"_{side}_{n}") & (F.col(f"_n{side}_{n}") == 1) & (back == 1), F.lit(False))
        if payload is not None:
            own = F.when(F.col(f"_b_{n}"), payload)
            met[f"_p_{n}"] = F.coalesce(*(F.first(own, ignorenulls=True).over(f) for f in frames))
    x = x.withColumns(met).filter(F.col("_block").eqNullSafe(F.col("_home")))
    found = {n: F.col(f"_ma_{n}") | F.col(f"_mb_{n}") for n in roles}
    if payload is not None:
        found |= {f"{n}_partner": F.when(F.col(f"_ma_{n}"), F.col(f"_p_{n}")) for n in roles}
    return x.select(*(F.col(f"`{c}`") for c in kept), *(c.alias(n) for n, c in found.items()))


def mutually_unique_pairs(left: DataFrame, right: DataFrame, keys: Sequence[str], position: str, tolerance: int) -> DataFrame:
    """Pairs of rows with equal keys and 0 < |difference of position| <= tolerance where each side has one candidate only.

    Result: keys, left_position, right_position.
    """
    both = left.select(*keys, F.col(position).alias("_p"), F.lit(True).alias("_left")).unionByName(right.select(*keys, F.col(position).alias("_p"), F.lit(False).alias("_left")))
    found = with_partners(both, keys, F.col("_p"), tolerance, {"_met": (F.col("_left"), ~F.col("_left"))}, F.col("_p"))
    return found.filter("_met AND _left").select(*keys, F.col("_p").alias("left_position"), F.col("_met_partner").alias("right_position"))
