"""Equi-joins that stay balanced when one key holds a large share of the rows.

Sides that Spark's own statistics put under the broadcast limit are joined plainly: Spark
broadcasts them and nothing is shuffled. For larger sides a sketch of bounded size lists the keys
with most rows. If no key is hot, which the driver then knows, the join is the plain one, and columns
are pruned and filters pushed as in any other. Otherwise the rows of every hot key are spread
over a grid of cells. The left side cuts its hot rows into ``a`` cells and repeats them over the
right sides' cells; each right side does the reverse. Every pair of matching rows meets in exactly
one cell, so the result is the plain join's, whatever the number of cells and whatever the sketch says.

The cell of a row is a hash of columns and of the partition it came from, never a random
number or a row counter: a task that is run again after a lost executor must put every row where the
first attempt put it. The partition is in the hash so that exact copies of one row spread as well.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil, prod

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LEFT_CELL = "__cell_l"


@dataclass(frozen=True)
class SkewPolicy:
    """When and how finely hot keys are spread.

    A key is hot when its rows on all sides multiply to more than ``rows_per_cell``, and it is cut
    so that no cell yields more joined rows than that. At most ``hot_keys`` keys, the heaviest
    ones, are spread; this bounds the sketch's answer and the table of hot keys that is broadcast. A key
    beyond them has less than 1/``hot_keys`` of a side's rows and is joined as usual.
    """

    rows_per_cell: int = 1_000_000
    hot_keys: int = 1_000
    always_spread: bool = False


DEFAULT_SKEW = SkewPolicy()


def _bytes_setting(df: DataFrame, name: str) -> int:
    text = df.sparkSession.conf.get(name).strip().lower()
    units = {"k": 2**10, "m": 2**20, "g": 2**30}
    digits = text.removesuffix("b")
    if digits and digits[-1] in units:
        return int(digits[:-1]) * units[digits[-1]]
    return int(digits)


def broadcastable(df: DataFrame) -> bool:
    """Whether the optimizer's size estimate of ``df`` is within the session's broadcast limit."""
    limit = _bytes_setting(df, "spark.sql.autoBroadcastJoinThreshold")
    try:
        statistics = df._jdf.queryExecution().optimizedPlan().stats()
    except (AttributeError, PySparkException):  # a client without access to the plan
        return False
    return int(str(statistics.sizeInBytes())) <= limit


#: What the optimizer takes for the size of a source that tells none, such as rows from Python.
UNKNOWN_BYTES = 2**63 - 1


def bytes_read(df: DataFrame) -> int:
    """The size of all tables and files that ``df`` reads, by the optimizer's estimate; those that tell none count 0."""
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    except (AttributeError, PySparkException):  # a client without access to the plan
        return 0
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(size for size in sizes if size < UNKNOWN_BYTES)


#: Items that a sketch of heavy keys keeps: a key with 3.5/TRACKED of the rows is always among them.
TRACKED = 10_000

#: Rows of the heaviest keys of one column; None stands for NULL.
Heavy = dict[object, int]


def heavy_sketch(key: str, policy: SkewPolicy = DEFAULT_SKEW) -> Column:
    """An aggregate of bounded size: the heaviest values of a column with their counts."""
    return F.expr(f"approx_top_k(`{key}`, {min(policy.hot_keys, TRACKED)}, {TRACKED})")


def heavy_keys(
    frames: Mapping[str, tuple[DataFrame, Sequence[str]]], policy: SkewPolicy = DEFAULT_SKEW
) -> dict[tuple[str, str], Heavy]:
    """The heaviest keys of some columns of every named frame, by (name, column).

    One job reads these columns alone, each frame once, however many of its columns are asked for.
    """
    sketched = []
    for name, (df, keys) in frames.items():
        sketches = df.agg(*(heavy_sketch(key, policy).alias(key) for key in keys))
        entries = [F.struct(F.lit(name).alias("name"), F.lit(key).alias("key"), F.col(key).alias("heavy")) for key in keys]
        sketched.append(sketches.select(F.inline(F.array(*entries))))
    if not sketched:
        return {}
    rows = reduce(DataFrame.unionAll, sketched).collect()
    return {(row.name, row.key): {item.item: item["count"] for item in row.heavy} for row in rows}


def _cells(sides: dict[str, Heavy], policy: SkewPolicy) -> dict[object, dict[str, int]]:
    """The hot keys with the number of cells that each of the named sides cuts them into."""
    share = policy.rows_per_cell ** (1 / len(sides))
    found = {}
    for key in set().union(*sides.values()) - {None}:
        rows = {name: max(1, heavy.get(key, 1)) for name, heavy in sides.items()}
        weight = prod(rows.values())
        if weight > policy.rows_per_cell:
            # A side keeps its share of the limit, or more where the other sides are small. The rows
            # that the sides keep per cell then multiply to at most the limit.
            kept = {name: max(share, policy.rows_per_cell * n / weight) for name, n in rows.items()}
            found[key] = weight, {name: ceil(n / kept[name]) for name, n in rows.items()}
    heaviest = sorted(found.items(), key=lambda item: (-item[1][0], str(item[0])))
    return {key: cells for key, (_, cells) in heaviest[: policy.hot_keys]}


def _own_cell(cells: Column, columns: Sequence[str]) -> Column:
    mark = F.xxhash64(F.spark_partition_id(), *(f"`{name}`" for name in columns))
    return F.pmod(mark, F.coalesce(cells, F.lit(1))).cast("int")


def _place(
    side: DataFrame,
    hot: DataFrame,
    key: str,
    own: str,
    others: list[str],
    keep: list[str],
    null_cells: int,
    cells_by: Sequence[str],
) -> DataFrame:
    """Give the rows of one side their own cell and repeat them over the other sides' cells."""
    columns = side.columns
    tagged = side.join(F.broadcast(hot), key, "left")
    cells = F.when(F.col(key).isNull(), F.lit(null_cells)).otherwise(F.col(own))
    tagged = tagged.withColumn(f"{own}_at", _own_cell(cells, cells_by))
    for other in others:
        every = F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)
        tagged = tagged.withColumn(f"{other}_at", F.explode(every))
    return tagged.select(
        *columns, *keep, f"{own}_at", *(f"{other}_at" for other in others)
    )


def spread_join(
    left: DataFrame,
    rights: DataFrame | list[DataFrame],
    key: str,
    how: str = "inner",
    *,
    policy: SkewPolicy = DEFAULT_SKEW,
    left_keys: DataFrame | None = None,
    left_heavy: Heavy | None = None,
    right_heavy: Sequence[Heavy] | None = None,
    left_cells_by: Sequence[str] | None = None,
    left_unique: bool = False,
) -> DataFrame:
    """Join ``left`` with one or more sides on the column ``key`` (USING semantics).

    Several right sides share one placement of the left rows, so the left side is shuffled once
    for all of them. ``left_heavy`` and ``right_heavy`` are the sides' heaviest keys where they are known,
    and ``left_unique`` tells that ``left`` has one row per key; what isn't known is sketched, by a job that
    reads the key alone, of ``left_keys`` in place of ``left`` if that has the same keys and is cheaper.
    ``left_cells_by`` names columns that tell left rows of one key apart, in place of all columns. All
    these only steer the placement, not the result.

    ``how`` is inner, left, left_semi or left_anti. NULL keys match nothing; many of them are spread as well.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    pending = [rights] if isinstance(rights, DataFrame) else list(rights)
    existence = how in ("left_semi", "left_anti")
    if existence:
        # Only the key counts here, so no right key can be hot.
        pending = [side.select(key).distinct() for side in pending]
        right_heavy = [{}] * len(pending)
    heavy = list(right_heavy) if right_heavy is not None else [None] * len(pending)
    fits = [not policy.always_spread and broadcastable(side) for side in pending]
    large = [(side, known) for side, known, small in zip(pending, heavy, fits) if not small]
    if large:
        left_heavy = {} if left_unique and left_heavy is None else left_heavy
        left_keys = left if left_keys is None else left_keys
        left = _spread(left, left_keys, large, key, how, policy, left_heavy, left_cells_by or left.columns)
    # Last, so that what the small sides add is not shuffled.
    for side, small in zip(pending, fits):
        if small:
            left = left.join(side, key, how)
    return left


def _spread(
    left: DataFrame,
    left_keys: DataFrame,
    pending: list[tuple[DataFrame, Heavy | None]],
    key: str,
    how: str,
    policy: SkewPolicy,
    left_heavy: Heavy | None,
    left_cells_by: Sequence[str],
) -> DataFrame:
    names = [_LEFT_CELL] + [f"__cell_r{i}" for i in range(len(pending))]
    sides = dict(zip(names, [left_keys, *(side for side, _ in pending)]))
    known = dict(zip(names, [left_heavy, *(heavy for _, heavy in pending)]))
    unknown = {name: (sides[name], [key]) for name in names if known[name] is None}
    known |= {name: heavy for (name, _), heavy in heavy_keys(unknown, policy).items()}
    hot = _cells(known, policy)
    many_nulls = how in ("left", "left_anti") and known[_LEFT_CELL].get(None, 0) > policy.rows_per_cell
    if not (hot or many_nulls or policy.always_spread):
        return reduce(lambda met, side: met.join(side[0], key, how), pending, left)
    spark = left.sparkSession
    kind = left.schema[key].dataType.simpleString()
    table = spark.createDataFrame(
        [(value, *(cells[name] for name in names)) for value, cells in hot.items()],
        f"`{key}` {kind}, " + ", ".join(f"{name} int" for name in names),
    )
    # Rows without a key never meet a partner, so any number of cells is exact for them.
    null_cells = int(spark.conf.get("spark.sql.shuffle.partitions"))
    marks = [f"__match_r{i}" for i in range(len(pending))]
    result = _place(left, table, key, names[0], names[1:], names[1:], null_cells, left_cells_by)
    on = [key, *(f"{name}_at" for name in names)]
    for (side, _), name, mark in zip(pending, names[1:], marks):
        others = [other for other in names if other != name]
        placed = _place(side, table, key, name, others, [], 1, side.columns)
        if how == "left":
            placed = placed.withColumn(mark, F.lit(True))
        result = result.join(placed, on, how)
        if how == "left":
            # A right side cut into several cells does hold the key, so a left row that found
            # nothing in one cell finds its partners in another and must not survive here.
            single = F.coalesce(F.col(name), F.lit(1)) == 1
            result = result.filter(single | F.col(mark))
    helpers = [*names, *(f"{name}_at" for name in names), *marks]
    return result.drop(*helpers)


def orphans(
    left: DataFrame, right: DataFrame, key: str, policy: SkewPolicy = DEFAULT_SKEW
) -> DataFrame:
    """Rows of ``left`` without a partner in ``right``; rows without a key count as such."""
    return spread_join(left, right, key, "left_anti", policy=policy)
