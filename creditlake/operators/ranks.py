"""Exact order statistics and the rank operators built on them, without a global sort.

`percentile`, `median` and an unpartitioned window all end in one task that holds every distinct
value. Here an approximate sketch brackets each wanted rank, one scan counts the rows below the
bracket, and only the values inside it (a fraction of a percent of the rows) are looked at exactly.
NTILE and the train/test split then become plain comparisons with a few literal split points.

These functions run a few aggregate jobs when called, like `DataFrame.approxQuantile` does; feed
them a table scan or a `settings.stage`d result, not a long plan.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCURACY = 10_000
#: Sketches are merged in so many tasks, and the merged ones combined on the driver.
GROUPS = 64
GRID = 1_000
MAX_VALUES_ON_DRIVER = 100_000


def order_statistics(
    df: DataFrame,
    columns: Mapping[str, Column],
    ranks: Mapping[str, Callable[[int], Sequence[int]]],
    values_limit: int = MAX_VALUES_ON_DRIVER,
) -> dict[str, tuple[int, dict[int, object]]]:
    """Per column: its count of non-null values n, and the value at each 0-based rank of `ranks(n)`.

    Columns must be numeric; NaN counts as null. All columns share the scans, two of them up to
    some ten million rows.
    """
    names = {k: f"c{i}" for i, k in enumerate(columns)}
    df = df.select([c.alias(names[k]) for k, c in columns.items()])
    types = {k: dict(df.dtypes)[n] for k, n in names.items()}
    columns = {
        k: F.nanvl(F.col(n).cast("double"), F.lit(None)) if types[k] in ("double", "float") else F.col(n)
        for k, n in names.items()
    }
    to_python = {k: _python_type(types[k]) for k in columns}
    # One text literal: building the array element by element costs a driver call each.
    grid = "array(" + ", ".join(f"{i / GRID}D" for i in range(GRID + 1)) + ")"
    parts = (
        df.select([c.alias(names[k]) for k, c in columns.items()])
        .groupBy(F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("part"))
        .agg(
            *[F.count(names[k]).alias(f"n_{k}") for k in columns],
            *[F.expr(f"percentile_approx({names[k]}, {grid}, {ACCURACY})").alias(f"g_{k}") for k in columns],
        )
        .collect()
    )
    sketches = {k: [(p[f"n_{k}"], p[f"g_{k}"]) for p in parts if p[f"n_{k}"]] for k in columns}
    counts = {k: sum(n for n, _ in sketches[k]) for k in columns}
    found: dict[str, dict[int, object]] = {k: {} for k in columns}
    spans: dict[tuple, list[int]] = {}
    wanted = {k: sorted({r for r in ranks[k](n) if 0 <= r < n}) for k, n in counts.items()}
    # The limit holds for all brackets together.
    each = values_limit / max(1, sum(map(len, wanted.values())))
    for k, n in counts.items():
        bracket = _Brackets(sketches[k]) if n else None
        for r in wanted[k]:
            lo, hi, width = bracket.around(r)
            if lo == hi:
                found[k][r] = lo
            else:
                spans.setdefault((k, lo, hi, width * n <= each or width >= 1), []).append(r)
    _look_up(df, columns, to_python, {s: rs for s, rs in spans.items() if s[3]}, found)
    _narrow(df, columns, {s: rs for s, rs in spans.items() if not s[3]}, found, values_limit)
    return {k: (counts[k], found[k]) for k in columns}


def _python_type(spark_type: str) -> Callable:
    if spark_type in ("double", "float"):
        return float
    return Decimal if spark_type.startswith("decimal") else int


class _Brackets:
    """Values that surely enclose a rank, from the quantiles of several parts of the rows.

    A part's sketch is off by at most a part in ACCURACY of its rows; its ends are exact. The bounds of the parts add up.
    """

    def __init__(self, parts: list[tuple[int, Sequence]]):
        self.parts = parts
        self.n = sum(n for n, _ in parts)
        self.values = sorted({v for _, grid in parts for v in grid})

    def _rows(self, v, or_equal: bool) -> tuple[float, float]:
        """The least and the most rows that can be below `v`, or equal to it."""
        least = most = 0.0
        for n, grid in self.parts:
            i = bisect_right(grid, v) if or_equal else bisect_left(grid, v)
            slack = n / ACCURACY + 1
            if i == len(grid):
                least, most = least + (n if or_equal else max(0.0, n - slack)), most + n
            elif i:
                least += max(0.0, (i - 1) * n / GRID - slack)
                most += min(n, i * n / GRID + slack)
        return least, most

    def around(self, rank: int) -> tuple:
        """The two ends, and the share of the rows strictly between them at most."""
        values = self.values
        # The last value with no more than `rank` rows below it, and the first with more than `rank` up to it.
        at = bisect_right(values, rank, key=lambda v: self._rows(v, False)[1]) - 1
        to = bisect_left(values, rank + 1, key=lambda v: self._rows(v, True)[0])
        lo, hi = values[max(at, 0)], values[min(to, len(values) - 1)]
        width = max(0.0, self._rows(hi, False)[1] - self._rows(lo, True)[0]) / self.n
        # Also a single value may be one that the sketch has rounded.
        return _outwards(lo, -1), _outwards(hi, 1), 0.0 if lo == hi else width


def _outwards(value, direction: int):
    """The sketch works in double: step over what that may have rounded off a longer number."""
    if isinstance(value, int) and abs(value) >= 2**53:
        return max(min(value + direction * (abs(value) // 2**52 + 1), 2**63 - 1), -(2**63))
    if isinstance(value, Decimal) and len(value.as_tuple().digits) > 15:
        return value + direction * abs(value) / 2**52
    return value


def _look_up(df, columns, to_python, spans, found) -> None:
    """Count the distinct values inside each span, and the rows below it, in one scan."""
    if not spans:
        return
    spans = list(spans.items())
    tagged = F.array(
        *[
            F.struct(
                F.lit(i).alias("i"),
                (columns[k] <= hi).alias("wanted"),
                F.when(columns[k] >= lo, columns[k].cast("string")).alias("v"),
            )
            for i, ((k, lo, hi, _), _) in enumerate(spans)
        ]
    )
    rows = df.select(F.inline(tagged)).where("wanted").groupBy("i", "v").count().collect()
    for i, ((k, *_), ranks) in enumerate(spans):
        below = sum(r["count"] for r in rows if r["i"] == i and r["v"] is None)
        values = sorted((to_python[k](r["v"]), r["count"]) for r in rows if r["i"] == i and r["v"] is not None)
        _pick(values, below, ranks, found[k])


def _narrow(df, columns, spans, found, values_limit) -> None:
    """Start again strictly inside each span, where the sketch resolves a hundred times finer.

    Rows equal to the span's ends are counted here, so heavy ties cannot keep the span large.
    """
    if not spans:
        return
    spans = list(spans.items())
    sizes = df.agg(
        *[F.count_if(columns[k] < lo).alias(f"below{i}") for i, ((k, lo, *_), _) in enumerate(spans)],
        *[F.count_if(columns[k] == lo).alias(f"at{i}") for i, ((k, lo, *_), _) in enumerate(spans)],
        *[F.count_if((columns[k] > lo) & (columns[k] < hi)).alias(f"in{i}") for i, ((k, lo, hi, _), _) in enumerate(spans)],
    ).first()
    inner: dict[str, dict[int, int]] = {}
    for i, ((k, lo, hi, _), rs) in enumerate(spans):
        start = sizes[f"below{i}"] + sizes[f"at{i}"]
        for r in rs:
            if r < start:
                found[k][r] = lo
            elif r >= start + sizes[f"in{i}"]:
                found[k][r] = hi
            else:
                inner.setdefault(str(i), {})[r] = r - start
    if not inner:
        return
    deeper = order_statistics(
        df,
        {
            str(i): F.when((columns[k] > lo) & (columns[k] < hi), columns[k])
            for i, ((k, lo, hi, _), _) in enumerate(spans)
            if str(i) in inner
        },
        {i: (lambda n, wanted=wanted: list(wanted.values())) for i, wanted in inner.items()},
        values_limit,
    )
    for i, wanted in inner.items():
        k = spans[int(i)][0][0]
        for r, position in wanted.items():
            found[k][r] = deeper[i][1][position]


def _pick(values: list[tuple], below: int, ranks: Sequence[int], out: dict[int, object]) -> None:
    seen, todo = below, sorted(ranks)
    for value, count in values:
        while todo and todo[0] < seen + count:
            out[todo.pop(0)] = value
        seen += count


def exact_quantiles(
    df: DataFrame, columns: Mapping[str, Column], probabilities: Sequence[float]
) -> dict[str, list[float | None]]:
    """Interpolated quantiles (position p·(n-1)) of each column, nulls ignored; None if all null."""

    def positions(n: int) -> list[int]:
        return [f(p * (n - 1)) for p in probabilities for f in (math.floor, math.ceil)]

    result = {}
    for k, (n, at) in order_statistics(df, columns, {k: positions for k in columns}).items():
        result[k] = [None if n == 0 else _interpolate(at, p * (n - 1)) for p in probabilities]
    return result


def _interpolate(at: Mapping[int, float], position: float) -> float:
    low, high = float(at[math.floor(position)]), float(at[math.ceil(position)])
    return low + (high - low) * (position - math.floor(position))


def exact_medians(df: DataFrame, names: Sequence[str]) -> dict[str, float | None]:
    return {k: v[0] for k, v in exact_quantiles(df, {n: F.col(n) for n in names}, [0.5]).items()}


def numeric_key(df: DataFrame, key: str) -> Column:
    """`key` itself if it is a whole number, else its 64-bit hash, to order and tell apart rows."""
    return F.col(key) if dict(df.dtypes)[key] in ("tinyint", "smallint", "int", "bigint") else F.xxhash64(key)


def split_points(
    df: DataFrame, groups: Mapping[str, Column], value: Column, tie_break: Column, ranks: Mapping[str, Callable[[int], Sequence[int]]]
) -> dict[str, tuple[int, list[tuple]]]:
    """Per group (a boolean column): its size, and the (value, tie_break) pair at each wanted rank.

    `value` must not be null; `tie_break` must be numeric and tell rows with equal values apart.
    """
    first = order_statistics(df, {g: F.when(cond, value) for g, cond in groups.items()}, ranks)
    ties = {
        (g, r): groups[g] & (value == v) for g, (n, at) in first.items() for r, v in at.items()
    }
    if not ties:
        return {g: (n, []) for g, (n, _) in first.items()}
    names = {f"t{i}": key for i, key in enumerate(ties)}
    smaller = df.agg(
        *[F.count_if(groups[g] & (value < first[g][1][r])).alias(t) for t, (g, r) in names.items()]
    ).first()
    second = order_statistics(
        df,
        {t: F.when(ties[key], tie_break) for t, key in names.items()},
        {t: (lambda n, t=t, r=key[1]: [r - smaller[t]]) for t, key in names.items()},
    )
    pairs: dict[str, list[tuple]] = {g: [] for g in groups}
    for t, (g, r) in names.items():
        pairs[g].append((first[g][1][r], second[t][1][r - smaller[t]]))
    return {g: (first[g][0], pairs[g]) for g in groups}


def at_or_after(value: Column, tie_break: Column, point: tuple) -> Column:
    return (value > point[0]) | ((value == point[0]) & (tie_break >= point[1]))


def with_ntile(df: DataFrame, k: int, value: str, tie_break: Column, name: str = "ntile") -> DataFrame:
    """NTILE(k) over (value, tie_break): the first n mod k buckets take one row more."""

    def bucket_starts(n: int) -> list[int]:
        size, extra = divmod(n, k)
        return [b * size + min(b, extra) for b in range(1, k)]

    v = F.col(value)
    _, points = split_points(df, {"all": F.lit(True)}, v, tie_break, {"all": bucket_starts})["all"]
    bucket = F.lit(1)
    for point in points:
        bucket = bucket + at_or_after(v, tie_break, point).cast("int")
    return df.withColumn(name, bucket)


def stratified_split(
    df: DataFrame, label: str, hash_value: Column, tie_break: Column, test_share: float = 0.2, name: str = "split", most_labels: int = 100
) -> DataFrame:
    """Adds `split`: inside each label the first round(test_share·n) rows by hash are 'test'.

    The labels are on the driver; more than `most_labels` are an error.
    """
    labels = [r[0] for r in df.groupBy(label).count().limit(most_labels + 1).collect()]
    if len(labels) > most_labels:
        raise ValueError(f"{label} has more than {most_labels} values and cannot be a stratum")
    groups = {str(i): F.col(label).eqNullSafe(F.lit(x)) for i, x in enumerate(labels)}

    def first_train(n: int) -> list[int]:
        return [int(test_share * n + 0.5)]

    points = split_points(df, groups, hash_value, tie_break, {g: first_train for g in groups})
    is_train = F.lit(False)
    for g, cond in groups.items():
        for point in points[g][1]:
            is_train = is_train | (cond & at_or_after(hash_value, tie_break, point))
    return df.withColumn(name, F.when(is_train, "train").otherwise("test"))
