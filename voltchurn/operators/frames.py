"""Row-selection, fill and guard operators.

Design notes for scale:

- "first / latest row per key" is an aggregate (``min_by``/``max_by`` over a
  struct), not a ``row_number`` window: the aggregate combines map-side, so a
  key holding a third of all rows is reduced inside every map task before the
  shuffle instead of being sorted in one task.
- rows with texts are chosen by their ids (``pick_by_id``) and fetched by id, so
  that no aggregate carries the text.
- grain guards are lazy: they ride along the aggregation the join needs
  anyway and raise from inside the job (``raise_error``), instead of running
  an extra counting job on the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltchurn.constants import KEY


def _order_struct(order: Sequence[str | Column], nulls_last: bool) -> Column:
    parts = []
    for i, o in enumerate(order):
        c = F.col(o) if isinstance(o, str) else o
        if nulls_last:
            parts.append(c.isNotNull().alias(f"_nn{i}"))
        parts.append(c.alias(f"_o{i}"))
    return F.struct(*parts)


def pick_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                 latest: bool = False, nulls_last: bool = True) -> DataFrame:
    """One row per key: the smallest (``latest=False``) or largest row by ``order``.

    Ties on ``order`` are broken by the remaining columns, so the choice is
    deterministic whatever the file or partition order.  NULL order values
    rank last in both directions when ``nulls_last``.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    tiebreak = [c for c in rest if c not in [o for o in order if isinstance(o, str)]]
    ordering = list(order) + tiebreak
    if latest:
        ostruct = _order_struct(ordering, nulls_last)
        pick = F.max_by(F.struct(*[F.col(c) for c in rest]), ostruct)
    else:
        # min over (is_null, value) puts NULLs last
        parts = []
        for i, o in enumerate(ordering):
            c = F.col(o) if isinstance(o, str) else o
            if nulls_last:
                parts.append(c.isNull().alias(f"_n{i}"))
            parts.append(c.alias(f"_o{i}"))
        pick = F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(*parts))
    out = df.groupBy(*keys).agg(pick.alias("_row"))
    return out.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def pick_by_id(df: DataFrame, keys: Sequence[str], order: Sequence[str], row_id: str,
               latest: bool = False, nulls_last: bool = True) -> DataFrame:
    """``pick_per_key`` for wide rows: choose by ``order`` and row id, then fetch the rows by id.

    Only keys, order columns and ``row_id`` pass the aggregate; texts and other
    wide columns are read again and only the chosen rows of them leave the join.
    Ties on ``order`` go to the smaller id (the larger one with ``latest``).
    ``row_id`` must name one row: where a chosen id names several, the job fails.
    A NULL id is an id like any other.
    """
    keys = list(keys)
    slim = df.select(*dict.fromkeys([*keys, *order, row_id]))
    chosen = pick_per_key(slim, keys, [*order, row_id], latest, nulls_last).select(F.col(row_id).alias("_chosen"))
    rows = df.join(chosen, F.col(row_id).eqNullSafe(F.col("_chosen"))).drop("_chosen")
    copies = F.count(F.lit(1)).over(Window.partitionBy(row_id))
    msg = F.lit(f"{row_id} names more than one row")
    return rows.withColumn("_copies", copies).filter(
        F.when(F.col("_copies") > 1, F.raise_error(msg)).otherwise(F.lit(True))).select(*df.columns)


def first_per_key(df: DataFrame, key: str = KEY, order: Sequence[str | Column] | None = None,
                  row_id: str | None = None) -> DataFrame:
    """``drop_duplicates(key, keep="first")`` with an explicit order (by id where rows are wide)."""
    return pick_by_id(df, [key], order or [], row_id) if row_id else pick_per_key(df, [key], order or [], latest=False)


def latest_per_key(df: DataFrame, order: Sequence[str | Column], key: str = KEY, row_id: str | None = None) -> DataFrame:
    """The newest row per key by ``order`` (NULL dates rank last; by id where rows are wide)."""
    return pick_by_id(df, [key], order, row_id, latest=True) if row_id else pick_per_key(df, [key], order, latest=True)


def overlap_report(left: DataFrame, right: DataFrame, key: str = KEY) -> DataFrame:
    """Per column that both tables have (beside the key): rows that meet, and on how many the values differ.

    NULL equals NULL.  Tables without a common column give no rows.
    """
    both = [c for c in left.columns if c in right.columns and c != key]
    schema = "column string, rows long, differing long"
    if not both:
        return left.sparkSession.createDataFrame([], schema)
    other = right.select(key, *[F.col(c).alias(f"_r_{c}") for c in both])
    met = left.select(key, *both).join(other, key)
    one = met.agg(F.count(F.lit(1)).alias("_rows"), *[
        F.count_if(~F.col(c).eqNullSafe(F.col(f"_r_{c}"))).alias(f"_d_{c}") for c in both])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col("_rows").alias("rows"),
                                                   F.col(f"_d_{c}").alias("differing")) for c in both])).alias("x")).select("x.*")


def join_new_columns(left: DataFrame, right: DataFrame, key: str = KEY, how: str = "left") -> DataFrame:
    """Join only the columns of ``right`` that ``left`` has not, so that no column comes out twice."""
    return left.join(right.select(key, *[c for c in right.columns if c not in left.columns]), key, how)


def ffill_bfill(col: str, partition: Sequence[str], order: Sequence[str]) -> Column:
    """Forward fill, then backward fill, within each partition.

    A row without a value before it takes the partition's first value, which is
    then the next one; a frame that ends at the partition's end would be
    evaluated anew at every row.
    """
    w = Window.partitionBy(*partition).orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return F.coalesce(F.last(col, ignorenulls=True).over(before),
                      F.first(col, ignorenulls=True).over(whole))


def guard_unique(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """One row per key, or the job fails with a clear message.

    Implemented as an aggregate keyed like the join that follows, so the
    exchange it adds is the one that join reuses; the check is a filter, which
    the optimizer never prunes away.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"),
                                *[F.any_value(c).alias(c) for c in rest])
    msg = F.lit(f"{name} has duplicate keys {keys}")
    ok = F.when(F.col("_n") > 1, F.raise_error(msg)).otherwise(F.lit(True))
    return agg.filter(ok).drop("_n")


def assert_unique(df: DataFrame, keys: Sequence[str], name: str = "table") -> None:
    """Eager J14: raise ``ValueError`` now if any key repeats (one aggregation job)."""
    dup = df.groupBy(*keys).count().filter("count > 1")
    if not dup.isEmpty():
        raise ValueError(f"{name} has duplicate {list(keys)} values")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """U4: keys that repeat, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def plan_size_bytes(df: DataFrame) -> int:
    """Optimizer's size estimate of ``df`` (no job is run)."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # pragma: no cover - defensive: unknown size is "large"
        return 1 << 62


def broadcast_if_small(df: DataFrame, max_bytes: int = 64 << 20) -> DataFrame:
    """Broadcast-hint ``df`` only when its estimated size is within ``max_bytes``.

    Otherwise the join stays a shuffle join; AQE may still switch it to a
    broadcast at run time from measured sizes.
    """
    return F.broadcast(df) if plan_size_bytes(df) <= max_bytes else df


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written as Parquet under the shared ``spark.checkpoint.dir`` and read back.

    The lineage cut for wide or large tables that are read several times: unlike a
    checkpoint's rows, each reader decodes only the columns it uses.
    """
    from voltchurn.session import scratch_path

    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared ``spark.checkpoint.dir`` (survives executor loss)."""
    from voltchurn.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
