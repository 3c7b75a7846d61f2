"""Keyed upsert (``merge into ... when matched then update ... when not matched then insert``).

Plan: one full outer join of target and source on the key columns (a shuffle on the keys, sort-merge).
AQE splits no side of a full outer join; keys are unique on both sides, so none is hot. Rows whose key has a NULL part can never match;
they bypass the join (a union) so they cannot pile up in the NULL-hash partition.
Duplicate source keys either raise (default) or collapse to the latest row with a
partially-aggregated ``max(struct(order..., values...))`` - no per-key window, so one hot
key is pre-combined on the map side instead of being sorted in a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

ACTION = "_merge_action"   # keep | update | insert


class DuplicateSourceKeyError(ValueError):
    pass


def _any_null(cols) -> Column:
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return cond


def latest_per_key(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """One row per key: the row that is greatest by ``order_cols`` (then by the other columns).

    ``max(struct)`` is an ordinary aggregate, so Spark does partial (map-side) aggregation
    before the shuffle: a key holding a large share of the rows costs one row per map task.
    """
    rest = [c for c in df.columns if c not in keys]
    fields = [F.col(c).alias(f"__o{i}") for i, c in enumerate(order_cols)] + [F.col(c) for c in rest]
    agg = df.groupBy(*keys).agg(F.max(F.struct(*fields)).alias("__w"))
    return agg.select(*keys, *[F.col("__w")[c].alias(c) for c in rest]).select(*df.columns)


def check_unique(df: DataFrame, keys: list[str]) -> None:
    dup = df.filter(~_any_null(keys)).groupBy(*keys).count().filter(F.col("count") > 1)
    if not dup.isEmpty():
        sample = dup.limit(3).collect()
        raise DuplicateSourceKeyError(f"source has repeated keys {keys}: e.g. {[r.asDict() for r in sample]}")


def merge_frame(target: DataFrame, source: DataFrame, keys: list[str], update_cols: list[str], *,
                update_exprs: dict[str, Column] | None = None,
                insert_exprs: dict[str, Column] | None = None,
                on_duplicate: str = "error", order_cols: list[str] | None = None,
                combine: dict | None = None) -> DataFrame:
    """Merged rows (target schema) plus ``_merge_action``.

    ``update_exprs`` / ``insert_exprs`` override the value taken from the source for the
    update / insert branch; they may use source columns by their plain names.
    ``combine[c](target_value, source_value)`` gives the updated value from both sides
    (e.g. ``lambda t, s: t + s`` merges additive sums).
    """
    combine = combine or {}
    update_exprs = update_exprs or {}
    insert_exprs = insert_exprs or {}
    if on_duplicate == "latest":
        source = latest_per_key(source, keys, order_cols or [])
    elif on_duplicate == "error":
        check_unique(source, keys)
    elif on_duplicate != "unique":   # "unique": the caller guarantees one row per key (e.g. an aggregate)
        raise ValueError("on_duplicate must be 'error', 'latest' or 'unique'")

    tcols = target.columns
    s_only = [c for c in source.columns]
    # evaluate branch expressions on the source side before the join (plain source names)
    src = source.select(
        *[F.col(c).alias(f"__s_{c}") for c in s_only],
        *[e.alias(f"__u_{c}") for c, e in update_exprs.items()],
        *[e.alias(f"__i_{c}") for c, e in insert_exprs.items()],
        F.lit(True).alias("__s_present"),
    )
    tgt = target.select(*tcols, F.lit(True).alias("__t_present"))

    null_t = tgt.filter(_any_null(keys))
    null_s = src.filter(_any_null([f"__s_{k}" for k in keys]))
    tgt_k = tgt.filter(~_any_null(keys))
    src_k = src.filter(~_any_null([f"__s_{k}" for k in keys]))

    cond = [tgt_k[k] == src_k[f"__s_{k}"] for k in keys]
    j = tgt_k.join(src_k, cond, "full_outer")
    t_in, s_in = F.col("__t_present").isNotNull(), F.col("__s_present").isNotNull()

    def upd(c):
        if c in combine:
            return combine[c](F.col(c), F.col(f"__s_{c}"))
        if c in update_exprs:
            return F.col(f"__u_{c}")
        return F.col(f"__s_{c}")

    def ins(c):
        if c in insert_exprs:
            return F.col(f"__i_{c}")
        if c in s_only:
            return F.col(f"__s_{c}")
        return F.lit(None).cast(target.schema[c].dataType)

    out = []
    for c in tcols:
        dt = target.schema[c].dataType
        if c in keys:
            e = F.coalesce(F.col(c), F.col(f"__s_{c}"))
        else:
            matched_val = upd(c) if c in update_cols else F.col(c)
            e = F.when(t_in & s_in, matched_val).when(t_in, F.col(c)).otherwise(ins(c))
        out.append(e.cast(dt).alias(c))
    action = F.when(t_in & s_in, "update").when(t_in, "keep").otherwise("insert").alias(ACTION)
    merged = j.select(*out, action)

    kept_nulls = null_t.select(*tcols, F.lit("keep").alias(ACTION))
    ins_nulls = null_s.select(*[ins(c).cast(target.schema[c].dataType).alias(c) for c in tcols],
                              F.lit("insert").alias(ACTION))
    return merged.unionByName(kept_nulls).unionByName(ins_nulls)


def upsert(target: DataFrame, source: DataFrame, keys: list[str], update_cols: list[str], **kw) -> DataFrame:
    """The merged table (target schema)."""
    return merge_frame(target, source, keys, update_cols, **kw).drop(ACTION)


def observed_upsert(target: DataFrame, source: DataFrame, keys: list[str], update_cols: list[str], **kw):
    """(merged DataFrame, Observation) - the observation yields ``updated``/``inserted`` counts once
    the DataFrame is written, without a second pass (``SQLROWCOUNT``)."""
    obs = Observation("merge")
    m = merge_frame(target, source, keys, update_cols, **kw)
    m = m.observe(obs,
                  F.count(F.when(F.col(ACTION) == "update", 1)).alias("updated"),
                  F.count(F.when(F.col(ACTION) == "insert", 1)).alias("inserted"))
    return m.drop(ACTION), obs


def load_with_status(write, target: DataFrame, source: DataFrame, keys, update_cols, **kw) -> str:
    """Stored-procedure style load: run the upsert and its write, return a status line.

    ``write`` receives the merged DataFrame (e.g. ``SnapshotTable.publish``).
    """
    try:
        merged, obs = observed_upsert(target, source, keys, update_cols, **kw)
        write(merged)
        m = obs.get
        return f"Load Complete. {int(m['updated']) + int(m['inserted'])} rows affected"
    except Exception as e:  # noqa: BLE001 - the procedure reports any failure as text
        return f"Load failed with error message: {e}"
