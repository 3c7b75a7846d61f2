"""Change capture between two snapshots of a keyed table, and the new-data gate.

``snapshot_diff`` is the change stream of an updated table: for each key it emits an
``INSERT`` image for new rows, a ``DELETE`` image for removed rows, and a DELETE+INSERT pair
(``_is_update``) for changed rows. One full outer join on the keys; values are compared
null-safely (variant columns through their JSON text, since variants have no equality).
Rows with a NULL key part cannot be matched by key; they are diffed as whole rows with
``exceptAll`` (a multiset difference), so they do not gather in one join partition.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import newest_marker, path_exists, write_marker

ACTION = "_action"
IS_UPDATE = "_is_update"


def _cmp_value(df: DataFrame, c: str, prefix: str = "") -> Column:
    col = F.col(prefix + c)
    if isinstance(df.schema[c].dataType, T.VariantType):
        return F.to_json(col)
    return col


def _any_null(cols) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols], F.lit(False))


def snapshot_diff(prev: DataFrame, curr: DataFrame, keys: list[str],
                  compare_cols: list[str] | None = None) -> DataFrame:
    """Change rows: all columns of ``curr`` plus ``_action`` and ``_is_update``. Keys must be unique in
    each snapshot."""
    _require_unique(prev, keys, "previous")
    _require_unique(curr, keys, "current")
    cols = curr.columns
    others = compare_cols or [c for c in cols if c not in keys]
    p = prev.select(*[F.col(c).alias(f"__p_{c}") for c in cols], F.lit(True).alias("__p_in"))
    c_ = curr.select(*cols, F.lit(True).alias("__c_in"))
    pk = p.filter(~_any_null([f"__p_{k}" for k in keys]))
    ck = c_.filter(~_any_null(keys))
    j = pk.join(ck, [pk[f"__p_{k}"] == ck[k] for k in keys], "full_outer")
    p_in, c_in = F.col("__p_in").isNotNull(), F.col("__c_in").isNotNull()
    same = reduce(lambda a, b: a & b,
                  [_cmp_value(curr, c, "__p_").eqNullSafe(_cmp_value(curr, c)) for c in others], F.lit(True))
    changed = p_in & c_in & ~same
    del_img = F.struct(*[F.col(f"__p_{c}").alias(c) for c in cols],
                       F.lit("DELETE").alias(ACTION), changed.alias(IS_UPDATE))
    ins_img = F.struct(*[F.col(c).alias(c) for c in cols],
                       F.lit("INSERT").alias(ACTION), changed.alias(IS_UPDATE))
    imgs = F.array(F.when(p_in & (~c_in | changed), del_img), F.when(c_in & (~p_in | changed), ins_img))
    keyed = j.select(F.inline(F.filter(imgs, lambda x: x.isNotNull())))

    # NULL-key rows: whole-row multiset difference; variants are compared through their JSON text
    variants = _variants(curr)
    back = _from_text(cols, variants)
    pn, cn = (_as_text(df.filter(_any_null(keys)), cols, variants) for df in (prev, curr))
    nd = pn.exceptAll(cn).select(*back, F.lit("DELETE").alias(ACTION), F.lit(False).alias(IS_UPDATE))
    ni = cn.exceptAll(pn).select(*back, F.lit("INSERT").alias(ACTION), F.lit(False).alias(IS_UPDATE))
    return keyed.unionByName(nd).unionByName(ni)


def _require_unique(df: DataFrame, keys: list[str], side: str) -> None:
    """Fails when a key without NULL parts occurs twice (counts are combined map-side)."""
    twice = df.filter(~_any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").first()
    if twice is not None:
        raise ValueError(f"snapshot_diff: key {tuple(twice)[:-1]} occurs {twice['n']} times in the {side} snapshot")


def insert_images(changes: DataFrame) -> DataFrame:
    """``select ... from stream where metadata$action = 'INSERT'`` - the new row versions."""
    return changes.filter(F.col(ACTION) == "INSERT").drop(ACTION, IS_UPDATE)


def _variants(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields if isinstance(f.dataType, T.VariantType)}


def _as_text(df: DataFrame, cols: list[str], variants: set[str]) -> DataFrame:
    """Variants as JSON text, so that whole rows can be compared and counted."""
    return df.select(*[F.to_json(c).alias(c) if c in variants else F.col(c) for c in cols])


def _from_text(cols: list[str], variants: set[str]) -> list[Column]:
    return [F.parse_json(c).alias(c) if c in variants else F.col(c) for c in cols]


def apply_changes(prev: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Inverse of ``snapshot_diff``: prev minus DELETE images plus INSERT images (variants by their JSON text)."""
    cols, variants = prev.columns, _variants(prev)
    dels = _as_text(changes.filter(F.col(ACTION) == "DELETE"), cols, variants)
    ins = changes.filter(F.col(ACTION) == "INSERT").select(*cols)
    return _as_text(prev, cols, variants).exceptAll(dels).select(*_from_text(cols, variants)).unionByName(ins)


def fold_changes(images: DataFrame, keys: list[str], version: str) -> DataFrame:
    """The net change of several versions: per key the first row before and the last row after. ``images``
    are change rows with the number of their version; a key changes at most once a version. A key whose row is
    in the end what it was has no net change. Rows with a NULL key part are netted as whole rows by count."""
    cols = [c for c in images.columns if c not in (ACTION, IS_UPDATE, version)]
    variants, others = _variants(images), [c for c in cols if c not in keys]
    keyed = images.filter(~_any_null(keys))
    row = F.struct(*others)
    before, after = F.col(ACTION) == "DELETE", F.col(ACTION) == "INSERT"
    # the first image tells whether the key was there before: a DELETE then comes in the first version
    first = F.min(F.struct(F.col(version), after.alias("new")))
    last = F.max(F.struct(F.col(version), after.alias("there")))
    net = keyed.groupBy(*keys).agg(F.min_by(F.when(before, row), F.when(before, F.col(version))).alias("old"),
                                   F.max_by(F.when(after, row), F.when(after, F.col(version))).alias("new"),
                                   first.alias("first"), last.alias("last"))
    had, has = ~F.col("first.new"), F.col("last.there")
    text = lambda side: F.struct(*[F.to_json(F.col(side)[c]).alias(c) if c in variants else F.col(side)[c].alias(c) for c in others])
    differs = ~text("old").eqNullSafe(text("new")) if others else F.lit(False)
    image = lambda side, action: F.struct(*[F.col(c) if c in keys else F.col(side)[c].alias(c) for c in cols],
                                          F.lit(action).alias(ACTION), (had & has).alias(IS_UPDATE))
    both = F.array(F.when(had & (~has | differs), image("old", "DELETE")), F.when(has & (~had | differs), image("new", "INSERT")))
    folded = net.select(F.inline(F.filter(both, lambda x: x.isNotNull())))
    loose = _as_text(images.filter(_any_null(keys)), [*cols, ACTION], variants)
    counted = loose.groupBy(*cols).agg(F.sum(F.when(F.col(ACTION) == "INSERT", 1).otherwise(-1)).alias("__n")).where("__n <> 0")
    netted = counted.select(*_from_text(cols, variants), F.explode(F.sequence(F.lit(1), F.abs("__n"))).alias("__i"), F.when(F.col("__n") > 0, "INSERT").otherwise("DELETE").alias(ACTION))
    return folded.unionByName(netted.drop("__i").withColumn(IS_UPDATE, F.lit(False)))


class ChangeFeed:
    """Change stream on an updated table: the change rows of a keyed ``SnapshotTable`` since the consumer's
    stored offset, a table version. The offset moves when a batch of changes is applied; the version it
    will move to is noted before, so a batch that failed half-way is offered again with the same end (the
    consumer keys its output by that version), even if the table went on meanwhile."""

    def __init__(self, table, offset_path: str, keys: list[str]):
        self.table, self.path, self.keys = table, offset_path.rstrip("/"), keys

    def pending(self) -> tuple[int, int] | None:
        """Versions (after, up to) that wait for this consumer; None: nothing new (the gate)."""
        spark = self.table.spark
        done, begun = (newest_marker(spark, f"{self.path}/{step}") for step in ("done", "begun"))
        end = begun if begun > done else self.table.refresh().current_version()
        return (done, end) if end > done else None

    def changes(self, after: int, upto: int) -> DataFrame:
        if hasattr(self.table, "changes"):          # written with the versions: read in proportion to the change
            return self.table.changes(after, upto, self.keys)
        curr = self.table.read(upto)
        return snapshot_diff(self.table.read(after) if after else curr.limit(0), curr, self.keys)

    def consume(self, apply: Callable[[DataFrame, int], object]):
        """``apply(changes, version)`` for what is pending; its result, or None when nothing is."""
        span = self.pending()
        if span is None:
            return None
        self._note("begun", span[1])
        result = apply(self.changes(*span), span[1])
        self._note("done", span[1])
        return result

    def _note(self, step: str, version: int) -> None:
        marker = f"{self.path}/{step}/{version}"
        if not path_exists(self.table.spark, marker):
            write_marker(self.table.spark, marker)


def has_changes(df: DataFrame) -> bool:
    """``system$stream_has_data``: true when the change relation is not empty (stops at the first row)."""
    return not df.isEmpty()
