"""Table maintenance as DataFrame plans: delete propagation, key changes, id assignment.

The reference declares ``ON DELETE CASCADE | RESTRICT`` and ``ON UPDATE
CASCADE`` on its foreign keys and ``AUTO_INCREMENT`` ids; a database applies
them row by row inside a statement.  Here each is a set operation over whole
tables: semi/anti joins along the foreign-key graph, a left join to a key map,
and a distributed sequential numbering.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.session import materialise


@dataclass(frozen=True)
class ForeignKey:
    child: str
    cols: tuple[str, ...]
    parent: str
    parent_cols: tuple[str, ...]
    on_delete: str = "RESTRICT"  # CASCADE or RESTRICT
    on_update: str = "CASCADE"


def _cascade_order(tables: Sequence[str], fks: Sequence[ForeignKey]) -> list[str]:
    """Tables ordered so every CASCADE parent comes before its children (the CASCADE graph is acyclic)."""
    deps = {t: set() for t in tables}
    for fk in fks:
        if fk.on_delete == "CASCADE" and fk.child in deps and fk.parent in deps and fk.child != fk.parent:
            deps[fk.child].add(fk.parent)
    order, done = [], set()
    while len(order) < len(deps):
        ready = [t for t in deps if t not in done and deps[t] <= done]
        if not ready:
            raise ValueError("ON DELETE CASCADE edges form a cycle")
        for t in sorted(ready):
            order.append(t)
            done.add(t)
    return order


def _referencing(child: DataFrame, cols: Sequence[str], parent_rows: DataFrame, pcols: Sequence[str], how: str) -> DataFrame:
    keys = parent_rows.select(*[F.col(p).alias(f"__pk{i}") for i, p in enumerate(pcols)]).distinct()
    cond = [child[c] == keys[f"__pk{i}"] for i, c in enumerate(cols)]
    return child.join(keys, cond, how)


def _referencing_any(child: DataFrame, refs: Sequence[tuple[Sequence[str], DataFrame, Sequence[str]]]) -> DataFrame:
    """Rows of ``child`` that reference one of several row sets; each row once, whatever the number of hits."""
    flagged, hit = child, F.lit(False)
    for i, (cols, parent_rows, pcols) in enumerate(refs):
        pk = parent_rows.select(*[F.col(p).alias(f"__c{i}_{j}") for j, p in enumerate(pcols)]).distinct()
        pk = pk.withColumn(f"__hit{i}", F.lit(True))
        flagged = flagged.join(pk, [flagged[c] == pk[f"__c{i}_{j}"] for j, c in enumerate(cols)], "left")
        hit = hit | F.coalesce(F.col(f"__hit{i}"), F.lit(False))
    return flagged.filter(hit).select(*child.columns)


def _minus(df: DataFrame, gone: DataFrame, kcols: Sequence[str]) -> DataFrame:
    """Rows of ``df`` that aren't in ``gone``, by key, or by whole rows (NULL equals NULL) without one."""
    if kcols:
        return df.join(gone.select(*kcols).distinct(), list(kcols), "left_anti")
    other = gone.select(*[F.col(c).alias(f"__g{i}") for i, c in enumerate(df.columns)]).distinct()
    return df.join(other, [df[c].eqNullSafe(other[f"__g{i}"]) for i, c in enumerate(df.columns)], "left_anti")


@dataclass
class DeleteResult:
    removed: dict[str, DataFrame]
    blocked: dict[str, DataFrame]
    survivors: dict[str, DataFrame]
    tables: list[str] = field(default_factory=list)

    def summary(self) -> DataFrame:
        """One row per table: ``table_name, removed_rows, blocking_rows``."""
        parts = []
        for t in self.tables:
            # one aggregate over both row sets, tagged: no join and no extra job per count
            tagged = self.removed[t].select(F.lit(1).alias("__r"), F.lit(0).alias("__b")).unionByName(
                self.blocked[t].select(F.lit(0).alias("__r"), F.lit(1).alias("__b")))
            parts.append(tagged.agg(
                F.lit(t).alias("table_name"),
                F.coalesce(F.sum("__r"), F.lit(0)).cast("long").alias("removed_rows"),
                F.coalesce(F.sum("__b"), F.lit(0)).cast("long").alias("blocking_rows"),
            ))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def is_blocked(self) -> bool:
        return any(not df.isEmpty() for df in self.blocked.values())


def propagate_delete(
    tables: Mapping[str, DataFrame],
    fks: Sequence[ForeignKey],
    deletes: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]] | None = None,
) -> DeleteResult:
    """Rows removed by deleting ``deletes`` (rows of some tables), following CASCADE keys.

    * ``removed[t]``: rows of ``t`` deleted directly or by a cascade, found in
      parent-before-child order with one semi join per CASCADE key (several
      cascade paths into one table are OR-ed with left joins to distinct parent
      keys, so rows are never duplicated or merged).  The cascade is a wave of
      deltas: each table's removed keys are written once, with the columns that other keys refer
      to, and all later levels and the results start from them, so that a
      table is read once for the wave and once for a result;
    * ``blocked[t]``: rows of ``t`` that reference a removed row through a
      RESTRICT key and are not removed themselves.  Any such row makes the
      whole delete fail in the reference, even when it sits below a cascade;
    * ``survivors[t]``: the table after the delete (meaningful when nothing is blocked).

    ``deletes[t]`` may hold whole rows or only the key columns of ``t``.
    ``keys`` (table -> key columns) is used to pick seed rows by key, to count a
    row reached twice once, and to subtract removed rows; without it, rows are
    compared whole.  A row that references removed rows through several
    RESTRICT keys blocks once.  A CASCADE key of a table to itself is not followed.
    """
    names = list(tables)
    removed: dict[str, DataFrame] = {}
    delta: dict[str, DataFrame] = {}  # the keys of removed rows, or whole rows of a table without keys
    for t in _cascade_order(names, fks):
        df = tables[t]
        incoming = [fk for fk in fks if fk.child == t and fk.on_delete == "CASCADE" and fk.parent in delta]
        kcols = list((keys or {}).get(t, ()))
        parts = []
        if t in deletes:
            seed = deletes[t]
            if kcols and set(kcols) <= set(seed.columns):
                parts.append(df.join(seed.select(*kcols).distinct(), kcols, "left_semi"))  # keys are enough
            else:
                parts.append(seed.select(*df.columns))
        if len(incoming) == 1:
            fk = incoming[0]
            parts.append(_referencing(df, fk.cols, delta[fk.parent], fk.parent_cols, "left_semi"))
        elif incoming:
            parts.append(_referencing_any(df, [(fk.cols, delta[fk.parent], fk.parent_cols) for fk in incoming]))
        if not parts:
            removed[t] = delta[t] = df.limit(0)
            continue
        if kcols:
            wanted = list(dict.fromkeys([*kcols, *(c for fk in fks if fk.parent == t for c in fk.parent_cols)]))
            parts = [p.select(*wanted) for p in parts]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        if len(parts) > 1:  # a row deleted directly may also be reached by a cascade
            out = out.dropDuplicates(kcols) if kcols else out.distinct()
        delta[t] = materialise(out)
        removed[t] = df.join(delta[t].select(*kcols).distinct(), kcols, "left_semi") if kcols else delta[t]
    blocked: dict[str, DataFrame] = {}
    for t in names:
        held = [fk for fk in fks if fk.child == t and fk.on_delete == "RESTRICT" and fk.parent in delta]
        refs = _referencing_any(tables[t], [(fk.cols, delta[fk.parent], fk.parent_cols) for fk in held]) if held else tables[t].limit(0)
        blocked[t] = _minus(refs, delta[t], list((keys or {}).get(t, ()))) if held else refs
    survivors = {t: _minus(tables[t], delta[t], list((keys or {}).get(t, ()))) for t in names}
    return DeleteResult(removed, blocked, survivors, names)


@dataclass
class KeyChangeResult:
    tables: dict[str, DataFrame]
    changed: dict[str, DataFrame]
    names: list[str]

    def summary(self) -> DataFrame:
        """One row per table: ``table_name, changed_rows``."""
        parts = [
            self.changed[t].agg(F.count(F.lit(1)).alias("changed_rows")).select(F.lit(t).alias("table_name"), "changed_rows")
            for t in self.names
        ]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


def key_columns_reached(fks: Sequence[ForeignKey], table: str, col: str) -> dict[str, list[str]]:
    """Columns that take a new value when ``table.col`` changes, following ON UPDATE CASCADE keys column by column."""
    reached = {(table, col)}
    grew = True
    while grew:
        grew = False
        for fk in fks:
            if fk.on_update != "CASCADE":
                continue
            for c, p in zip(fk.cols, fk.parent_cols):
                if (fk.parent, p) in reached and (fk.child, c) not in reached:
                    reached.add((fk.child, c))
                    grew = True
    out: dict[str, list[str]] = {}
    for t, c in sorted(reached):
        out.setdefault(t, []).append(c)
    return out


def propagate_key_change(
    tables: Mapping[str, DataFrame],
    fks: Sequence[ForeignKey],
    table: str,
    col: str,
    key_map: DataFrame,
) -> KeyChangeResult:
    """Apply ``key_map`` (``old_key``, ``new_key``) to ``table.col`` and every column that cascades from it.

    Each reached column gets a left join to the map (broadcast when a count
    proves the map small) and ``coalesce(new_key, old)``.  ``old_key`` must be
    unique in the map (exact duplicate rows are dropped); a key mapped to two
    new values has no meaning, as in an UPDATE.
    """
    reached = key_columns_reached(fks, table, col)
    m = key_map.select("old_key", "new_key").distinct()
    torn = m.groupBy("old_key").count().filter("count > 1").limit(3).collect()
    if torn:
        raise ValueError(f"old keys with several new keys: {[r['old_key'] for r in torn]}")
    new_tables, changed = {}, {}
    for t, df in tables.items():
        cols = reached.get(t, [])
        if not cols:
            new_tables[t], changed[t] = df, df.limit(0)
            continue
        cur = df
        hit = F.lit(False)
        for i, c in enumerate(cols):
            mi = m.select(F.col("old_key").alias(f"__old{i}"), F.col("new_key").alias(f"__new{i}"))
            cur = cur.join(mi, cur[c] == mi[f"__old{i}"], "left")
            hit = hit | F.col(f"__old{i}").isNotNull()
            cur = cur.withColumn(c, F.coalesce(F.col(f"__new{i}"), F.col(c)))
        changed[t] = cur.filter(hit).select(*df.columns)
        new_tables[t] = cur.select(*df.columns)
    return KeyChangeResult(new_tables, changed, list(tables))


def assign_ids(df: DataFrame, order_cols: Sequence[str], *, id_col: str = "id", start: int = 1) -> DataFrame:
    """Consecutive ids ``start, start+1, ...`` in ``order_cols`` order, without a single-partition window.

    The input is range-sorted, tagged with ``monotonically_increasing_id``
    (partition index in the high bits, row index in the low 33 bits) and
    written once so the tags are fixed.  Per-partition row counts (one row per
    partition) give each partition's offset.
    Ties in ``order_cols`` are numbered in an arbitrary but fixed order.
    """
    tagged = materialise(df.orderBy(*order_cols).withColumn("__wl_mid", F.monotonically_increasing_id()))
    part = F.shiftright("__wl_mid", 33)
    counts = tagged.groupBy(part.alias("__wl_part")).agg(F.count(F.lit(1)).alias("__wl_n"))
    w = Window.orderBy("__wl_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__wl_part", F.coalesce(F.sum("__wl_n").over(w), F.lit(0)).alias("__wl_off"))
    low = F.col("__wl_mid").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        tagged.join(offsets, part == F.col("__wl_part"))
        .withColumn(id_col, F.lit(start) + F.col("__wl_off") + low)
        .drop("__wl_mid", "__wl_part", "__wl_off")
    )
