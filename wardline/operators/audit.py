"""Whole-table audits for declared constraints.

A database checks a constraint per row at write time and rejects the
statement.  Spark does not enforce keys, uniqueness, CHECKs or NOT NULL on
read, so each rule becomes a DataFrame of offending rows with one common
shape::

    rule STRING, table_name STRING, key_value STRING, detail STRING

``key_value`` is the row's key columns cast to text and joined with ``|``.
Every audit is a single pass (or one join) over its table; several audits are
combined with ``unionByName``.

Tables are expected as read from files, where every column is nullable; a
DataFrame whose schema declares NOT NULL lets Catalyst fold ``IS NULL`` away.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.session import materialise

AUDIT_COLUMNS = ("rule", "table_name", "key_value", "detail")
WHOLE = ("tinyint", "smallint", "int", "bigint")


def _names(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def key_text(cols: Sequence[str | Column]) -> Column:
    """Key columns as one string: values cast to STRING, NULL shown as ``NULL``, joined by ``|``."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("NULL")) for c in cols]
    return F.concat_ws("|", *parts)


def _shape(df: DataFrame, rule: Column | str, table: str, key: Column, detail: Column) -> DataFrame:
    return df.select(
        (F.lit(rule) if isinstance(rule, str) else rule).alias("rule"),
        F.lit(table).alias("table_name"),
        key.alias("key_value"),
        detail.cast("string").alias("detail"),
    )


def empty_audit(spark) -> DataFrame:
    return spark.createDataFrame([], "rule string, table_name string, key_value string, detail string")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def audit_primary_key(df: DataFrame, table: str, cols: str | Sequence[str], rule: str = "primary_key") -> DataFrame:
    """Key values held by more than one row, and rows with a NULL key part.

    A duplicate key gives one row (``detail`` = ``rows=n``); the count is a
    partial + final aggregate, so a hot key costs one partial row per task.
    """
    cols = _names(cols)
    any_null = F.lit(False)
    for c in cols:
        any_null = any_null | F.col(c).isNull()
    dups = df.select(*cols).filter(~any_null).groupBy(*cols).count().filter(F.col("count") > 1)
    dup_rows = _shape(dups, rule, table, key_text(cols), F.concat(F.lit("rows="), F.col("count").cast("string")))
    null_rows = _shape(df.filter(any_null), rule, table, key_text(cols), F.lit("null key"))
    return dup_rows.unionByName(null_rows)


def audit_unique(df: DataFrame, table: str, cols: str | Sequence[str], rule: str | None = None, collation: str | None = None) -> DataFrame:
    """Values of ``cols`` shared by more than one row; rows with any NULL part are exempt (many NULLs are allowed).

    With ``collation`` (e.g. ``UNICODE_CI_AI_RTRIM``) text that is equal under it is one
    value, as in a case- and accent-insensitive database; the smallest spelling is shown.
    """
    cols = _names(cols)
    rule = rule or f"unique({','.join(cols)})"
    not_null = F.lit(True)
    for c in cols:
        not_null = not_null & F.col(c).isNotNull()
    rows = df.select(*cols).filter(not_null)
    if collation is None:
        dups = rows.groupBy(*cols).count()
    else:
        text = {f.name for f in rows.schema.fields if f.dataType.typeName() == "string"}
        by = [(F.collate(F.col(c), collation) if c in text else F.col(c)).alias(f"__u{i}") for i, c in enumerate(cols)]
        dups = rows.groupBy(*by).agg(F.min(F.struct(*cols)).alias("__v"), F.count(F.lit(1)).alias("count")).select("__v.*", "count")
    dups = dups.filter(F.col("count") > 1)
    return _shape(dups, rule, table, key_text(cols), F.concat(F.lit("rows="), F.col("count").cast("string")))


def _failing(df: DataFrame, table: str, key: Sequence[str], tests: Mapping[str, Column], detail: str) -> DataFrame:
    """One pass: per row, the names of the failing tests, exploded to one row per failure."""
    names = F.array(*[F.when(cond, F.lit(name)) for name, cond in tests.items()])
    hits = df.select(key_text(key).alias("__k"), F.explode(F.array_compact(names)).alias("__rule"))
    return _shape(hits, F.col("__rule"), table, F.col("__k"), F.lit(detail))


def null_tests(cols: Sequence[str]) -> dict[str, Column]:
    return {f"not_null({c})": F.col(c).isNull() for c in cols}


def check_tests(checks: Mapping[str, Column | str]) -> dict[str, Column]:
    """A condition fails where it is FALSE; NULL (unknown) passes, as in SQL."""
    conds = {name: F.expr(c) if isinstance(c, str) else c for name, c in checks.items()}
    return {name: F.coalesce(~c, F.lit(False)) for name, c in conds.items()}


def length_tests(limits: Mapping[str, int]) -> dict[str, Column]:
    return {f"length({c})<={n}": F.coalesce(F.char_length(c) > n, F.lit(False)) for c, n in limits.items()}


def decimal_tests(decimals: Mapping[str, tuple[int, int]]) -> dict[str, Column]:
    """Compared as decimals: text and decimal columns exactly, a DOUBLE by its shortest decimal form."""
    out = {}
    for c, (p, s) in decimals.items():
        exact = F.expr(f"try_cast(cast(`{c}` AS STRING) AS DECIMAL(38,18))")
        fitted = F.expr(f"try_cast(`{c}` AS DECIMAL({p},{s}))")
        lost = fitted.isNull() | F.coalesce(fitted.cast("decimal(38,18)") != exact, F.lit(True))
        out[f"decimal({c},{p},{s})"] = F.col(c).isNotNull() & lost
    return out


def audit_not_null(df: DataFrame, table: str, key: str | Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Rows with NULL in a column declared NOT NULL (one output row per column)."""
    return _failing(df, table, _names(key), null_tests(cols), "null")


def audit_check(df: DataFrame, table: str, key: str | Sequence[str], checks: Mapping[str, Column | str]) -> DataFrame:
    """Rows for which a CHECK condition is FALSE.

    ``checks`` maps a rule name to a boolean Column or SQL expression string.
    All checks of a table are evaluated in the same pass.
    """
    return _failing(df, table, _names(key), check_tests(checks), "check failed")


def audit_length(df: DataFrame, table: str, key: str | Sequence[str], limits: Mapping[str, int]) -> DataFrame:
    """Text values longer than the declared ``VARCHAR(n)``/``CHAR(n)`` limit, in characters."""
    return _failing(df, table, _names(key), length_tests(limits), "too long")


def audit_decimal(df: DataFrame, table: str, key: str | Sequence[str], decimals: Mapping[str, tuple[int, int]]) -> DataFrame:
    """Values that do not fit ``DECIMAL(p, s)``: too many integer digits or more than ``s`` fraction digits."""
    return _failing(df, table, _names(key), decimal_tests(decimals), "does not fit")


def audit_rows(
    df: DataFrame, table: str, key: str | Sequence[str], *, not_null: Sequence[str] = (),
    checks: Mapping[str, Column | str] | None = None, lengths: Mapping[str, int] | None = None,
    decimals: Mapping[str, tuple[int, int]] | None = None,
) -> DataFrame:
    """All row-level audits of a table (NOT NULL, CHECK, length, decimal) in one pass."""
    groups = [("null", null_tests(not_null)), ("check failed", check_tests(checks or {})),
              ("too long", length_tests(lengths or {})), ("does not fit", decimal_tests(decimals or {}))]
    hits = [F.when(cond, F.struct(F.lit(name).alias("rule"), F.lit(detail).alias("detail")))
            for detail, tests in groups for name, cond in tests.items()]
    if not hits:
        return empty_audit(df.sparkSession)
    found = df.select(key_text(_names(key)).alias("__k"), F.explode(F.array_compact(F.array(*hits))).alias("__h"))
    return _shape(found, F.col("__h.rule"), table, F.col("__k"), F.col("__h.detail"))


def audit_keys(df: DataFrame, table: str, primary: Sequence[str], uniques: Sequence[Sequence[str]] = ()) -> DataFrame:
    """The primary key of a table in one scan and one exchange, all other unique keys in another (GROUPING SETS).

    Same rows as ``audit_primary_key`` and ``audit_unique`` together: key values
    of several rows, rows with a NULL in the primary key, and unique values of
    several rows (a NULL part exempts a row).

    The primary key is counted by itself: most of its groups have one row, so a
    task holds about all its rows, and these should be no wider than the key.
    """
    sets = list(dict.fromkeys(tuple(s) for s in (primary, *uniques)))
    return union_all([_key_sets(df, table, some, primary, uniques) for some in (sets[:1], sets[1:]) if some])


def _key_sets(df: DataFrame, table: str, sets: Sequence[tuple], primary: Sequence[str], uniques: Sequence[Sequence[str]]) -> DataFrame:
    cols = list(dict.fromkeys(c for s in sets for c in s))
    if len(sets) == 1:
        counts = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n")).withColumn("__set", F.lit(0))
    else:
        counts = df.select(*cols).groupingSets(sets, *cols).agg(F.count(F.lit(1)).alias("__n"), F.grouping_id().alias("__set"))
    found = []
    for key in sets:
        mine = F.col("__set") == sum(1 << (len(cols) - 1 - j) for j, c in enumerate(cols) if c not in key)
        null = F.lit(False)
        for c in key:
            null = null | F.col(c).isNull()
        one = lambda rule, detail, key=key: F.struct(F.lit(rule).alias("rule"), key_text(key).alias("key"), detail.alias("detail"))
        rules = ["primary_key"] * (key == tuple(primary)) + [f"unique({','.join(key)})"] * (key in map(tuple, uniques))
        many = F.concat(F.lit("rows="), F.col("__n").cast("string"))
        found.append(F.when(mine & ~null & (F.col("__n") > 1), F.array(*(one(rule, many) for rule in rules))))
        if key == tuple(primary):  # every row with a NULL part is told
            found.append(F.when(mine & null, F.array_repeat(one("primary_key", F.lit("null key")), F.col("__n").cast("int"))))
    hits = counts.select(F.explode(F.flatten(F.array_compact(F.array(*found)))).alias("h"))
    return _shape(hits, F.col("h.rule"), table, F.col("h.key"), F.col("h.detail"))


def audit_foreign_keys(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]], fks: Sequence, only: Sequence[str] | None = None) -> DataFrame | None:
    """All foreign keys of all tables: one scan per table and one exchange of values, then one scan per child with orphans.

    ``fks`` have ``child, cols, parent, parent_cols``; those between ``tables`` (with a child in
    ``only``, if given) are checked, ``None`` if there is none.  Same rows as ``audit_foreign_key``
    for each; values are compared as the parent's types.

    A row becomes a value per key without NULLs that it has or refers to, and these are grouped:
    a value that no parent holds is missing.  So the exchange has the distinct values of each task,
    without the rows they come from, however hot one is.  The missing values are written
    (``materialise``; this runs when called) and only the children that have some are read again:
    files of true size let the planner broadcast them, where few are missing, instead of
    shuffling the children, and AQE split a hot one, where many are.
    """
    fks = [fk for fk in fks if fk.child in tables and fk.parent in tables and (not only or fk.child in only)]
    if not fks:
        return None
    targets = list(dict.fromkeys((fk.parent, tuple(fk.parent_cols)) for fk in fks))
    number = {t: i for i, t in enumerate(targets)}
    types = {p: dict(tables[p].dtypes) for p in {fk.parent for fk in fks}}
    # whole numbers are compared as long, all else as text
    slot = {(p, cols): [f"{'n' if types[p][c] in WHOLE else 's'}{i}" for i, c in enumerate(cols)] for p, cols in targets}
    slots = sorted({s for names in slot.values() for s in names})

    def value(cols: Sequence[str], target: tuple) -> list[Column]:
        """The number of the parent's key and its parts, each in its slot; NULL if a column is NULL."""
        parent, pcols = target
        kind = lambda s: "long" if s[0] == "n" else "string"
        part = {s: F.col(c).try_cast(types[parent][p]).cast(kind(s)) for s, c, p in zip(slot[target], cols, pcols, strict=True)}
        return [F.lit(number[target]).alias("target"), *[part.get(s, F.lit(None).cast(kind(s))).alias(s) for s in slots]]

    def known(cols: Sequence[str]) -> Column:
        out = F.lit(True)
        for c in cols:
            out = out & F.col(c).isNotNull()
        return out

    used = []
    for t in dict.fromkeys(x for fk in fks for x in (fk.child, fk.parent)):
        asked = dict.fromkeys((tuple(fk.cols), (fk.parent, tuple(fk.parent_cols)), False) for fk in fks if fk.child == t)
        each = [*asked, *((cols, (t, cols), True) for p, cols in targets if p == t)]
        each = [F.when(known(cols), F.struct(*value(cols, target), F.lit(held).alias("held"))) for cols, target, held in each]
        used.append(tables[t].select(F.explode(F.array(*each)).alias("r")).filter("r IS NOT NULL").select("r.*"))
    missing = materialise(union_all(used).groupBy("target", *slots).agg(F.max("held").alias("held")).filter(~F.col("held")).drop("held"))
    lacking = {r.target for r in missing.select("target").distinct().collect()}

    found = []
    for child in dict.fromkeys(fk.child for fk in fks):
        mine = [(fk, number[fk.parent, tuple(fk.parent_cols)]) for fk in fks if fk.child == child]
        mine = [(fk, n) for fk, n in mine if n in lacking]
        if not mine:
            continue
        each = [F.when(known(fk.cols), F.struct(F.lit(i).alias("fk"), *value(fk.cols, targets[n]))) for i, (fk, n) in enumerate(mine)]
        cols = list(dict.fromkeys([*_names(keys[child]), *(c for fk, _ in mine for c in fk.cols)]))
        rows = tables[child].select(*cols, F.explode(F.array(*each)).alias("__r")).filter("__r IS NOT NULL")
        gone = materialise(missing.filter(F.col("target").isin([n for _, n in mine])))
        same = rows["__r.target"] == gone["target"]
        for s in slots:  # a value that doesn't fit the parent's type is NULL, and missing
            same = same & rows[f"__r.{s}"].eqNullSafe(gone[s])
        # several keys between the same tables have one rule name when their columns agree
        of = lambda what, mine=mine: F.coalesce(*[F.when(F.col("__r.fk") == i, what(fk)) for i, (fk, _) in enumerate(mine)])
        found.append(_shape(rows.join(gone, same, "left_semi"), of(lambda fk: F.lit(f"foreign_key({','.join(fk.cols)})->{fk.parent}")), child,
                            key_text(_names(keys[child])), of(lambda fk: F.concat(F.lit("missing "), key_text(fk.cols)))))
    return union_all(found) if found else empty_audit(missing.sparkSession)


def audit_foreign_key(
    child: DataFrame,
    table: str,
    key: str | Sequence[str],
    cols: str | Sequence[str],
    parent: DataFrame,
    parent_cols: str | Sequence[str],
    rule: str | None = None,
) -> DataFrame:
    """Child rows whose foreign key has no parent row.  A key with a NULL part is not checked.

    Planned as an anti join on the key (shuffle, or broadcast when the parent
    key set is small enough for AQE); the parent side is reduced to distinct
    keys first.
    """
    cols, pcols = _names(cols), _names(parent_cols)
    rule = rule or f"foreign_key({','.join(cols)})"
    not_null = F.lit(True)
    for c in cols:
        not_null = not_null & F.col(c).isNotNull()
    pk = parent.select(*[F.col(p).alias(f"__fk{i}") for i, p in enumerate(pcols)]).distinct()
    c = child.filter(not_null)
    cond = [c[col] == pk[f"__fk{i}"] for i, col in enumerate(cols)]
    orphans = c.join(pk, cond, "left_anti")
    return _shape(orphans, rule, table, key_text(_names(key)), F.concat(F.lit("missing "), key_text(cols)))
