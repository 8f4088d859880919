"""Data-quality checks (Q1) and operational-table constraints (Q2).

Q1 runs all nine silver checks in one aggregate pass (the reference runs ten
Spark actions) and unpivots the single result row into one row per check.
Q2 turns the source database's declared constraints into DataFrame checks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens import schemas as S


class QualityGateError(RuntimeError):
    """Raised by ``gate`` when checks fail and the policy is 'raise'."""


def _check_row(name: str, passed: Column, actual: Column, expected: str) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        passed.alias("passed"),
        actual.cast("double").alias("actual"),
        F.lit(expected).alias("expected"),
    )


def silver_checks(df: DataFrame, min_rows: int = S.MIN_ROW_COUNT) -> DataFrame:
    """The nine silver checks as rows (check_name, passed, actual, expected).

    One pass: a single global aggregate. The exact distinct count of
    shipment ids is planned as a partial de-duplication per task, an
    exchange on shipment_id, then one row per task to the final merge, so a
    hot id costs one row per task, not a skewed partition.
    """
    return check_rows(df.agg(*check_stats(), F.count_distinct("shipment_id").alias("distinct_ids")), min_rows)


CHECK_STATS = ["n", *[f"null_{c}" for c in S.NULL_CHECK_COLUMNS], "bad_status", "min_weight", "null_id", "dq_fails"]


def check_stats(rows: Column | None = None) -> list[Column]:
    """The aggregates behind the checks (``CHECK_STATS``), all but the distinct
    ids: each of them merges over parts of a table. ``rows`` limits them to
    some rows where a filter cannot (metrics observed on a write)."""
    of = (lambda c: c) if rows is None else (lambda c: c & rows)
    value = (lambda c: c) if rows is None else (lambda c: F.when(rows, c))
    return [
        (F.count(F.lit(1)) if rows is None else F.count_if(rows)).alias("n"),
        *[F.count_if(of(F.col(c).isNull())).alias(f"null_{c}") for c in S.NULL_CHECK_COLUMNS],
        # ~isin skips a null status: null is neither in nor out of the list.
        F.count_if(of(~F.col("status").isin(S.VALID_STATUSES))).alias("bad_status"),
        F.min(value(F.col("weight_kg"))).alias("min_weight"),
        # distinct() counts a null id as one value; count_distinct does not.
        F.coalesce(F.max(value(F.col("shipment_id").isNull().cast("int"))), F.lit(0)).alias("null_id"),
        F.count_if(of(F.col("dq_flag") == F.lit(S.FAIL))).alias("dq_fails"),
    ]


def check_rows(stats: DataFrame, min_rows: int = S.MIN_ROW_COUNT) -> DataFrame:
    """One row per check from the one row of ``CHECK_STATS`` and distinct_ids."""
    null_cols = S.NULL_CHECK_COLUMNS
    n = F.col("n")
    duplicates = n - (F.col("distinct_ids") + F.col("null_id"))
    rows = [_check_row(S.CHECK_MIN_ROWS, n >= F.lit(min_rows), n, f">= {min_rows}")]
    for c in null_cols:
        cnt = F.col(f"null_{c}")
        rows.append(_check_row(S.CHECK_NULLS.format(c), cnt == 0, cnt, "0"))
    rows += [
        _check_row(S.CHECK_STATUS, F.col("bad_status") == 0, F.col("bad_status"), "0"),
        # An empty table has no minimum: the check fails instead of erroring.
        _check_row(
            S.CHECK_WEIGHT,
            F.coalesce(F.col("min_weight") > 0, F.lit(False)),
            F.col("min_weight"),
            "> 0",
        ),
        _check_row(S.CHECK_DUPLICATES, duplicates == 0, duplicates, "0"),
        _check_row(S.CHECK_DQ_FLAG, F.col("dq_fails") == 0, F.col("dq_fails"), "0"),
    ]
    return stats.select(F.inline(F.array(*rows)))


def check_tally(checks: DataFrame) -> DataFrame:
    """(total, passed, failed) over check rows."""
    return checks.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("passed")).alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
    )


def gate(checks: DataFrame, on_fail: str = "warn") -> list:
    """Act on check results before gold is built: 'warn' returns the failed
    rows (the reference's behaviour: print, never stop), 'raise' stops the run.
    The check frame holds one row per check, so collecting it is bounded."""
    failed = [r for r in checks.filter(~F.col("passed")).collect()]
    if failed and on_fail == "raise":
        names = ", ".join(r["check_name"] for r in failed)
        raise QualityGateError(f"{len(failed)} checks failed: {names}")
    return failed


# ---------------------------------------------------------------------------
# Q2: constraints of the operational tables
# ---------------------------------------------------------------------------


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _absent(name: str, df: DataFrame, extra: dict[str, Column]) -> DataFrame:
    """The row of a rule whose table or column is not there: its count is null."""
    columns = [F.lit(name).alias("constraint_name"), *[v.alias(k) for k, v in extra.items()]]
    return df.sparkSession.range(1).select(*columns, F.lit(None).cast("bigint").alias("n"))


def pk_violations(tables: dict[str, DataFrame], keys: dict[str, str] | None = None) -> DataFrame:
    """Rows beyond the first per key, plus rows with a null key, per table
    (n is null where the table or column is absent)."""
    keys = keys or S.PRIMARY_KEYS
    some = next(iter(tables.values()))
    frames = []
    for t, k in keys.items():
        name = f"{t}.{k}"
        if t not in tables or k not in tables[t].columns:
            frames.append(_absent(name, some, {}))
            continue
        n = (F.count(F.lit(1)) - F.count_distinct(F.col(k))).alias("n")
        frames.append(tables[t].agg(n).select(F.lit(name).alias("constraint_name"), "n"))
    return _union(frames)


def _per_table_counts(tables, rules, label, condition, extra=None) -> DataFrame:
    """Count rows matching ``condition(rule)`` for every rule, with ONE
    aggregate per table (all of a table's rules side by side), unpivoted to
    one row per rule: each table is scanned once, however many rules it has.
    A rule whose table or column is absent gives a row with a null count."""
    by_table: dict[str, list] = {}
    some, frames = next(iter(tables.values())), []

    def more(rule) -> dict[str, Column]:
        return {"max_length": F.lit(extra(rule))} if extra else {}

    for rule in rules:
        t, c = rule[0], rule[1]
        if t in tables and c in tables[t].columns:
            by_table.setdefault(t, []).append(rule)
        else:
            frames.append(_absent(label(rule), some, more(rule)))
    for t, trs in by_table.items():
        wide = tables[t].agg(*[F.count_if(condition(r)).alias(f"n{i}") for i, r in enumerate(trs)])
        rows = [
            F.struct(
                F.lit(label(r)).alias("constraint_name"),
                *[v.alias(k) for k, v in more(r).items()],
                F.col(f"n{i}").alias("n"),
            )
            for i, r in enumerate(trs)
        ]
        frames.append(wide.select(F.inline(F.array(*rows))))
    return _union(frames)


def not_null_violations(tables: dict[str, DataFrame], rules=None) -> DataFrame:
    return _per_table_counts(
        tables,
        rules or S.NOT_NULL,
        label=lambda r: f"{r[0]}.{r[1]}",
        condition=lambda r: F.col(r[1]).isNull(),
    )


def orphan_count(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-null foreign key has no parent row.

    The child is first reduced to (key, rows) with a partial aggregate, so a
    key holding a third of all rows becomes one row per task before the
    shuffle; the anti-join then runs on distinct keys only, and the counts
    are summed back, so the result still counts rows. The parent's keys are
    de-duplicated the same way (a duplicated primary key is one of the
    violations this module finds), and that aggregate's hash partitioning is
    the one the join needs, so it costs no extra exchange."""
    per_key = child.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("_k")).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    parents = parent.select(F.col(pk).alias("_k")).distinct()
    orphans = per_key.join(parents, "_k", "left_anti")
    return orphans.agg(F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("n"))


def fk_orphans(tables: dict[str, DataFrame], rules=None) -> DataFrame:
    frames = []
    for c, fk, p, pk in rules or S.FOREIGN_KEYS:
        name = f"{c}.{fk} -> {p}.{pk}"
        if c in tables and p in tables and fk in tables[c].columns and pk in tables[p].columns:
            found = orphan_count(tables[c], fk, tables[p], pk)
            frames.append(found.select(F.lit(name).alias("constraint_name"), "n"))
        else:
            frames.append(_absent(name, next(iter(tables.values())), {}))
    return _union(frames)


def length_violations(tables: dict[str, DataFrame], limits=None) -> DataFrame:
    """VARCHAR(n) limits: values longer than n characters. Each table is
    scanned once for all its limits."""
    return _per_table_counts(
        tables,
        limits or S.VARCHAR_LIMITS,
        label=lambda r: f"{r[0]}.{r[1]}",
        condition=lambda r: F.char_length(F.col(r[1])) > F.lit(r[2]),
        extra=lambda r: r[2],
    )


def decimal_violations(tables: dict[str, DataFrame], columns=None) -> DataFrame:
    """Values that do not fit DECIMAL(p, s): try_cast rounds to the scale and
    gives null on overflow, so a non-null value that casts to null violates."""
    return _per_table_counts(
        tables,
        columns or S.DECIMAL_COLUMNS,
        label=lambda r: f"{r[0]}.{r[1]} decimal({r[2]},{r[3]})",
        condition=lambda r: F.col(r[1]).isNotNull() & F.col(r[1]).try_cast(f"decimal({r[2]},{r[3]})").isNull(),
    )


def cast_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Per declared column: values of the raw table that its DDL type cannot
    hold (out of range, not a number, not a date). A column that is missing
    gives a row with a null count."""
    rules = [(t, f.name, f.dataType) for t, schema in S.OPERATIONAL_SCHEMAS.items() if t in tables for f in schema.fields]
    return _per_table_counts(
        tables,
        rules,
        label=lambda r: f"{r[0]}.{r[1]} {r[2].simpleString()}",
        condition=lambda r: F.col(r[1]).isNotNull() & F.col(r[1]).try_cast(r[2]).isNull(),
    )


def constraint_report(tables: dict[str, DataFrame]) -> DataFrame:
    """(rule, constraint_name, n): every declared constraint in one table."""
    checks = {
        "primary key": pk_violations(tables),
        "not null": not_null_violations(tables),
        "foreign key": fk_orphans(tables),
        "length": length_violations(tables).drop("max_length"),
        "type": cast_violations(tables),
    }
    return _union([df.select(F.lit(rule).alias("rule"), "constraint_name", "n") for rule, df in checks.items()])


def apply_defaults(df: DataFrame, table: str, run_ts: Column | None = None) -> DataFrame:
    """SQL column defaults fill *omitted* columns only; an explicit null in a
    present column stays null. 'now' becomes the run timestamp."""
    schema = {f.name: f.dataType for f in S.OPERATIONAL_SCHEMAS[table].fields}
    additions = {}
    for column, value in S.DEFAULTS.get(table, {}).items():
        if column in df.columns:
            continue
        if value == "now":
            additions[column] = (run_ts if run_ts is not None else F.current_timestamp()).cast(
                schema[column]
            )
        else:
            additions[column] = F.lit(value).cast(schema[column])
    return df.withColumns(additions) if additions else df
