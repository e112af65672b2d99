"""Changelog jobs."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from changeflow.operators import changelog as L
from changeflow.plans import derived as D
from changeflow.plans.registry import load, query

ORDER = ["ts", "event_id"]
_COLUMNS = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"

# ---- row-wise routing -------------------------------------------------------


@query("append_only", f"""WITH {D.USER_CHANGES_SQL}
    SELECT event_id, user_id, event_type, value FROM changes WHERE op = '+I'""")
def append_only(spark, sf_dir):
    return L.append_only(D.user_changes(spark, sf_dir)).drop("ts")


@query("without_before", f"""WITH {D.USER_CHANGES_SQL}
    SELECT op, event_id, user_id, value FROM changes WHERE op <> '-U'""")
def without_before(spark, sf_dir):
    return L.without_before(D.user_changes(spark, sf_dir)).select(
        "op", "event_id", "user_id", "value")


@query("flatten_changelog", "SELECT event_id, user_id, event_type, value FROM events")
def flatten_changelog(spark, sf_dir):
    return L.flatten_changelog(D.user_changes(spark, sf_dir)).drop("ts")


@query("flatten_changelog_keep_op", f"""WITH {D.USER_CHANGES_SQL}
    SELECT op, event_id, user_id, event_type, value FROM changes""")
def flatten_changelog_keep_op(spark, sf_dir):
    return L.flatten_changelog(D.user_changes(spark, sf_dir), keep_op=True).drop("ts")


# ---- folding ----------------------------------------------------------------

_LAST_SQL = f"""WITH {D.USER_CHANGES_SQL},
    last AS (SELECT * FROM changes
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)"""


@query("compact", f"{_LAST_SQL} SELECT op, user_id, event_id, event_type, value FROM last")
def compact(spark, sf_dir):
    return L.compact(D.user_changes(spark, sf_dir), ["user_id"], ORDER).drop("ts")


@query("materialize", f"""{_LAST_SQL}
    SELECT user_id, event_id, event_type, value FROM last WHERE op NOT IN ('-D', '-U')""")
def materialize(spark, sf_dir):
    return L.materialize(D.user_changes(spark, sf_dir), ["user_id"], ORDER).drop("ts")


def replay_sql(put: str, write: str, drop: str, fixed: bool = False) -> str:
    """The customer table after its changes, replayed one change at a time.

    ``put``, ``write`` and ``drop`` are the conditions on ``ch.op`` and the row's
    state under which a change makes the row exist, sets its values, removes it.
    """
    segment = put if fixed else write
    return f"""WITH RECURSIVE {D.CUSTOMER_CHANGES_SQL},
    ch AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY ts, event_id) AS k
           FROM changes),
    ids AS (SELECT c_custkey FROM customer UNION SELECT c_custkey FROM ch),
    st AS (
      SELECT ids.c_custkey, CAST(0 AS BIGINT) AS k, c.c_custkey IS NOT NULL AS alive, c.c_name,
             c.c_nationkey, c.c_acctbal, c.c_mktsegment
      FROM ids LEFT JOIN customer c ON c.c_custkey = ids.c_custkey
      UNION ALL
      SELECT st.c_custkey, ch.k, CASE WHEN {put} THEN true WHEN {drop} THEN false ELSE alive END,
             CASE WHEN {write} THEN ch.c_name ELSE st.c_name END,
             CASE WHEN {write} THEN ch.c_nationkey ELSE st.c_nationkey END,
             CASE WHEN {write} THEN ch.c_acctbal ELSE st.c_acctbal END,
             CASE WHEN {segment} THEN ch.c_mktsegment ELSE st.c_mktsegment END
      FROM st JOIN ch ON ch.c_custkey = st.c_custkey AND ch.k = st.k + 1)
    SELECT {_COLUMNS} FROM (SELECT * FROM st
      QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY k DESC) = 1) WHERE alive"""


def _changelog_sql(strategy: str, ignore_delete: bool, fixed: bool = False) -> str:
    put = "ch.op IN ('+I', '+U')" if strategy == "insert" else "ch.op = '+I'"
    write = f"({put} OR (ch.op = '+U' AND alive))" if strategy == "update" else put
    return replay_sql(put, write, "false" if ignore_delete else "ch.op = '-D'", fixed)


def _register_changelog(strategy: str, ignore_delete: bool) -> None:
    name = f"upsert_{strategy}_{'ignore' if ignore_delete else 'keep'}_delete"

    @query(name, _changelog_sql(strategy, ignore_delete))
    def run(spark, sf_dir):
        return L.apply_changelog(
            load(spark, sf_dir, "customer"), D.customer_changes(spark, sf_dir),
            ["c_custkey"], ORDER, strategy, ignore_delete)


for _strategy, _ignore in product(("update", "insert", "discard"), (False, True)):
    _register_changelog(_strategy, _ignore)


@query("upsert_fixed_partition_column", _changelog_sql("update", False, fixed=True))
def upsert_fixed_partition_column(spark, sf_dir):
    """An update leaves partition columns as they are; an insert sets them."""
    return L.apply_changelog(
        load(spark, sf_dir, "customer"), D.customer_changes(spark, sf_dir),
        ["c_custkey"], ORDER, "update", False, fixed=["c_mktsegment"])


@query("upsert_few_changes", _changelog_sql("update", False))
def upsert_few_changes(spark, sf_dir):
    """The plan for a small change set: the target is not moved."""
    return L.apply_changelog(
        load(spark, sf_dir, "customer"), D.customer_changes(spark, sf_dir),
        ["c_custkey"], ORDER, "update", False, few=True)


@query("flag_apply", replay_sql("ch.op IN ('+I', '+U')", "ch.op IN ('+I', '+U')",
                                "ch.op NOT IN ('+I', '+U')"))
def flag_apply(spark, sf_dir):
    changes = D.customer_changes(spark, sf_dir)
    flagged = changes.withColumn("is_add", F.col("op").isin(*L.ADDS)).drop("op")
    return L.apply_flagged(load(spark, sf_dir, "customer"), flagged, ["c_custkey"], ORDER)


# ---- one operation for a whole batch ----------------------------------------

_FIRST_SQL = f"""WITH {D.CUSTOMER_CHANGES_SQL},
    batch AS (SELECT * FROM changes
      QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY ts, event_id) = 1)"""
_NEWEST_SQL = _FIRST_SQL.replace("ORDER BY ts, event_id", "ORDER BY ts DESC, event_id DESC")


def _write_op(spark, sf_dir, operation, **flags):
    rows = D.customer_changes(spark, sf_dir).drop("op")
    return L.write_op(load(spark, sf_dir, "customer"), rows, ["c_custkey"], operation, ORDER, **flags)


@query("op_insert", f"""{_FIRST_SQL}
    SELECT {_COLUMNS} FROM customer UNION ALL
    SELECT {_COLUMNS} FROM batch WHERE c_custkey NOT IN (SELECT c_custkey FROM customer)""")
def op_insert(spark, sf_dir):
    return _write_op(spark, sf_dir, "INSERT", ignore_duplicate=True)


@query("op_update", f"""{_NEWEST_SQL}
    SELECT {_COLUMNS} FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM batch) UNION ALL
    SELECT {_COLUMNS} FROM batch WHERE c_custkey IN (SELECT c_custkey FROM customer)""")
def op_update(spark, sf_dir):
    return _write_op(spark, sf_dir, "UPDATE", ignore_not_found=True)


@query("op_delete", f"""WITH {D.CUSTOMER_CHANGES_SQL}
    SELECT {_COLUMNS} FROM customer
    WHERE c_custkey NOT IN (SELECT c_custkey FROM changes WHERE op = '-D')""")
def op_delete(spark, sf_dir):
    gone = D.customer_changes(spark, sf_dir).where(F.col("op") == L.DELETE).drop("op")
    return L.write_op(load(spark, sf_dir, "customer"), gone, ["c_custkey"], "DELETE", ORDER,
                      ignore_not_found=True)


@query("op_upsert", f"""{_NEWEST_SQL}
    SELECT {_COLUMNS} FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM batch)
    UNION ALL SELECT {_COLUMNS} FROM batch""")
def op_upsert(spark, sf_dir):
    return _write_op(spark, sf_dir, "UPSERT")


@query("insert_or_update", f"""{_NEWEST_SQL}
    SELECT {_COLUMNS} FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM batch)
    UNION ALL SELECT {_COLUMNS} FROM batch""")
def insert_or_update(spark, sf_dir):
    """Every row kind, deletes too, is put as a row."""
    return L.upsert(load(spark, sf_dir, "customer"), D.customer_changes(spark, sf_dir),
                    ["c_custkey"], ORDER, op="op", deletes="as_upsert")


@query("upsert_pv_uv_by_tenant", """WITH daily AS (
      SELECT user_id AS tenant_id, strftime(ts, '%Y-%m-%d') AS dt, count(*) AS pv,
        count(DISTINCT event_type) AS uv FROM events GROUP BY 1, 2)
    SELECT tenant_id, dt, pv, uv FROM daily
    QUALIFY row_number() OVER (PARTITION BY tenant_id ORDER BY dt DESC) = 1""")
def upsert_pv_uv_by_tenant(spark, sf_dir):
    """Daily counts upserted by tenant alone: the newest day of each stays."""
    daily = load(spark, sf_dir, "events").groupBy(
        F.col("user_id").alias("tenant_id"), F.to_date("ts").alias("day")).agg(
        F.count("*").alias("pv"), F.count_distinct("event_type").alias("uv"))
    rows = daily.select("tenant_id", F.date_format("day", "yyyy-MM-dd").alias("dt"), "pv", "uv")
    empty = rows.limit(0)
    return L.upsert(empty, rows, ["tenant_id"], ["dt"])


@query("map_rows_to_operations", replay_sql("ch.op = '+U'", "ch.op = '+U'", "ch.op = '-D'"))
def map_rows_to_operations(spark, sf_dir):
    """A user function names each row's operation; columns match the table by name."""
    target, changes = load(spark, sf_dir, "customer"), D.customer_changes(spark, sf_dir)
    kind = F.when(F.col("kind") == "+U", "UPSERT").when(F.col("kind") == "-D", "DELETE")
    mapped = L.map_operations(changes.withColumnRenamed("op", "kind"), target.columns, kind)
    return L.apply_changelog(target, mapped.where(F.col("op").isNotNull()), ["c_custkey"], ORDER,
                             "insert", ignore_delete=False)


@query("key_violations", """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
    GROUP BY 1, 2 HAVING count(*) > 1""")
def key_violations(spark, sf_dir):
    return L.key_violations(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
