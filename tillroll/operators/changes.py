"""Change data: keyed snapshot diff, as-of states over a versioned change log,
and UPDATE-style column rewrites.

A change log has one row per committed version of a key:
``key…, commit_ts, action ('INSERT' | 'DELETE'), payload columns…``.
Time travel (``AT(TIMESTAMP)``, ``AT(OFFSET)``, ``BEFORE(STATEMENT)``) becomes
"latest version per key among commits up to a bound, minus deletes" — a
filter plus a map-side-combining aggregate, so it scales with the log.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators.latest import latest_per_key

ACTION_INSERT = "INSERT"
ACTION_DELETE = "DELETE"


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _all_present(keys: Sequence[str]) -> Column:
    out = F.col(keys[0]).isNotNull()
    for k in keys[1:]:
        out = out & F.col(k).isNotNull()
    return out


def state_as_of(log: DataFrame, key, bound: Column, *, commit_col: str = "commit_ts",
                action_col: str = "action", inclusive: bool = True,
                tie_cols: Sequence[str] = ()) -> DataFrame:
    """State of the table at ``bound``: for each key the last version committed
    at (or, with ``inclusive=False``, strictly before) the bound, dropped when
    that version is a delete.  ``bound`` may be a literal or a scalar subquery.
    Rows with a NULL key part have no identity: each that is not a delete stays.
    """
    keys = _keys(key)
    cond = F.col(commit_col) <= bound if inclusive else F.col(commit_col) < bound
    upto = log.filter(cond)
    payload = [c for c in log.columns if c not in keys and c not in (commit_col, action_col)]
    known = _all_present(keys)
    loose = upto.filter(~known)
    upto = upto.filter(known)
    latest = latest_per_key(upto, keys, [commit_col, *tie_cols, action_col],
                            columns=[*keys, commit_col, action_col, *payload])
    return latest.unionByName(loose.select(*latest.columns)).filter(
        F.col(action_col) != ACTION_DELETE).select(*keys, *payload)


def state_as_of_offset(log: DataFrame, key, seconds: int, *, anchor: Column | None = None,
                       commit_col: str = "commit_ts", **kw) -> DataFrame:
    """``AT(OFFSET => -seconds)``: the state ``seconds`` before ``anchor``.

    ``anchor`` defaults to the current time; pass the log's last commit for a
    reproducible reading.
    """
    anchor = F.current_timestamp() if anchor is None else anchor
    bound = anchor - F.make_dt_interval(secs=F.lit(seconds))
    return state_as_of(log, key, bound, commit_col=commit_col, **kw)


def state_before(log: DataFrame, key, statement_commit: Column, **kw) -> DataFrame:
    """``BEFORE(STATEMENT => id)``: the state just before a commit."""
    return state_as_of(log, key, statement_commit, inclusive=False, **kw)


def last_commit(log: DataFrame, commit_col: str = "commit_ts") -> Column:
    """Uncorrelated scalar subquery: the newest commit time of the log."""
    return log.select(F.max(commit_col)).scalar()


def snapshot_diff(old: DataFrame, new: DataFrame, key, columns: Sequence[str] | None = None
                  ) -> DataFrame:
    """Standard change stream between two keyed snapshots.

    Rows: ``key…, columns…, change_action, change_isupdate``.  A new key is an
    INSERT, a vanished key a DELETE, a changed row a DELETE (old values) plus an
    INSERT (new values), both flagged ``change_isupdate``.  Equality is
    NULL-safe per column.  Rows with a NULL key carry no identity and are
    dropped.  One shuffle on the key (a full outer join of two snapshots with
    one row per key, so no key can be hot).
    """
    keys = _keys(key)
    cols = list(columns or [c for c in new.columns if c not in keys])
    o = old.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in cols], F.lit(True).alias("_o"))
    n = new.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in cols], F.lit(True).alias("_n"))
    kfilter = None
    for k in keys:
        c = F.col(k).isNotNull()
        kfilter = c if kfilter is None else kfilter & c
    j = o.filter(kfilter).join(n.filter(kfilter), keys, "full_outer")
    same = None
    for c in cols:
        e = F.col(f"_o_{c}").eqNullSafe(F.col(f"_n_{c}"))
        same = e if same is None else same & e
    both = F.col("_o").isNotNull() & F.col("_n").isNotNull()
    is_upd = both & ~same
    emit_del = (F.col("_o").isNotNull() & F.col("_n").isNull()) | is_upd
    emit_ins = (F.col("_n").isNotNull() & F.col("_o").isNull()) | is_upd

    def side(prefix, action, emit):
        return F.when(emit, F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in cols],
                                     F.lit(action).alias("change_action"),
                                     is_upd.alias("change_isupdate")))

    rows = F.filter(F.array(side("_o_", ACTION_DELETE, emit_del),
                            side("_n_", ACTION_INSERT, emit_ins)), lambda s: s.isNotNull())
    return (j.select(*keys, F.explode(rows).alias("_c"))
             .select(*keys, *[F.col(f"_c.{c}").alias(c) for c in cols],
                     F.col("_c.change_action").alias("change_action"),
                     F.col("_c.change_isupdate").alias("change_isupdate")))


def update_where(df: DataFrame, assignments: Mapping[str, Column], where: Column) -> DataFrame:
    """``UPDATE t SET c = v … WHERE p`` as a new dataset (map-only)."""
    out = df
    for c, v in assignments.items():
        out = out.withColumn(c, F.when(where, v).otherwise(F.col(c)))
    return out


def restore_columns(current: DataFrame, earlier: DataFrame, key, columns: Sequence[str],
                    where: Column | None = None) -> DataFrame:
    """``UPDATE t SET c = (SELECT c FROM t BEFORE(…) WHERE k = t.k) [WHERE p]``.

    The correlated scalar subquery becomes a left join on the key: matching
    rows take the earlier value, rows whose key did not exist earlier get NULL
    (what an empty scalar subquery returns).  Keys are unique in ``earlier``
    (it is a state), so the join cannot fan out.
    """
    keys = _keys(key)
    e = earlier.select(*keys, *[F.col(c).alias(f"_e_{c}") for c in columns],
                       F.lit(True).alias("_e"))
    j = current.join(e, keys, "left")
    for c in columns:
        v = F.col(f"_e_{c}")
        j = j.withColumn(c, v if where is None else F.when(where, v).otherwise(F.col(c)))
    return j.select(*current.columns)


# ---------------------------------------------------------------- one-pass forms
def states_at(log: DataFrame, key, bounds: Mapping[str, tuple[Column, bool]], *,
              commit_col: str = "commit_ts", action_col: str = "action",
              tie_cols: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """Several as-of states of one log in a single aggregation.

    ``bounds`` maps a name to ``(bound, inclusive)``; a ``None`` bound means
    the latest state (no filter, so no scalar subquery scan).  Returns one row per key
    with a struct column per name holding that state's payload (NULL when the
    key has no version by then or its last version is a delete), and the
    payload column names.  One shuffle on the key, combined map-side.  A row with
    a NULL key part has no identity and is a version of itself only."""
    keys = _keys(key)
    payload = [c for c in log.columns if c not in keys and c not in (commit_col, action_col)]
    head = [commit_col, *tie_cols, action_col]
    rest = [c for c in payload if c not in tie_cols]
    ranked = F.struct(*[F.col(c) for c in head + rest])
    versions = {}
    for name, (bound, inclusive) in bounds.items():
        if bound is None:
            versions[f"_s_{name}"] = ranked
            continue
        cond = F.col(commit_col) <= bound if inclusive else F.col(commit_col) < bound
        versions[f"_s_{name}"] = F.when(cond, ranked)
    known = _all_present(keys)
    out = log.filter(known).groupBy(*keys).agg(*[F.max(v).alias(n) for n, v in versions.items()])
    out = out.unionByName(log.filter(~known).select(*keys, *[v.alias(n) for n, v in versions.items()]))
    cols = []
    for name in bounds:
        s = F.col(f"_s_{name}")
        alive = s.isNotNull() & (s.getField(action_col) != ACTION_DELETE)
        cols.append(F.when(alive, F.struct(*[s.getField(c).alias(c) for c in payload])).alias(name))
    return out.select(*keys, *cols), payload


def log_diff(log: DataFrame, key, old_bound: Column, new_bound: Column | None = None,
             **kw) -> DataFrame:
    """``snapshot_diff(state_as_of(log, old), state_as_of(log, new))`` in one
    aggregation and no join: both states come from the same log.
    ``new_bound=None`` compares with the latest state."""
    keys = _keys(key)
    st, payload = states_at(log, key, {"o": (old_bound, True), "n": (new_bound, True)}, **kw)
    o, n = F.col("o"), F.col("n")
    same = None
    for c in payload:
        e = o.getField(c).eqNullSafe(n.getField(c))
        same = e if same is None else same & e
    both = o.isNotNull() & n.isNotNull()
    is_upd = both & ~same
    emit_del = (o.isNotNull() & n.isNull()) | is_upd
    emit_ins = (n.isNotNull() & o.isNull()) | is_upd

    def side(s, action, emit):
        return F.when(emit, F.struct(*[s.getField(c).alias(c) for c in payload],
                                     F.lit(action).alias("change_action"),
                                     is_upd.alias("change_isupdate")))

    rows = F.filter(F.array(side(o, ACTION_DELETE, emit_del), side(n, ACTION_INSERT, emit_ins)),
                    lambda s: s.isNotNull())
    kf = None
    for k in keys:
        c = F.col(k).isNotNull()
        kf = c if kf is None else kf & c
    return (st.filter(kf).select(*keys, F.explode(rows).alias("_c"))
              .select(*keys, *[F.col(f"_c.{c}").alias(c) for c in payload],
                      "_c.change_action", "_c.change_isupdate"))


def log_restore(log: DataFrame, key, current_bound: Column, earlier_bound: Column,
                columns: Sequence[str], earlier_inclusive: bool = False, **kw) -> DataFrame:
    """``restore_columns(state(current), state(earlier), …)`` in one
    aggregation: rows of the current state with ``columns`` taken from the
    earlier state (NULL where the key did not exist then)."""
    keys = _keys(key)
    st, payload = states_at(log, key, {"c": (current_bound, True),
                                       "e": (earlier_bound, earlier_inclusive)}, **kw)
    cur, ear = F.col("c"), F.col("e")
    return st.filter(cur.isNotNull()).select(
        *keys, *[(ear.getField(c) if c in columns else cur.getField(c)).alias(c) for c in payload])
