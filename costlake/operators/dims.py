"""Dimensions: service (SCD1, D2), customer (SCD2, D3), snapshot masking (D4),
snapshot diff (D7) and the service category mapping (P4)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costlake.functions.masking import (
    check_salt, email_is_valid, mask_email, phone_is_valid, redact_phone,
)
from costlake.operators.joins import tasks_for
from costlake.operators.keys import assign_surrogate_keys, max_key_column
from costlake.operators.upsert import unique_rows, upsert
from costlake.session import materialize
from costlake.schemas import DEFAULT_CATEGORY, DIM_CUSTOMER_COLUMNS, DIM_SERVICE_COLUMNS, SERVICE_CATEGORIES


# --- P4 ------------------------------------------------------------------------------

def service_category(product_code: str | Column, mapping: dict[str, str] | None = None,
                     default: str = DEFAULT_CATEGORY) -> Column:
    """Product code -> category (CASE chain over a small fixed map)."""
    pc = F.col(product_code) if isinstance(product_code, str) else product_code
    mapping = SERVICE_CATEGORIES if mapping is None else mapping
    expr = None
    for code, cat in mapping.items():
        expr = F.when(pc == code, F.lit(cat)) if expr is None else expr.when(pc == code, F.lit(cat))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def _require_not_null(df: DataFrame, cols: list[str], what: str) -> DataFrame:
    """Fail the job on the first NULL in ``cols`` (evaluated lazily, in the tasks)."""
    out = df
    for c in cols:
        out = out.withColumn(c, F.when(F.col(c).isNull(),
                                       F.raise_error(F.lit(f"{what}: NULL {c}"))).otherwise(F.col(c)))
    return out


# --- D2: dim_service ---------------------------------------------------------------

def service_observations(raw: DataFrame) -> DataFrame:
    """A3: distinct (product_code, usage_type) with first and last usage date."""
    d = F.col("line_item_usage_start_date")
    return (raw.groupBy(F.col("line_item_product_code").alias("product_code"),
                        F.col("line_item_usage_type").alias("usage_type"))
            .agg(F.min(d).alias("first_seen"), F.max(d).alias("last_seen")))


def load_dim_service(raw: DataFrame, existing: DataFrame | None, run_ts: str,
                     mapping: dict[str, str] | None = None) -> DataFrame:
    """SCD1 merge of observed services into ``dim_service``.

    Keys: ``ROW_NUMBER() OVER (ORDER BY product_code, usage_type)`` over *all*
    observed services plus the old maximum, so a second load leaves gaps and
    never reuses a key; existing rows keep theirs. On conflict only
    ``last_seen_date`` (overwritten, not GREATEST) and ``_updated_at`` change.
    NULL product or usage type fails the load.

    The observations are one row per distinct service (bounded by the
    service catalogue), so the key numbering may use one partition.
    """
    return dim_service_from(service_observations(raw), existing, run_ts, mapping)


def merge_service_state(state: DataFrame | None, batch: DataFrame) -> DataFrame:
    """A3 kept as a mergeable state: the observations of everything loaded so far
    and of ``batch``, without the lines behind the state."""
    seen = service_observations(batch)
    if state is None:
        return seen
    return (state.unionByName(seen).groupBy("product_code", "usage_type")
            .agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen")))


def dim_service_from(observations: DataFrame, existing: DataFrame | None, run_ts: str,
                     mapping: dict[str, str] | None = None) -> DataFrame:
    """D2 from the observations (A3) of the lines loaded so far: those of a full
    scan, or a state that ``merge_service_state`` carries from batch to batch."""
    obs = _require_not_null(observations, ["product_code", "usage_type"], "dim_service")
    start = max_key_column(existing, "service_key")
    keyed = assign_surrogate_keys(obs, ["product_code", "usage_type"], "service_key", start, method="global")
    ts = F.lit(run_ts)
    src = keyed.select(
        F.col("service_key").cast("bigint").alias("service_key"),
        "product_code", "usage_type",
        service_category("product_code", mapping).alias("service_category"),
        F.col("first_seen").alias("first_seen_date"),
        F.col("last_seen").alias("last_seen_date"),
        ts.alias("_loaded_at"), ts.alias("_updated_at"),
    )
    if existing is None:
        return src
    # src is grouped by (product_code, usage_type): unique by construction
    return upsert(existing.select(*DIM_SERVICE_COLUMNS), src,
                  ["product_code", "usage_type"], ["last_seen_date", "_updated_at"], check_unique=False)


# --- D4: masking -----------------------------------------------------------------------

@dataclass
class MaskResult:
    valid: DataFrame
    rejected: DataFrame


_REQUIRED = ["first_name", "last_name", "segment"]


def _reason(df: DataFrame) -> Column:
    reasons = [F.when(~email_is_valid("email"), F.lit("invalid email")),
               F.when(~phone_is_valid("phone"), F.lit("phone too short"))]
    reasons += [F.when(F.col(c).isNull(), F.lit(f"NULL {c}")) for c in _REQUIRED]
    return F.concat_ws("; ", *reasons)


def _masked_columns(salt: str) -> list[Column]:
    return [F.col("customer_id"),
            mask_email("email", salt).alias("email_token"),
            redact_phone("phone").alias("phone_redacted"),
            F.col("first_name"), F.col("last_name"), F.col("segment")]


def mask_snapshot(snapshot: DataFrame, salt: str) -> DataFrame:
    """D4 strict: mask every row; one invalid row fails the job (before any write).

    The check is part of the ``customer_id`` output expression, so column
    pruning cannot drop it.
    """
    return snapshot.select(*_checked_mask(snapshot, salt))


def _checked_mask(snapshot: DataFrame, salt: str) -> list[Column]:
    check_salt(salt)
    reason = _reason(snapshot)
    checked_id = F.when(reason != "", F.raise_error(
        F.concat(F.lit("invalid customer row "), F.col("customer_id").cast("string"), F.lit(": "), reason))
    ).otherwise(F.col("customer_id"))
    return [checked_id.alias("customer_id"), *_masked_columns(salt)[1:]]


def mask_snapshot_quarantine(snapshot: DataFrame, salt: str) -> MaskResult:
    """D4 quarantine: valid rows masked, invalid rows set aside with a reason
    (the raw values of rejected rows are not carried along)."""
    check_salt(salt)
    checked = snapshot.withColumn("_reason", _reason(snapshot))
    valid = checked.filter(F.col("_reason") == "").select(*_masked_columns(salt))
    rejected = checked.filter(F.col("_reason") != "").select("customer_id", F.col("_reason").alias("reason"))
    return MaskResult(valid, rejected)


# --- D3: dim_customer (SCD2) ----------------------------------------------------------

def load_dim_customer(dim: DataFrame | None, snapshot: DataFrame, salt: str, snapshot_date: str,
                      tracked_cols: list[str] | None = None, key_method: str = "range") -> DataFrame:
    """D3: SCD2 load of one full snapshot; returns the whole new dimension
    (see ``scd2_changes`` for the rules and the part a load rewrites)."""
    history, changed = scd2_changes(dim, snapshot, salt, snapshot_date, tracked_cols, key_method)
    return changed if history is None else history.unionByName(changed)


def scd2_changes(dim: DataFrame | None, snapshot: DataFrame, salt: str, snapshot_date: str,
                 tracked_cols: list[str] | None = None,
                 key_method: str = "range") -> tuple[DataFrame | None, DataFrame]:
    """D3 split for writing: ``(history, changed)``.

    ``history`` is the closed versions before this load (untouched);
    ``changed`` is every version that was current before the load (kept or
    now closed) plus the new versions. Stored partitioned by
    ``(is_current, effective_to)``, a load rewrites only the current slice
    and the history partition of its own snapshot date.

    * new customer -> current version from ``snapshot_date``;
    * tracked column changed (default: segment only) -> current version
      closed (``effective_to = snapshot_date``, ``is_current = false``) and a
      new current version added;
    * unchanged, or absent from the snapshot -> untouched.

    Only the current slice is joined with the snapshot (one shuffle of each
    on ``customer_id``); closed history passes through. New versions get
    keys after the old maximum, in ``customer_id`` order. A customer twice
    in one snapshot fails the load.
    """
    tracked = tracked_cols or ["segment"]
    # The snapshot is dealt before it is masked, however few tasks can read it, and masked once:
    # the guard, the key assignment (twice) and the kept versions all read the result.
    tasks = int(snapshot.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    masked = materialize(mask_snapshot(snapshot.repartition(tasks), salt))
    snap = F.lit(snapshot_date)
    if dim is None:
        history = None
        current = None
        start = 0
    else:
        dim = dim.select(*DIM_CUSTOMER_COLUMNS)
        history = dim.filter(~F.col("is_current"))
        current = dim.filter(F.col("is_current"))
        start = max_key_column(dim, "customer_key")

    # A customer twice in one snapshot fails the load (aggregate-based guard:
    # skew-proof, and its partitioning by customer_id is reused by the join).
    masked = unique_rows(masked, ["customer_id"], "customer snapshot", check_cols=tracked)
    s = masked.select(*[F.col(c).alias(f"s_{c}") for c in masked.columns], F.lit(True).alias("_in_s"))
    if current is None:
        j = s.withColumn("_new", F.lit(True)).withColumn("_chg", F.lit(False))
        kept = None
    else:
        c_ = current.select(*[F.col(c).alias(f"c_{c}") for c in DIM_CUSTOMER_COLUMNS],
                            F.lit(True).alias("_in_c"))
        j = s.join(c_, F.col("s_customer_id") == F.col("c_customer_id"), "full_outer")
        in_s, in_c = F.col("_in_s").isNotNull(), F.col("_in_c").isNotNull()
        changed = F.lit(False)
        for c in tracked:
            changed = changed | ~F.col(f"s_{c}").eqNullSafe(F.col(f"c_{c}"))
        j = j.withColumn("_new", in_s & ~in_c).withColumn("_chg", in_s & in_c & changed)
        # current rows: closed when changed, otherwise as they were
        kept = j.filter(in_c).select(*[
            (F.when(F.col("_chg"), snap).otherwise(F.col("c_effective_to")).alias(c) if c == "effective_to"
             else F.when(F.col("_chg"), F.lit(False)).otherwise(F.col("c_is_current")).alias(c)
             if c == "is_current" else F.col(f"c_{c}").alias(c))
            for c in DIM_CUSTOMER_COLUMNS])

    inserts = j.filter(F.col("_new") | F.col("_chg")).select(
        F.col("s_customer_id").alias("customer_id"),
        F.col("s_email_token").alias("email_token"),
        F.col("s_phone_redacted").alias("phone_redacted"),
        F.col("s_first_name").alias("first_name"),
        F.col("s_last_name").alias("last_name"),
        F.col("s_segment").alias("segment"),
    )
    inserts = assign_surrogate_keys(inserts, ["customer_id"], "customer_key", start, method=key_method)
    inserts = inserts.select(
        "customer_key", "customer_id", "email_token", "phone_redacted", "first_name", "last_name",
        "segment", snap.alias("effective_from"), F.lit(None).cast("string").alias("effective_to"),
        F.lit(True).alias("is_current"), snap.alias("_loaded_at"))
    out = inserts if kept is None else kept.unionByName(inserts)
    return history, out


def replay_snapshots(snapshots: DataFrame, salt: str, tracked_cols: list[str] | None = None,
                     date_col: str = "snapshot_date") -> DataFrame:
    """The dimension after loading every snapshot of ``snapshots`` (snapshot
    columns and ``date_col``) in date order, in one pass.

    Gaps and islands: among a customer's rows by date, those whose tracked columns
    differ from the row before start a version; the next start closes it. A
    snapshot that lacks a customer has no row, so it changes nothing. Keys are
    numbered by (start, customer_id), the order in which loads hand them out.
    One shuffle on ``customer_id`` (a customer has at most one row per snapshot;
    twice in one fails), then the key assignment, both over as many tasks as the
    counted rows need.
    """
    tracked = tracked_cols or ["segment"]
    masked = mask_snapshot(snapshots, salt).columns
    rows = snapshots.select(F.col(date_col).cast("string").alias("_day"), *_checked_mask(snapshots, salt))
    parts = tasks_for(snapshots.sparkSession, snapshots.count())
    rows = rows.repartition(parts, "customer_id")
    rows = unique_rows(rows, ["customer_id", "_day"], "customer snapshots", check_cols=tracked)
    by_day = Window.partitionBy("customer_id").orderBy("_day")
    starts = F.lag(F.lit(True)).over(by_day).isNull()
    for c in tracked:
        starts = starts | ~F.lag(c).over(by_day).eqNullSafe(F.col(c))
    versions = rows.withColumn("_starts", starts).filter("_starts").select(
        *masked, F.col("_day").alias("effective_from"), F.lead("_day").over(by_day).alias("effective_to"))
    keyed = assign_surrogate_keys(versions, ["effective_from", "customer_id"], "customer_key", num_partitions=parts)
    return keyed.withColumn("is_current", F.col("effective_to").isNull()).withColumn(
        "_loaded_at", F.col("effective_from")).select(*DIM_CUSTOMER_COLUMNS)


# --- D7: snapshot diff ------------------------------------------------------------------

def snapshot_diff(old: DataFrame, new: DataFrame, tracked_cols: list[str] | None = None,
                  contact_cols: list[str] | None = None) -> DataFrame:
    """Per customer, how ``new`` differs from ``old``.

    ``change_type`` is ``new``, ``removed``, ``segment_changed`` (any tracked
    column differs), ``contact_changed`` (only contact columns differ) or
    ``unchanged``. One full outer join on ``customer_id``; each side is
    first made unique per id (a repeated id fails), so the join never
    multiplies rows.
    """
    tracked = tracked_cols or ["segment"]
    contact = contact_cols or ["email", "phone"]
    cols = tracked + contact
    old = unique_rows(old.select("customer_id", *cols), ["customer_id"], "old snapshot")
    new = unique_rows(new.select("customer_id", *cols), ["customer_id"], "new snapshot")
    o = old.select(F.col("customer_id").alias("o_id"), *[F.col(c).alias(f"o_{c}") for c in cols])
    n = new.select(F.col("customer_id").alias("n_id"), *[F.col(c).alias(f"n_{c}") for c in cols])
    j = o.join(n, F.col("o_id") == F.col("n_id"), "full_outer")

    def differs(cs):
        e = F.lit(False)
        for c in cs:
            e = e | ~F.col(f"o_{c}").eqNullSafe(F.col(f"n_{c}"))
        return e

    kind = (F.when(F.col("o_id").isNull(), F.lit("new"))
            .when(F.col("n_id").isNull(), F.lit("removed"))
            .when(differs(tracked), F.lit("segment_changed"))
            .when(differs(contact), F.lit("contact_changed"))
            .otherwise(F.lit("unchanged")))
    return j.select(F.coalesce(F.col("n_id"), F.col("o_id")).alias("customer_id"),
                    kind.alias("change_type"),
                    F.col(f"o_{tracked[0]}").alias("old_segment"),
                    F.col(f"n_{tracked[0]}").alias("new_segment"))
