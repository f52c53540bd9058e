"""Write operators: upserts, idempotent appends and the case lifecycle.

Parquet cannot be updated in place, so every operator here is a pure function
``(current state, incoming batch) -> new state``; :class:`VersionedTable`
writes the new state as version N+1 beside N, which counts once its job has
committed, so a failed job never leaves a half-written table.

Scale: each operator shuffles once on its key (the window and the aggregate
after it share the partitioning), unchanged rows pass through a ``left_anti``
/ union without being rewritten row by row, and no per-row loop exists.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import constants as K
from ..functions.exprs import lit_ts, priority_of, stable_id
from ..registry import register
from ..session import checkpoint_dir
from ..sources.mapping import dealt
from ..sources.store import Store

LOAD_TS = _dt.datetime(2001, 8, 2, 6, 0, 0)     # load time of the replayed batches in the registered queries
LOAD_TS_SQL = "TIMESTAMP '2001-08-02 06:00:00'"
ARRIVAL = "_arrival"
#: an arrival order that no batch size can overflow: micro-batch, event day, file, row of the file
ARRIVAL_FIELDS = (("batch", "bigint"), ("day", "string"), ("file", "string"), ("row", "bigint"))


# ------------------------------------------------------------- versioned
class VersionedTable:
    """A keyed table stored as immutable versions under ``root/v=NNNNNN``.

    A version counts once its write job has committed (Spark's ``_SUCCESS``
    marker, the last file of a write), so a failed job leaves no version and
    there is no pointer to lose.  All file access goes through the Hadoop
    FileSystem of the path; the root must be a shared location (the cluster's
    checkpoint dir by default).  ``vacuum`` removes old versions.
    """

    def __init__(self, spark: SparkSession, name: str, root: str | None = None):
        self.spark = spark
        self.root = (root or f"{checkpoint_dir(spark)}/tables").rstrip("/") + "/" + name
        self.store = Store(spark, self.root)

    def _versions(self) -> list[int]:
        return [int(n[2:]) for n in self.store.children(self.root)
                if n.startswith("v=") and self.store.exists(f"{self.root}/{n}/_SUCCESS")]

    def current_version(self) -> int | None:
        return max(self._versions(), default=None)

    def read(self) -> DataFrame | None:
        v = self.current_version()
        return None if v is None else self.spark.read.parquet(f"{self.root}/v={v:06d}")

    def commit(self, df: DataFrame, partition_by: list[str] | None = None) -> int:
        v = (self.current_version() or 0) + 1
        w = df.write.mode("overwrite")               # over what a failed attempt left
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{self.root}/v={v:06d}")
        return v

    def vacuum(self, keep: int = 2) -> None:
        for v in sorted(self._versions())[:-keep]:
            self.store.delete(f"{self.root}/v={v:06d}")


# ------------------------------------------------------------- U01 latest
def upsert_latest(target: DataFrame, batch: DataFrame, key: str, load_ts: _dt.datetime,
                  arrival: str = ARRIVAL) -> DataFrame:
    """Insert-or-overwrite: the last arrival per key replaces the stored row.

    ``_loaded_at`` of replaced/inserted rows is the load time (as the reference does).
    """
    cols = [c for c in target.columns if c != "_loaded_at"]
    last = batch.groupBy(key).agg(F.max_by(F.struct(*[c for c in cols if c != key]), arrival).alias("r"))
    new = last.select(key, "r.*").withColumn("_loaded_at", lit_ts(load_ts))
    keep = target.join(new.select(key), key, "left_anti")
    return keep.unionByName(new.select(*target.columns))


def _plan_batch(rel) -> DataFrame:
    """Two arrivals per plan (premium raised twice) and one new plan."""
    p = rel.plans
    cols = [c for c in p.columns if c != "_loaded_at"]
    a1 = p.withColumn("premium_monthly_kes", (F.col("premium_monthly_kes") + 100).cast("decimal(15,2)")) \
        .select(*cols, F.lit(1).alias(ARRIVAL))
    a2 = p.filter(F.col("plan_tier") != "basic") \
        .withColumn("premium_monthly_kes", (F.col("premium_monthly_kes") + 250).cast("decimal(15,2)")) \
        .select(*cols, F.lit(2).alias(ARRIVAL))
    new = p.filter(F.col("plan_tier") == "family").select(
        F.lit("SENIOR").alias("plan_code"), F.lit("SENIOR cover").alias("plan_name"), F.lit("premium").alias("plan_tier"),
        *[F.col(c) for c in ("annual_limit_kes", "inpatient_limit_kes", "outpatient_limit_kes", "premium_monthly_kes",
                             "is_family_plan")], F.lit(3).alias(ARRIVAL))
    return a1.unionByName(a2).unionByName(new)


@register("upsert_u01_plans", sql=(
    "WITH b AS (SELECT plan_code, plan_name, plan_tier, annual_limit_kes, inpatient_limit_kes, outpatient_limit_kes, "
    "CAST(premium_monthly_kes + 100 AS DECIMAL(15,2)) AS premium_monthly_kes, is_family_plan, 1 AS a FROM plans UNION ALL "
    "SELECT plan_code, plan_name, plan_tier, annual_limit_kes, inpatient_limit_kes, outpatient_limit_kes, "
    "CAST(premium_monthly_kes + 250 AS DECIMAL(15,2)), is_family_plan, 2 FROM plans WHERE plan_tier <> 'basic' UNION ALL "
    "SELECT 'SENIOR', 'SENIOR cover', 'premium', annual_limit_kes, inpatient_limit_kes, outpatient_limit_kes, "
    "premium_monthly_kes, is_family_plan, 3 FROM plans WHERE plan_tier = 'family'), "
    "n AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY plan_code ORDER BY a DESC) = 1) "
    "SELECT plan_code, plan_name, plan_tier, CAST(annual_limit_kes AS DOUBLE) AS annual_limit_kes, "
    "CAST(inpatient_limit_kes AS DOUBLE) AS inpatient_limit_kes, CAST(outpatient_limit_kes AS DOUBLE) AS outpatient_limit_kes, "
    "CAST(premium_monthly_kes AS DOUBLE) AS premium_monthly_kes, is_family_plan, _loaded_at FROM plans p "
    "WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.plan_code = p.plan_code) UNION ALL "
    "SELECT plan_code, plan_name, plan_tier, CAST(annual_limit_kes AS DOUBLE), CAST(inpatient_limit_kes AS DOUBLE), "
    f"CAST(outpatient_limit_kes AS DOUBLE), CAST(premium_monthly_kes AS DOUBLE), is_family_plan, {LOAD_TS_SQL} FROM n"))
def u01_plans(rel) -> DataFrame:
    return upsert_latest(rel.plans, _plan_batch(rel), "plan_code", LOAD_TS)


# ------------------------------------------------------------ U02 members
KEPT_MEMBER_FIELDS = ("date_of_birth", "id_type", "id_number", "enrol_date")


def upsert_members(target: DataFrame, batch: DataFrame, load_ts: _dt.datetime, arrival: str = ARRIVAL) -> DataFrame:
    """Identity fields (birth date, id type/number, enrolment) are kept from the
    first row ever seen; every other field comes from the last arrival."""
    cols = [c for c in target.columns if c != "_loaded_at"]
    other = [c for c in cols if c not in KEPT_MEMBER_FIELDS and c != "member_id"]
    b = batch.groupBy("member_id").agg(
        F.min_by(F.struct(*KEPT_MEMBER_FIELDS), arrival).alias("first"),
        F.max_by(F.struct(*other), arrival).alias("last"))
    t = target.select("member_id", *[F.col(c).alias("old_" + c) for c in KEPT_MEMBER_FIELDS],
                      F.lit(True).alias("_exists"))
    j = b.join(t, "member_id", "left")
    kept = [F.when(F.col("_exists").isNotNull(), F.col("old_" + c)).otherwise(F.col("first." + c)).alias(c)
            for c in KEPT_MEMBER_FIELDS]
    new = j.select("member_id", *kept, *[F.col("last." + c).alias(c) for c in other], lit_ts(load_ts).alias("_loaded_at"))
    keep = target.join(b.select("member_id"), "member_id", "left_anti")
    return keep.unionByName(new.select(*target.columns))


def _member_batch(rel) -> DataFrame:
    m = rel.members
    cols = [c for c in m.columns if c != "_loaded_at"]
    k = F.col("member_id").cast("bigint")
    moved = m.filter(k % 5 == 0).withColumn("county", F.lit("NAIROBI")) \
        .withColumn("date_of_birth", F.lit("1999-09-09").cast("date")).select(*cols, F.lit(1).alias(ARRIVAL))
    plan = m.filter(k % 10 == 0).withColumn("plan_code", F.lit("HOUSEHOLD")) \
        .withColumn("id_number", F.lit("CHANGED")).select(*cols, F.lit(2).alias(ARRIVAL))
    new = m.filter(k % 50 == 1).withColumn("member_id", F.concat(F.col("member_id"), F.lit("-N"))) \
        .select(*cols, F.lit(1).alias(ARRIVAL))
    new2 = m.filter(k % 50 == 1).withColumn("member_id", F.concat(F.col("member_id"), F.lit("-N"))) \
        .withColumn("id_number", F.lit("LATER")).withColumn("phone_number", F.lit("+254700000000")) \
        .select(*cols, F.lit(2).alias(ARRIVAL))
    return moved.unionByName(plan).unionByName(new).unionByName(new2)


_MEMBER_COLS = ("member_id first_name last_name date_of_birth gender id_type id_number phone_number county sub_county "
                "enrol_date term_date plan_code employer_id is_active").split()


def _u02_sql() -> str:
    cols = ", ".join(_MEMBER_COLS)
    b = (f"WITH b AS (SELECT {cols.replace('date_of_birth', 'DATE ' + chr(39) + '1999-09-09' + chr(39) + ' AS date_of_birth').replace('county, sub_county', chr(39) + 'NAIROBI' + chr(39) + ' AS county, sub_county')}, 1 AS a FROM members WHERE CAST(member_id AS BIGINT) % 5 = 0 "
         f"UNION ALL SELECT {cols.replace('id_number', chr(39) + 'CHANGED' + chr(39) + ' AS id_number').replace('plan_code', chr(39) + 'HOUSEHOLD' + chr(39) + ' AS plan_code')}, 2 FROM members WHERE CAST(member_id AS BIGINT) % 10 = 0 "
         f"UNION ALL SELECT {cols.replace('member_id', 'member_id || ' + chr(39) + '-N' + chr(39) + ' AS member_id', 1)}, 1 FROM members WHERE CAST(member_id AS BIGINT) % 50 = 1 "
         f"UNION ALL SELECT {cols.replace('member_id', 'member_id || ' + chr(39) + '-N' + chr(39) + ' AS member_id', 1).replace('id_number', chr(39) + 'LATER' + chr(39) + ' AS id_number').replace('phone_number', chr(39) + '+254700000000' + chr(39) + ' AS phone_number')}, 2 FROM members WHERE CAST(member_id AS BIGINT) % 50 = 1), ")
    other = [c for c in _MEMBER_COLS if c not in KEPT_MEMBER_FIELDS and c != "member_id"]
    g = ("g AS (SELECT member_id, " + ", ".join(f"arg_min({c}, a) AS f_{c}" for c in KEPT_MEMBER_FIELDS) + ", "
         + ", ".join(f"arg_max({c}, a) AS {c}" for c in other) + " FROM b GROUP BY member_id), ")
    n = ("n AS (SELECT g.member_id, " + ", ".join(
        f"CASE WHEN m.member_id IS NOT NULL THEN m.{c} ELSE g.f_{c} END AS {c}" for c in KEPT_MEMBER_FIELDS)
        + ", " + ", ".join(f"g.{c}" for c in other) + f", {LOAD_TS_SQL} AS _loaded_at FROM g LEFT JOIN members m "
        "ON m.member_id = g.member_id) ")
    allc = ", ".join(_MEMBER_COLS + ["_loaded_at"])
    return (b + g + n + f"SELECT {allc} FROM members m WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.member_id = m.member_id) "
            f"UNION ALL SELECT {allc} FROM n")


def u02_members(rel) -> DataFrame:
    return upsert_members(rel.members, _member_batch(rel), LOAD_TS)


register("upsert_u02_members", sql=_u02_sql())(u02_members)


# ------------------------------------------------------------- U03 claims
CLAIM_COLS = ["claim_id", "member_id", "provider_id", "date_of_service", "date_submitted", "procedure_code",
              "diagnosis_code", "quantity", "amount_claimed", "amount_approved", "status", "submission_channel",
              "is_emergency", "prior_auth_number", "submitted_at", "updated_at"]
MUTABLE = ("amount_approved", "prior_auth_number", "status", "updated_at")


def split_by(target: DataFrame, touched: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows of ``target`` whose key is in ``touched`` (distinct), and the others.

    Rows that are dealt by a part of the key are marked by a window, as a join would deal them again.
    """
    if len(key) == 1:
        return target.join(touched, key, "left_semi"), target.join(touched, key, "left_anti")
    both = target.withColumn("_row", F.lit(True)).unionByName(touched.dropna(subset=key), allowMissingColumns=True)
    marked = both.withColumn("_hit", F.count_if(F.col("_row").isNull()).over(Window.partitionBy(*key)) > 0).where("_row")
    return marked.where("_hit").drop("_row", "_hit"), marked.where("not _hit").drop("_row", "_hit")


def upsert_claims(target: DataFrame, batch: DataFrame, load_ts: _dt.datetime, arrival: str = ARRIVAL,
                  block: int = 1 << 20, dealt: tuple[str, ...] = ()) -> DataFrame:
    """Latest-state upsert with the recency guard, for any micro-batch split.

    Fold rule: rows of one claim are ordered by arrival (the stored row
    first).  A row is accepted iff its ``updated_at`` is >= the max of all
    earlier rows; status and updated_at come from the last accepted row,
    amount_approved and prior_auth_number are the last non-NULL among accepted
    rows (COALESCE new over old), every other column comes from the first row.
    Claims that the batch does not touch pass through.
    The fold is two-level: per (claim, arrival block) the rows accepted within the
    block are folded, then the blocks are, so even a claim with millions of updates
    is never one sorted partition.  Within a block accepted rows never go back in
    time, so the block's last one of a kind stays accepted iff its own time is no
    earlier than all blocks before.  A block is one file of a replayed micro-batch,
    or ``block`` rows of a numbered batch.

    ``dealt`` names columns of both that the claim id determines and that their rows
    are dealt by already: with them in the keys no row is dealt again.
    """
    key = [*dealt, "claim_id"]
    # arrival as (batch, day, file, row): a plain number becomes (block, row)
    if isinstance(batch.schema[arrival].dataType, StructType):
        at = F.struct(*[F.coalesce(F.col(arrival)[c].cast(k), F.lit("").cast(k)).alias(c) if k == "string" else F.col(arrival)[c].cast(k).alias(c)
                        for c, k in ARRIVAL_FIELDS])
    else:
        n = F.col(arrival).cast("bigint")
        at = F.struct(F.floor(n / block).alias("batch"), F.lit("").alias("day"), F.lit("").alias("file"), n.alias("row"))
    stored = F.struct(F.lit(-1).cast("bigint").alias("batch"), F.lit("").alias("day"), F.lit("").alias("file"), F.lit(0).cast("bigint").alias("row"))
    batch = batch.where("claim_id is not null")
    t, rest = split_by(target, batch.select(*key).distinct(), key)
    cols = [*dealt, *CLAIM_COLS]
    rows = (t.select(*cols, stored.alias("_at"), F.lit(False).alias("_new"), F.col("_loaded_at").alias("_old_loaded"))
            .unionByName(batch.select(*cols, at.alias("_at"), F.lit(True).alias("_new"),
                                      F.lit(None).cast("timestamp_ntz").alias("_old_loaded"))))
    arrival = "_at"
    rows = rows.withColumn("_blk", F.struct("_at.batch", "_at.day", "_at.file"))
    wi = Window.partitionBy(*key, "_blk").orderBy(arrival).rowsBetween(Window.unboundedPreceding, -1)
    prev = F.max("updated_at").over(wi)                    # NULL only when no earlier row of the block has a time
    rows = rows.withColumn("_acc", prev.isNull() | (F.col("updated_at") >= prev))
    acc = F.col("_acc")
    fixed = [c for c in CLAIM_COLS if c not in MUTABLE and c != "claim_id"]

    def last(cond, *names):
        """The block's last accepted row that meets ``cond``: its time and values."""
        return F.max_by(F.struct(F.col("updated_at"), *names), F.when(acc & cond, F.col(arrival)))

    has_amount, has_auth = F.col("amount_approved").isNotNull(), F.col("prior_auth_number").isNotNull()
    blocks = rows.groupBy(*key, "_blk").agg(
        F.min(arrival).alias("_first"), F.min_by(F.struct(*fixed), arrival).alias("f"), F.max("updated_at").alias("_bmax"),
        last(F.lit(True), "status").alias("s"), last(has_amount, "amount_approved").alias("a"),
        last(has_auth, "prior_auth_number").alias("p"), last(F.col("_new")).alias("n"), F.max("_old_loaded").alias("_old_loaded"))
    wb = Window.partitionBy(*key).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_pmax", F.max("_bmax").over(wb))

    def stays(name):
        return F.col(name).isNotNull() & (F.col("_pmax").isNull() | (F.col(f"{name}.updated_at") >= F.col("_pmax")))

    g = blocks.groupBy(*key).agg(
        F.min_by("f", "_first").alias("f"),
        F.max_by("s", F.when(stays("s"), F.col("_blk"))).alias("s"),
        F.max_by("a.amount_approved", F.when(stays("a"), F.col("_blk"))).alias("amount_approved"),
        F.max_by("p.prior_auth_number", F.when(stays("p"), F.col("_blk"))).alias("prior_auth_number"),
        F.max(F.when(stays("n"), F.lit(1))).alias("_changed"),
        F.max("_old_loaded").alias("_old_loaded"))
    new = g.select(*key, "f.*", "amount_approved", "prior_auth_number", "s.status", "s.updated_at",
                   F.when(F.col("_changed") == 1, lit_ts(load_ts)).otherwise(F.col("_old_loaded")).alias("_loaded_at"))
    return rest.unionByName(new.select(*target.columns))


def claim_update_batch(c: DataFrame) -> DataFrame:
    """Replayed updates derived from the claims: newer, older (rejected by the
    guard), equal-timestamp and NULL-amount updates, plus two new claims."""
    k = F.split_part(F.col("claim_id"), F.lit("-"), F.lit(1)).cast("bigint")
    day = F.expr("INTERVAL 1 DAY")
    changed = ("claim_id", "member_id", "amount_approved", "prior_auth_number", "status", "updated_at", ARRIVAL)

    def update(every, arrival, **new):
        values = {ARRIVAL: F.lit(arrival)} | new
        return F.when(k % every == 0, F.struct(*[values.get(x, F.col(x)).alias(x) for x in changed]))

    money = "decimal(15,2)"
    reduced = F.round(F.col("amount_claimed") * F.lit(0.9).cast("decimal(2,1)"), 2).cast(money)
    again = F.concat("claim_id", F.lit("-n"))
    updates = F.array(
        update(5, 1, status=F.lit("approved"), updated_at=F.col("updated_at") + day, amount_approved=F.lit(None).cast(money)),
        update(10, 2, status=F.lit("rejected"), updated_at=F.col("updated_at") - day * 2),
        update(15, 3, status=F.lit("paid"), updated_at=F.col("updated_at") + day, amount_approved=reduced,
               prior_auth_number=F.lit("PA-LATE"), member_id=F.lit("ignored")),
        update(20, 1, claim_id=again),
        update(20, 2, claim_id=again, status=F.lit("pending_review"), updated_at=F.col("updated_at") - day))
    kept = [x for x in c.columns if x not in changed and x != "_loaded_at"]
    # 10, 15 and 20 are multiples of 5
    return c.where(k % 5 == 0).select(*kept, F.inline(F.filter(updates, lambda u: u.isNotNull())))


def _u03_sql() -> str:
    cols = ", ".join(CLAIM_COLS)

    def repl(s, **kw):
        parts = []
        for c in CLAIM_COLS:
            parts.append(f"{kw[c]} AS {c}" if c in kw else c)
        return ", ".join(parts)
    k = "CAST(split_part(claim_id, '-', 1) AS BIGINT)"
    b = ("WITH b AS ("
         f"SELECT {repl(0, status=chr(39)+'approved'+chr(39), updated_at='updated_at + INTERVAL 1 DAY', amount_approved='CAST(NULL AS DECIMAL(15,2))')}, 1 AS a FROM claims WHERE {k} % 5 = 0 UNION ALL "
         f"SELECT {repl(0, status=chr(39)+'rejected'+chr(39), updated_at='updated_at - INTERVAL 2 DAY')}, 2 FROM claims WHERE {k} % 10 = 0 UNION ALL "
         f"SELECT {repl(0, status=chr(39)+'paid'+chr(39), updated_at='updated_at + INTERVAL 1 DAY', amount_approved='CAST(round(amount_claimed * 0.9, 2) AS DECIMAL(15,2))', prior_auth_number=chr(39)+'PA-LATE'+chr(39), member_id=chr(39)+'ignored'+chr(39))}, 3 FROM claims WHERE {k} % 15 = 0 UNION ALL "
         f"SELECT {repl(0, claim_id='claim_id || ' + chr(39) + '-n' + chr(39))}, 1 FROM claims WHERE {k} % 20 = 0 UNION ALL "
         f"SELECT {repl(0, claim_id='claim_id || ' + chr(39) + '-n' + chr(39), status=chr(39)+'pending_review'+chr(39), updated_at='updated_at - INTERVAL 1 DAY')}, 2 FROM claims WHERE {k} % 20 = 0), "
         f"r AS (SELECT {cols}, -1 AS a, _loaded_at AS old_loaded FROM claims WHERE claim_id IN (SELECT claim_id FROM b) "
         f"UNION ALL SELECT {cols}, a, CAST(NULL AS TIMESTAMP) FROM b), "
         "r2 AS (SELECT *, (max(updated_at) OVER (PARTITION BY claim_id ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS pm FROM r), "
         "r3 AS (SELECT *, (pm IS NULL OR updated_at >= pm) AS acc FROM r2), ")
    fixed = [c for c in CLAIM_COLS if c not in MUTABLE and c != "claim_id"]
    g = ("g AS (SELECT claim_id, " + ", ".join(f"arg_min({c}, a) AS {c}" for c in fixed) + ", "
         "arg_max(status, CASE WHEN acc THEN a END) AS status, arg_max(updated_at, CASE WHEN acc THEN a END) AS updated_at, "
         "arg_max(amount_approved, CASE WHEN acc AND amount_approved IS NOT NULL THEN a END) AS amount_approved, "
         "arg_max(prior_auth_number, CASE WHEN acc AND prior_auth_number IS NOT NULL THEN a END) AS prior_auth_number, "
         f"CASE WHEN bool_or(acc AND a >= 0) THEN {LOAD_TS_SQL} ELSE max(old_loaded) END AS _loaded_at "
         "FROM r3 GROUP BY claim_id) ")
    outc = ", ".join(("CAST(" + c + " AS DOUBLE) AS " + c) if c in ("amount_claimed", "amount_approved") else c
                     for c in CLAIM_COLS + ["_loaded_at"])
    return (b + g + f"SELECT {outc} FROM claims WHERE claim_id NOT IN (SELECT claim_id FROM b) UNION ALL SELECT {outc} FROM g")


def u03_claims(rel) -> DataFrame:
    (claims,), by = dealt(rel, "claims")
    return upsert_claims(claims, claim_update_batch(claims), LOAD_TS, dealt=by).drop(*by)


register("upsert_u03_claims", sql=_u03_sql())(u03_claims)


# -------------------------------------------------------------- U04 events
def append_events(target: DataFrame, batch: DataFrame, arrival: str = ARRIVAL, dealt: tuple[str, ...] = ()) -> DataFrame:
    """Insert events whose id is new; the first arrival of a repeated id wins.

    Replays (the whole batch again, or a day twice) change nothing.  Stored ids are
    grouped with the batch, not joined to it.  ``dealt`` names columns of both that the
    event id determines and that their rows are dealt by already: with them in the keys
    no row is dealt again.
    """
    cols, key = target.columns, [*dealt, "event_id"]
    stored = target.where("event_id is not null").select(*key, F.lit(True).alias("_stored"))
    first = batch.unionByName(stored, allowMissingColumns=True).groupBy(*key).agg(
        F.min_by(F.struct(*[c for c in cols if c not in key]), arrival).alias("r"), F.max("_stored").alias("_stored"))
    return target.unionByName(first.where("_stored is null").select(*key, "r.*").select(*cols))


def _event_batch(e: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events of two thirds of the claims are stored; all arrive, those of the others twice."""
    k = F.split_part(F.col("claim_id"), F.lit("-"), F.lit(1)).cast("bigint")
    target = e.filter(k % 3 != 0)
    arrivals = F.array(F.struct(F.lit(1).alias(ARRIVAL), F.col("triggered_by").alias("_by")),
                       F.when(k % 3 == 0, F.struct(F.lit(2).alias(ARRIVAL), F.lit("api").alias("_by"))))
    batch = e.select("*", F.inline(F.filter(arrivals, lambda a: a.isNotNull()))).withColumn("triggered_by", F.col("_by")).drop("_by")
    return target, batch


@register("upsert_u04_events", sql=(
    "WITH t AS (SELECT * FROM claim_events WHERE CAST(split_part(claim_id, '-', 1) AS BIGINT) % 3 <> 0), "
    "b AS (SELECT *, 1 AS a FROM claim_events UNION ALL SELECT event_id, claim_id, event_type, previous_status, new_status, "
    "event_at, 'api', metadata, _loaded_at, 2 FROM claim_events WHERE CAST(split_part(claim_id, '-', 1) AS BIGINT) % 3 = 0), "
    "f AS (SELECT * EXCLUDE (a) FROM b QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY a) = 1) "
    "SELECT * FROM t UNION ALL SELECT * FROM f WHERE event_id NOT IN (SELECT event_id FROM t)"))
def u04_events(rel) -> DataFrame:
    (events,), by = dealt(rel, "claim_events")
    return append_events(*_event_batch(events), dealt=by).drop(*by)


# ----------------------------------------------------------- U05 formulary
FORMULARY_ITEM = ("array<struct<drug_code:string,drug_name:string,drug_class:string,is_essential_medicine:boolean,"
                  "is_controlled_substance:boolean,unit_cost_kes:decimal(10,2)>>")


def formulary_from_json(payloads: DataFrame, payload_col: str = "payload", seq_col: str = "seq") -> DataFrame:
    """JSON-array payloads -> one row per element, with its arrival order
    (payload sequence, then array position) so the last element of a code wins."""
    x = payloads.select(seq_col, F.posexplode(F.from_json(F.col(payload_col), FORMULARY_ITEM)).alias("pos", "d"))
    return x.select("d.*", F.struct(F.col(seq_col).alias("seq"), F.col("pos")).alias(ARRIVAL))


def refresh_formulary(target: DataFrame, payloads: DataFrame, load_ts: _dt.datetime) -> DataFrame:
    """Upsert every element; drugs absent from the payload stay (as the reference does)."""
    return upsert_latest(target, formulary_from_json(payloads), "drug_code", load_ts)


def formulary_payloads(rel) -> DataFrame:
    """One JSON array per part brand (derived from ``part``): prices up 5%, and
    each brand's array lists its first drug twice (second copy wins)."""
    p = rel.table("part").select("p_partkey", "p_name", "p_type", "p_size", "p_retailprice", "p_brand")
    item = F.struct(F.col("p_partkey").cast("string").alias("drug_code"), F.col("p_name").alias("drug_name"),
                    F.col("p_type").alias("drug_class"), (F.col("p_size") % 2 == 0).alias("is_essential_medicine"),
                    (F.col("p_size") == 1).alias("is_controlled_substance"),
                    F.round(F.col("p_retailprice") * 1.05, 2).cast("decimal(10,2)").alias("unit_cost_kes"))
    g = p.filter(F.col("p_partkey") % 4 == 0).groupBy("p_brand").agg(
        F.sort_array(F.collect_list(F.struct(F.col("p_partkey").alias("k"), item.alias("i")))).alias("xs"))
    arr = F.transform(F.col("xs"), lambda x: x["i"])
    again = F.struct(F.col("xs")[0]["i"]["drug_code"].alias("drug_code"), F.lit("REPEATED").alias("drug_name"),
                     F.col("xs")[0]["i"]["drug_class"].alias("drug_class"),
                     F.col("xs")[0]["i"]["is_essential_medicine"].alias("is_essential_medicine"),
                     F.col("xs")[0]["i"]["is_controlled_substance"].alias("is_controlled_substance"),
                     F.col("xs")[0]["i"]["unit_cost_kes"].alias("unit_cost_kes"))
    return g.select(F.regexp_extract("p_brand", r"(\d+)", 1).cast("int").alias("seq"),
                    F.to_json(F.concat(arr, F.array(again))).alias("payload"))


@register("upsert_u05_formulary", sql=(
    "WITH it AS (SELECT CAST(p_partkey AS VARCHAR) AS drug_code, p_name AS drug_name, p_type AS drug_class, "
    "p_size % 2 = 0 AS is_essential_medicine, p_size = 1 AS is_controlled_substance, "
    "CAST(round(p_retailprice * 1.05, 2) AS DECIMAL(10,2)) AS unit_cost_kes, "
    "CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INTEGER) AS seq, "
    "row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS pos FROM part WHERE p_partkey % 4 = 0), "
    "rep AS (SELECT drug_code, 'REPEATED' AS drug_name, drug_class, is_essential_medicine, is_controlled_substance, "
    "unit_cost_kes, seq, (SELECT COUNT(*) FROM it i2 WHERE i2.seq = it.seq) AS pos FROM it WHERE pos = 0), "
    "b AS (SELECT * FROM it UNION ALL SELECT * FROM rep), "
    "n AS (SELECT * EXCLUDE (seq, pos) FROM b QUALIFY row_number() OVER (PARTITION BY drug_code ORDER BY seq * 1000000 + pos DESC) = 1) "
    "SELECT drug_code, drug_name, drug_class, is_essential_medicine, is_controlled_substance, "
    "CAST(unit_cost_kes AS DOUBLE) AS unit_cost_kes, _loaded_at FROM drug_formulary f "
    "WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.drug_code = f.drug_code) UNION ALL "
    f"SELECT drug_code, drug_name, drug_class, is_essential_medicine, is_controlled_substance, "
    f"CAST(unit_cost_kes AS DOUBLE), {LOAD_TS_SQL} FROM n"))
def u05_formulary(rel) -> DataFrame:
    return refresh_formulary(rel.drug_formulary, formulary_payloads(rel), LOAD_TS)


@register("upsert_u05_refresh_count", sql=(
    "SELECT COUNT(*) AS upserted FROM part WHERE p_partkey % 4 = 0"))
def u05_count(rel) -> DataFrame:
    """The refresh's returned count: distinct drugs upserted."""
    return formulary_from_json(formulary_payloads(rel)).agg(F.count_distinct("drug_code").alias("upserted"))


# -------------------------------------------------- U06 auto-open cases
def auto_open_investigations(predictions: DataFrame, investigations: DataFrame, as_of: _dt.datetime,
                             assigned_to: str = "system", one_per_claim: bool = False) -> DataFrame:
    """New 'open' cases for predictions > 0.80 of the last 30 days whose claim
    has no case that is still open.  One case per prediction (as the
    reference); ``one_per_claim`` keeps only the highest-probability one.
    Ids are deterministic hashes so a rerun produces the same rows."""
    p = predictions.filter((F.col("fraud_probability") > K.AUTO_OPEN_PROBABILITY)
                           & (F.col("predicted_at") >= lit_ts(as_of - _dt.timedelta(days=30))))
    open_cases = investigations.filter(F.col("status") != "closed").select("claim_id")
    p = p.join(open_cases, "claim_id", "left_anti")
    if one_per_claim:
        p = p.groupBy("claim_id").agg(F.max_by(F.struct("prediction_id", "fraud_probability"),
                                               F.struct("fraud_probability", "prediction_id")).alias("b")) \
            .select("claim_id", "b.*")
    return p.select(stable_id("INV-", F.col("prediction_id")).alias("investigation_id"), "claim_id", "prediction_id",
                    F.lit(assigned_to).alias("assigned_to"), lit_ts(as_of).alias("opened_at"),
                    F.lit(None).cast("timestamp_ntz").alias("closed_at"), F.lit("open").alias("status"),
                    priority_of("fraud_probability").alias("priority"), F.lit(None).cast("string").alias("notes"),
                    lit_ts(as_of).alias("_loaded_at"))


def mark_under_investigation(claims: DataFrame, opened: DataFrame, as_of: _dt.datetime) -> DataFrame:
    """Claims with a newly opened case -> under_investigation (unless already
    under_investigation, closed or paid); updated_at = as_of."""
    hit = opened.select("claim_id").distinct().withColumn("_hit", F.lit(True))
    c = claims.join(hit, "claim_id", "left")
    move = F.col("_hit").isNotNull() & ~F.col("status").isin("under_investigation", "closed", "paid")
    return c.select(*[F.when(move, F.lit("under_investigation")).otherwise(F.col("status")).alias("status") if x == "status"
                      else F.when(move, lit_ts(as_of)).otherwise(F.col("updated_at")).alias("updated_at") if x == "updated_at"
                      else F.col(x) for x in claims.columns])


def _prio_sql(p: str) -> str:
    hi, crit = K.PRIORITY_CUTS
    return f"CASE WHEN {p} >= {crit} THEN 'critical' WHEN {p} >= {hi} THEN 'high' ELSE 'medium' END"


_OPEN_SQL = (
    "SELECT 'INV-' || substr(sha256(prediction_id), 1, 16) AS investigation_id, claim_id, prediction_id, "
    f"'system' AS assigned_to, {K.AS_OF_SQL} AS opened_at, CAST(NULL AS TIMESTAMP) AS closed_at, 'open' AS status, "
    f"{_prio_sql('fraud_probability')} AS priority, CAST(NULL AS VARCHAR) AS notes, {K.AS_OF_SQL} AS _loaded_at "
    f"FROM fraud_predictions fp WHERE fraud_probability > {K.AUTO_OPEN_PROBABILITY} "
    f"AND predicted_at >= {K.AS_OF_SQL} - INTERVAL 30 DAY AND NOT EXISTS (SELECT 1 FROM fraud_investigations i "
    "WHERE i.claim_id = fp.claim_id AND i.status <> 'closed')")
register("upsert_u06_open_cases", sql=_OPEN_SQL)(
    lambda rel: auto_open_investigations(rel.fraud_predictions, rel.fraud_investigations, K.AS_OF))


@register("upsert_u06_count", sql=f"SELECT COUNT(*) AS opened FROM ({_OPEN_SQL})")
def u06_count(rel) -> DataFrame:
    return auto_open_investigations(rel.fraud_predictions, rel.fraud_investigations, K.AS_OF) \
        .agg(F.count(F.lit(1)).alias("opened"))


@register("upsert_u06_claims", sql=(
    f"WITH o AS ({_OPEN_SQL}) SELECT claim_id, CASE WHEN claim_id IN (SELECT claim_id FROM o) AND status NOT IN "
    "('under_investigation', 'closed', 'paid') THEN 'under_investigation' ELSE status END AS status, "
    "CASE WHEN claim_id IN (SELECT claim_id FROM o) AND status NOT IN ('under_investigation', 'closed', 'paid') "
    f"THEN {K.AS_OF_SQL} ELSE updated_at END AS updated_at FROM claims"))
def u06_claims(rel) -> DataFrame:
    opened = auto_open_investigations(rel.fraud_predictions, rel.fraud_investigations, K.AS_OF)
    return mark_under_investigation(rel.claims, opened, K.AS_OF).select("claim_id", "status", "updated_at")


# --------------------------------------------------- U07 close stale cases
STALE_NOTE = " [auto-closed: stale]"


def close_stale_investigations(investigations: DataFrame, as_of: _dt.datetime, days: int = K.STALE_CASE_DAYS) -> DataFrame:
    """open / in_progress cases opened more than ``days`` ago -> closed at ``as_of``."""
    stale = F.col("status").isin("open", "in_progress") & (F.col("opened_at") < lit_ts(as_of - _dt.timedelta(days=days)))
    out = []
    for c in investigations.columns:
        if c == "status":
            out.append(F.when(stale, F.lit("closed")).otherwise(F.col(c)).alias(c))
        elif c == "closed_at":
            out.append(F.when(stale, lit_ts(as_of)).otherwise(F.col(c)).alias(c))
        elif c == "notes":
            out.append(F.when(stale, F.concat(F.coalesce(F.col(c), F.lit("")), F.lit(STALE_NOTE))).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return investigations.select(*out)


_STALE = (f"status IN ('open', 'in_progress') AND opened_at < {K.AS_OF_SQL} - INTERVAL {K.STALE_CASE_DAYS} DAY")
register("upsert_u07_close_stale", sql=(
    f"SELECT investigation_id, claim_id, prediction_id, assigned_to, opened_at, "
    f"CASE WHEN {_STALE} THEN {K.AS_OF_SQL} ELSE closed_at END AS closed_at, "
    f"CASE WHEN {_STALE} THEN 'closed' ELSE status END AS status, priority, "
    f"CASE WHEN {_STALE} THEN coalesce(notes, '') || '{STALE_NOTE}' ELSE notes END AS notes, _loaded_at "
    "FROM fraud_investigations"))(lambda rel: close_stale_investigations(rel.fraud_investigations, K.AS_OF))


@register("upsert_u07_count", sql=f"SELECT COUNT(*) AS closed FROM fraud_investigations WHERE {_STALE}")
def u07_count(rel) -> DataFrame:
    i = rel.fraud_investigations
    stale = F.col("status").isin("open", "in_progress") & \
        (F.col("opened_at") < lit_ts(K.AS_OF - _dt.timedelta(days=K.STALE_CASE_DAYS)))
    return i.agg(F.count_if(stale).alias("closed"))


# ------------------------------------------------------ U08 verdicts
def record_verdicts(outcomes: DataFrame, investigations: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Validated append of verdict rows -> (accepted, rejected with reason).

    Rejected: unknown case, case already has an outcome, second verdict for a
    case in the same batch, a loss on a label other than confirmed_fraud.
    """
    inv = investigations.select("investigation_id", F.col("claim_id").alias("_case_claim")).withColumn("_known", F.lit(True))
    done = outcomes.select("investigation_id").distinct().withColumn("_done", F.lit(True))
    # the first verdict per case by an aggregate (partial per task), not a window over the case
    first = batch.groupBy("investigation_id").agg(F.min_by("outcome_id", F.struct("confirmed_at", "outcome_id")).alias("_first"))
    b = batch.join(first, "investigation_id", "left") \
        .withColumn("_rank", F.when(F.col("outcome_id") == F.col("_first"), 1).otherwise(2)) \
        .join(inv, "investigation_id", "left").join(done, "investigation_id", "left")
    reason = (F.when(F.col("_known").isNull(), "unknown investigation")
              .when(F.col("_done").isNotNull(), "investigation already has an outcome")
              .when(F.col("_rank") > 1, "second verdict in the batch")
              .when(F.col("estimated_loss_kes").isNotNull() & (F.col("final_label") != "confirmed_fraud"),
                    "loss recorded on a label other than confirmed_fraud"))
    b = b.withColumn("reject_reason", reason)
    cols = outcomes.columns
    accepted = b.filter(F.col("reject_reason").isNull()).select(*cols)
    rejected = b.filter(F.col("reject_reason").isNotNull()).select(*cols, "reject_reason")
    return accepted, rejected


def _verdict_batch(rel) -> DataFrame:
    """Verdicts for the cases that are still open (derived), plus a replay of
    existing outcomes (must be rejected)."""
    i = rel.fraud_investigations.filter(F.col("status") != "closed")
    k = F.split_part(F.col("claim_id"), F.lit("-"), F.lit(1)).cast("bigint")
    v = i.select(F.concat(F.lit("OUT2-"), F.col("investigation_id")).alias("outcome_id"), "claim_id", "investigation_id",
                 F.when(k % 2 == 0, "confirmed_fraud").otherwise("legitimate").alias("final_label"),
                 F.when(k % 2 == 0, "other").alias("fraud_type"), F.lit("investigator_9").alias("confirmed_by"),
                 lit_ts(K.AS_OF).alias("confirmed_at"),
                 F.when(k % 3 == 0, F.lit(1000).cast("decimal(15,2)")).alias("estimated_loss_kes"),
                 F.lit(None).cast("decimal(15,2)").alias("amount_recovered_kes"), F.lit(None).cast("string").alias("notes"),
                 lit_ts(K.AS_OF).alias("_loaded_at"))
    return v.unionByName(rel.fraud_investigation_outcomes)


_VERDICT_SQL = (
    "WITH v AS (SELECT 'OUT2-' || investigation_id AS outcome_id, claim_id, investigation_id, "
    "CASE WHEN CAST(split_part(claim_id, '-', 1) AS BIGINT) % 2 = 0 THEN 'confirmed_fraud' ELSE 'legitimate' END AS final_label, "
    "CASE WHEN CAST(split_part(claim_id, '-', 1) AS BIGINT) % 2 = 0 THEN 'other' END AS fraud_type, "
    f"'investigator_9' AS confirmed_by, {K.AS_OF_SQL} AS confirmed_at, "
    "CASE WHEN CAST(split_part(claim_id, '-', 1) AS BIGINT) % 3 = 0 THEN CAST(1000 AS DECIMAL(15,2)) END AS estimated_loss_kes, "
    "CAST(NULL AS DECIMAL(15,2)) AS amount_recovered_kes, CAST(NULL AS VARCHAR) AS notes, "
    f"{K.AS_OF_SQL} AS _loaded_at FROM fraud_investigations WHERE status <> 'closed' UNION ALL "
    "SELECT * FROM fraud_investigation_outcomes), "
    "r AS (SELECT v.*, row_number() OVER (PARTITION BY v.investigation_id ORDER BY confirmed_at, outcome_id) AS rk, "
    "EXISTS (SELECT 1 FROM fraud_investigations i WHERE i.investigation_id = v.investigation_id) AS known, "
    "EXISTS (SELECT 1 FROM fraud_investigation_outcomes o WHERE o.investigation_id = v.investigation_id) AS done FROM v), "
    "x AS (SELECT *, CASE WHEN NOT known THEN 'unknown investigation' WHEN done THEN 'investigation already has an outcome' "
    "WHEN rk > 1 THEN 'second verdict in the batch' WHEN estimated_loss_kes IS NOT NULL AND final_label <> 'confirmed_fraud' "
    "THEN 'loss recorded on a label other than confirmed_fraud' END AS reject_reason FROM r) ")


@register("upsert_u08_accepted", sql=_VERDICT_SQL + (
    "SELECT outcome_id, claim_id, investigation_id, final_label, fraud_type, confirmed_by, confirmed_at, "
    "CAST(estimated_loss_kes AS DOUBLE) AS estimated_loss_kes, CAST(amount_recovered_kes AS DOUBLE) AS amount_recovered_kes, "
    "notes, _loaded_at FROM x WHERE reject_reason IS NULL"))
def u08_accepted(rel) -> DataFrame:
    return record_verdicts(rel.fraud_investigation_outcomes, rel.fraud_investigations, _verdict_batch(rel))[0]


@register("upsert_u08_rejected", sql=_VERDICT_SQL + (
    "SELECT reject_reason, COUNT(*) AS n FROM x WHERE reject_reason IS NOT NULL GROUP BY reject_reason"))
def u08_rejected(rel) -> DataFrame:
    rej = record_verdicts(rel.fraud_investigation_outcomes, rel.fraud_investigations, _verdict_batch(rel))[1]
    return rej.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------- U10 provider risk
def provider_risk_scores(providers: DataFrame, claims: DataFrame, outcomes: DataFrame,
                         prior_weight: float = 5.0) -> DataFrame:
    """Weekly risk score per provider (*decision*): confirmed-fraud outcomes
    over investigated outcomes, shrunk toward the global rate with
    ``prior_weight`` pseudo-outcomes, clipped to [0, 1], rounded to 3."""
    o = outcomes.select("claim_id", (F.col("final_label") == "confirmed_fraud").cast("int").alias("fraud")) \
        .join(claims.select("claim_id", "provider_id"), "claim_id")
    per = o.groupBy("provider_id").agg(F.count(F.lit(1)).alias("outcomes"), F.sum("fraud").alias("confirmed"))
    glob = o.agg(F.avg("fraud").alias("g"))
    score = (F.col("confirmed") + F.lit(prior_weight) * F.col("g")) / (F.col("outcomes") + F.lit(prior_weight))
    s = per.crossJoin(F.broadcast(glob)).select("provider_id", "outcomes", "confirmed",
                                                F.round(F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)), 3).alias("risk_score"))
    return providers.select("provider_id").join(s, "provider_id", "left") \
        .select("provider_id", F.coalesce("outcomes", F.lit(0)).alias("outcomes"),
                F.coalesce("confirmed", F.lit(0)).alias("confirmed"), "risk_score")


@register("upsert_u10_risk_score", sql=(
    "WITH o AS (SELECT c.provider_id, CASE WHEN x.final_label = 'confirmed_fraud' THEN 1 ELSE 0 END AS fraud "
    "FROM fraud_investigation_outcomes x JOIN claims c ON c.claim_id = x.claim_id), "
    "per AS (SELECT provider_id, COUNT(*) AS outcomes, SUM(fraud) AS confirmed FROM o GROUP BY provider_id), "
    "g AS (SELECT AVG(fraud) AS g FROM o) "
    "SELECT p.provider_id, COALESCE(per.outcomes, 0) AS outcomes, COALESCE(per.confirmed, 0) AS confirmed, "
    "round(least(greatest((per.confirmed + 5.0 * g.g) / (per.outcomes + 5.0), 0.0), 1.0), 3) AS risk_score "
    "FROM providers p LEFT JOIN per ON per.provider_id = p.provider_id CROSS JOIN g"))
def u10_risk(rel) -> DataFrame:
    return provider_risk_scores(rel.providers, rel.claims, rel.fraud_investigation_outcomes)


# ------------------------------------------------- touched-bucket rewrites
class BucketedTable:
    """A large keyed table in ``buckets`` = ``pmod(xxhash64(key), n)``; an upsert
    rewrites only the buckets the batch touches.

    Layout: ``data/v=NNNNNN/bucket=B`` holds bucket B as version N wrote it, and
    ``manifest/v=NNNNNN`` lists the version of every bucket.  ``merge`` writes the
    touched buckets as a new data version and then one manifest; the manifest's
    commit is the swap, so readers see all of a merge or nothing, and a failed
    merge leaves the old state.  Reads and folds prune to the touched buckets, so
    a micro-batch costs what it touches.

    The number of buckets is chosen when the table is created, from its rows
    (``rows_per_bucket``), and kept in the manifest.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int | None = None, rows_per_bucket: int = 2_000_000):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self._buckets, self.rows_per_bucket = buckets, rows_per_bucket
        self.store = Store(spark, self.path)

    def _versions(self) -> list[int]:
        return [int(n[2:]) for n in self.store.children(f"{self.path}/manifest")
                if n.startswith("v=") and self.store.exists(f"{self.path}/manifest/{n}/_SUCCESS")]

    def current_version(self) -> int | None:
        return max(self._versions(), default=None)

    def exists(self) -> bool:
        return self.current_version() is not None

    def manifest(self) -> dict[int, int]:
        """Bucket -> data version (at most ``buckets`` entries); bucket -1 holds the number of buckets."""
        rows = self.spark.read.parquet(f"{self.path}/manifest/v={self.current_version():06d}").collect()
        return {r["bucket"]: r["version"] for r in rows}

    def _read(self, manifest: dict[int, int], only: set[int] | None = None) -> DataFrame | None:
        paths = [f"{self.path}/data/v={v:06d}/bucket={b}" for b, v in sorted(manifest.items()) if b >= 0 and (only is None or b in only)]
        return self.spark.read.parquet(*paths) if paths else None

    def read(self) -> DataFrame:
        return self._read(self.manifest())

    def _commit(self, df: DataFrame, manifest: dict[int, int], buckets: int) -> None:
        v = (self.current_version() or 0) + 1
        out = f"{self.path}/data/v={v:06d}"
        bucket = F.pmod(F.xxhash64(F.col(self.key)), F.lit(buckets)).cast("int")
        # rebalance: one bucket per task, and several tasks for a large one
        df.withColumn("bucket", bucket).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(out)
        written = {int(n[7:]): v for n in self.store.children(out) if n.startswith("bucket=")}
        rows = sorted((manifest | written | {-1: buckets}).items())
        self.spark.createDataFrame(rows, "bucket int, version int").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/v={v:06d}")

    def write_all(self, df: DataFrame) -> None:
        buckets = self._buckets or max(1, -(-df.count() // self.rows_per_bucket))
        self._commit(df, {}, buckets)

    def merge(self, batch: DataFrame, fold) -> None:
        if not self.exists():
            self.write_all(fold(batch.limit(0).drop("_arrival"), batch))
            return
        manifest = self.manifest()
        buckets = manifest[-1]
        touched = {r[0] for r in batch.select(F.pmod(F.xxhash64(F.col(self.key)), F.lit(buckets)).cast("int")).distinct().collect()}  # at most ``buckets``
        if not touched:
            return
        cur = self._read(manifest, touched)
        self._commit(fold(cur if cur is not None else self.read().limit(0), batch), manifest, buckets)

    def vacuum(self) -> None:
        """Remove manifests but the last and the bucket folders it does not name."""
        last, live = self.current_version(), self.manifest()
        for v in self._versions():
            if v != last:
                self.store.delete(f"{self.path}/manifest/v={v:06d}")
        for n in self.store.children(f"{self.path}/data"):
            for b in self.store.children(f"{self.path}/data/{n}"):
                if b.startswith("bucket=") and live.get(int(b[7:])) != int(n[2:]):
                    self.store.delete(f"{self.path}/data/{n}/{b}")
