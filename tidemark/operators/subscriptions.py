"""Daily subscription state, transition flags and period-to-date flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import exists, local_date, local_datetime, rounded_long
from tidemark.operators.cancellations import BUSINESS_ZONE
from tidemark.operators.intervals import expand_days, nearest_pauses
from tidemark.operators.keys import latest_per_key, left_join
from tidemark.session import cut_lineage

# Protocols without renewals, the product with its own first term
# and the day that term came in, and products reported under another name.
NO_RENEWALS = ("Growth Hormone", "Mood, Stress & Sleep")
STARTER_PACK = "Weight Loss Semaglutide Starter Pack"
STARTER_PACK_SINCE = "2025-06-10"
STARTER_PACK_DAYS = 105
ENCLOMIPHENE_PRODUCTS = ("Testosterone E/P", "Testosterone Enclo", "Testosterone Enclo+")
ENCLOMIPHENE = "Enclomiphene"
GRACE_DAYS = 5
OLD_AFTER_MONTHS = 18

_SPOT = ["admin_user_id", "protocol", "date_day"]


def _months_between_days(later: str, earlier: str) -> Column:
    return F.round(F.datediff(later, earlier) / F.lit(30.0), 2)


def _within_term(day: str) -> Column:
    """The event day lies in the subscription's own validity."""
    return (F.col(day) >= F.col("start_date_pst")) & (
        F.col("next_start_date_pst").isNull() | (F.col(day) < F.col("next_start_date_pst"))
    )


def _attach(state: DataFrame, daily: DataFrame, keys: Sequence[str], event_day: str, salt: str, *extra: Column):
    """Left join on ``keys``; days without one of them are spread over the tasks, alike for all joins of one ``salt``."""
    condition = _within_term(event_day)
    for predicate in extra:
        condition = condition & predicate
    return left_join(state, daily, keys, ["uuid", "date_day", "subscription_sequence"], condition, salt=salt)


def subscription_daily(
    subscriptions: DataFrame,
    pause_days: DataFrame,
    cancel_days: DataFrame,
    billing_days: DataFrame,
    renewal_days: DataFrame,
    order_days: DataFrame,
    calendar: DataFrame,
    as_of: Column,
) -> DataFrame:
    """One row per subscription and day with everything known about that day.

    Subscriptions are expanded to their own days (up to ``as_of``) and the daily
    inputs meet them by equality on user, protocol and day; that an event belongs
    to the subscription's term is a condition on top. Five of the six joins use
    the same three keys, so the expanded frame is shuffled once for them. Days of an
    unknown user or protocol match nothing and are spread over the tasks.
    """
    spine = expand_days(
        subscriptions, "start_date_pst", ["next_start_date_pst"], calendar, day="date_day", last=as_of
    ).withColumn("current_date_pst", as_of)

    pauses = pause_days.select(
        *_SPOT, "pause_created_at_dt_pst", "pause_at", "resume_at", F.lit(True).alias("_paused")
    )
    # Announced and active cancellations are two faces of the same daily table.
    cancels = cancel_days.withColumnRenamed("day_date", "date_day")
    active = cancels.filter("actively_cancelled").select(
        *_SPOT,
        F.col("cancellation_created_at").alias("_c_created"),
        F.col("cancelled_at").alias("_c_at"),
        F.col("cancelled_at_dt_pst").alias("_c_day"),
        F.col("cancelled_at_pst").alias("_c_local"),
        F.col("is_autocancel").alias("_c_auto"),
        F.col("system_cancellation_reason").alias("_c_reason"),
        F.lit(True).alias("_cancelled"),
    )
    announced = cancels.filter("cancelled_in_future").select(
        *_SPOT,
        F.col("future_cancel_created_at").alias("_f_created"),
        F.col("future_cancel_created_dt_pst").alias("_f_created_day"),
        F.col("future_cancel_scheduled_for").alias("_f_at"),
        F.col("future_cancel_scheduled_for_dt_pst").alias("_f_day"),
        F.col("cancelled_at_pst").alias("_f_local"),
        F.col("future_cancel_is_autocancel").alias("_f_auto"),
        F.col("future_cancel_system_cancellation_reason").alias("_f_reason"),
        F.lit(True).alias("_announced"),
    )
    billing = billing_days.select(
        "admin_user_id", "date_day", "billing_issue_from", "billing_issue_from_date_pst",
        F.lit(True).alias("_billing"),
    )
    renewals = renewal_days.filter(~F.col("protocol").isin(*NO_RENEWALS)).select(
        *_SPOT, "created_at_dt_pst", "active_mm_plan", "active_plan_days"
    )
    orders = order_days.select(
        *_SPOT,
        F.col("subscription_sequence").alias("_order_sequence"),
        "admin_email",
        "product_category_2",
        "mm_plan",
        F.col("order_transaction_date").alias("last_transaction_date"),
        F.col("order_transaction_dt").alias("last_transaction_dt"),
        "billing_cycle_days",
        "is_bnpl",
        "is_bnpl_fod",
        "contains_bb",
        "contains_appt",
    )
    # As a difference the sequence stays out of the hash keys, which keeps all
    # five joins on one partitioning.
    same_sequence = F.col("_order_sequence") - F.col("subscription_sequence") == 0

    joined = _attach(spine, billing, ["admin_user_id", "date_day"], "billing_issue_from_date_pst", "_user_salt")
    joined = _attach(joined, pauses, _SPOT, "pause_created_at_dt_pst", "_spot_salt")
    joined = _attach(joined, active, _SPOT, "_c_day", "_spot_salt")
    joined = _attach(joined, announced, _SPOT, "_f_created_day", "_spot_salt")
    joined = _attach(joined, renewals, _SPOT, "created_at_dt_pst", "_spot_salt")
    joined = _attach(joined, orders, _SPOT, "last_transaction_dt", "_spot_salt", same_sequence)

    day, order_day = F.col("date_day"), F.col("last_transaction_dt")
    since_order = F.datediff(day, order_day)
    plan, renewed = F.col("mm_plan"), F.col("active_mm_plan")
    is_cancelled = F.col("_cancelled").isNotNull() | F.col("_announced").isNotNull()

    still_paid = (
        (renewed.isNotNull() & (since_order <= F.col("active_plan_days")))
        | ((plan == 3) & (since_order <= 90))
        | ((plan == 12) & (since_order <= 365))
        | (~plan.isin(3, 12) & (since_order <= plan * 30))
    )
    ends_on = (
        F.when(is_cancelled, F.lit(None).cast("date"))
        .when(
            (F.col("product_category_2") == STARTER_PACK)
            & (order_day > F.lit(STARTER_PACK_SINCE).cast("date")),
            F.date_add(order_day, STARTER_PACK_DAYS),
        )
        .when(F.col("is_bnpl") == "Yes", F.add_months(order_day, 1))
        .when(renewed.isNotNull(), F.add_months(order_day, renewed.cast("int")))
        .when(
            F.col("billing_cycle_days").isNotNull(),
            F.date_add(order_day, F.col("billing_cycle_days").cast("int")),
        )
        .otherwise(F.add_months(order_day, F.coalesce(plan, F.lit(1)).cast("int")))
    )
    tenure = (
        F.when(F.col("_c_day") <= day, _months_between_days("_c_day", "start_date_pst"))
        .when(
            F.col("_billing").isNotNull(),
            _months_between_days("billing_issue_from_date_pst", "start_date_pst"),
        )
        .otherwise(_months_between_days("date_day", "start_date_pst"))
    )
    derived = {
        "subscription_length": F.coalesce(renewed, plan, F.lit(1)),
        "subscription_cancelled": F.coalesce("_c_created", "_f_created"),
        "intended_cancellation_date": F.coalesce("_c_at", "_f_at"),
        "intended_cancellation_dt_pst": F.coalesce("_c_day", "_f_day"),
        "intended_cancellation_pst": F.coalesce("_c_local", "_f_local"),
        "is_autocancel": F.coalesce("_c_auto", "_f_auto"),
        "system_cancellation_reason": F.coalesce("_c_reason", "_f_reason"),
        "has_future_intended_cancellation": exists(day < F.col("_f_day")),
        "is_paused": F.col("_paused").isNotNull(),
        "is_cancelled": is_cancelled,
        "is_cancelled_today": F.col("_cancelled").isNotNull(),
        "has_billing_issue": F.col("_billing").isNotNull(),
        "is_active_past_renewal": exists(still_paid),
        "has_old_transaction": exists(order_day < F.add_months(day, -OLD_AFTER_MONTHS)),
        "renewal_or_end_date": ends_on.cast("timestamp"),
        "has_transaction_within_past_year": exists(since_order <= 365),
        "billing_issue_unresolved": F.col("billing_issue_from"),
        "tenure_months": tenure,
    }
    helpers = [c for c in joined.columns if c.startswith("_")] + [
        "billing_issue_from", "billing_issue_from_date_pst", "pause_created_at_dt_pst",
        "created_at_dt_pst", "active_plan_days",
    ]
    return joined.withColumns(derived).drop(*helpers)


_TIE_BREAK = (
    "subscription_cancelled",
    "intended_cancellation_date",
    "intended_cancellation_dt_pst",
    "is_cancelled_today",
    "has_future_intended_cancellation",
    "is_autocancel",
    "system_cancellation_reason",
    "billing_issue_unresolved",
    "pause_at",
    "resume_at",
    "last_transaction_date",
    "active_mm_plan",
    "mm_plan",
    "product_category_2",
    "billing_cycle_days",
    "is_bnpl",
    "is_bnpl_fod",
    "contains_bb",
    "contains_appt",
    "admin_email",
    "renewal_or_end_date",
    "tenure_months",
)


def _packed(rows: DataFrame, keep: Sequence[str], **structs: Sequence[str]) -> DataFrame:
    """``rows`` with every column but ``keep`` inside a struct: the named ones, then ``_row`` with the rest.

    What an exchange, a sort or a window only passes on is copied as one value this way, where
    dozens of columns are taken apart and put together again one by one at each of them.
    """
    inside = {name: [c for c in columns if c in rows.columns] for name, columns in structs.items()}
    placed = {*keep, *(c for columns in inside.values() for c in columns)}
    inside["_row"] = [c for c in rows.columns if c not in placed]
    return rows.select(*keep, *[F.struct(*columns).alias(name) for name, columns in inside.items() if columns])


def _unpacked(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``columns`` in their order, wherever they are, and after them what was added since."""
    structs = [name for name in ("_ties", "_row") if name in rows.columns]
    where = {c: F.col(name)[c].alias(c) for name in structs for c in rows.schema[name].dataType.names}
    added = [c for c in rows.columns if c not in columns and c not in structs]
    return rows.select(*[where.get(c, F.col(c)) for c in columns], *added)


def _yesterday(partition: Sequence[str]) -> Window:
    day_number = F.datediff("date_day", F.lit("1970-01-01").cast("date"))
    return Window.partitionBy(*partition).orderBy(day_number).rangeBetween(-1, -1)


def day_over_day_flags(
    state: DataFrame, pauses: DataFrame, calendar: DataFrame, as_of: Column | None = None
) -> DataFrame:
    """What changed since yesterday, nearest pauses, first days of users.

    Pauses are resolved and rows reduced to one per (day, user, protocol,
    sequence) before any flag is set, so a first-day flag cannot be lost with a
    duplicate. All windows here and in the period flags start from the user, so
    they share one shuffle. Rows without a user are one user to a window; they are set
    aside, and their first days are found by aggregates, which no task does alone. The
    rows are written once for these readers.
    """
    terms = ["start_date_pst", "next_start_date_pst", "subscription_sequence", "uuid"]
    packed = _packed(state, [*_SPOT, *terms], _ties=_TIE_BREAK)
    paused = nearest_pauses(packed, pauses, calendar, as_of)
    unique = latest_per_key(
        paused,
        ["date_day", "admin_user_id", "protocol", "subscription_sequence"],
        [
            F.col("past_paused_at").desc_nulls_last(),
            F.col("future_paused_at").asc_nulls_first(),
            # Two products of one protocol give a day several rows of one subscription. A struct
            # is ordered by its fields, nulls first.
            *[F.col(c).asc_nulls_first() for c in ("uuid", "_ties") if c in paused.columns],
        ],
    )
    unique = cut_lineage(_unpacked(unique, [*_SPOT, *(c for c in state.columns if c not in _SPOT)]))
    flagged_by = [*_FIRST_IN["user"], "admin_user_id", "is_cancelled_today", "is_paused"]
    named = _packed(unique.filter(F.col("admin_user_id").isNotNull()), flagged_by)
    nameless = unique.filter(F.col("admin_user_id").isNull())

    user = Window.partitionBy("admin_user_id").orderBy(*_FIRST_IN["user"])
    user_protocol = Window.partitionBy("admin_user_id", "protocol").orderBy(*_FIRST_IN["protocol"])
    # The user's own window first: its partitioning serves the finer ones.
    named = named.withColumn("is_new_user", F.row_number().over(user) == 1)
    named = named.withColumn("is_new_protocol_user", F.row_number().over(user_protocol) == 1)

    in_all, in_protocol = (F.struct(*_FIRST_IN[k]) for k in ("user", "protocol"))
    first = nameless.agg(F.min(in_all).alias("first")).scalar()
    firsts = nameless.groupBy(F.col("protocol").alias("_protocol")).agg(F.min(in_protocol).alias("_first"))
    nameless = nameless.join(firsts, F.col("protocol").eqNullSafe(F.col("_protocol")), "left")
    nameless = nameless.withColumn("is_new_user", in_all.eqNullSafe(first))
    nameless = nameless.withColumn("is_new_protocol_user", in_protocol.eqNullSafe(F.col("_first"))).drop("_protocol", "_first")
    spread = F.when(F.col("uuid").isNull(), F.xxhash64("date_day", "protocol", "subscription_sequence"))
    nameless = nameless.withColumn("_spread", spread)

    flagged = _unpacked(_against_yesterday(named, ["admin_user_id", "uuid"]), unique.columns).unionByName(
        _against_yesterday(nameless, ["uuid", "_spread"]).drop("_spread")
    )
    return flagged.withColumns(
        {
            "is_past_renewal_date": exists(
                F.col("date_day") > F.date_add(F.to_date("renewal_or_end_date"), GRACE_DAYS)
            ),
            "has_plan_change": exists(F.col("active_mm_plan") != F.col("subscription_length")),
            "cancellation_reason": F.when(F.col("is_cancelled"), "voluntary").when(
                F.col("has_billing_issue")
                & (F.col("billing_issue_unresolved") > F.col("last_transaction_date")),
                "billing_issue",
            ),
        }
    )


#: Orders in which a user's, and a user's and protocol's, first day is the first; total within each.
_FIRST_IN = {
    "user": ("date_day", "protocol", "start_date_pst", "uuid", "subscription_sequence"),
    "protocol": ("date_day", "start_date_pst", "uuid", "subscription_sequence"),
}


def _against_yesterday(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What began on the day, against the day before of the same subscription."""
    same = _yesterday(keys)
    known = F.col("uuid").isNotNull()
    cancelled_before = exists(F.max(F.when(known, F.col("is_cancelled_today"))).over(same))
    paused_before = exists(F.max(F.when(known, F.col("is_paused"))).over(same))
    there_before = F.count(F.when(known, 1)).over(same) > 0
    return rows.withColumns(
        {
            "cancelled_today": F.col("is_cancelled_today") & ~cancelled_before,
            "paused_today": F.col("is_paused") & ~paused_before,
            "is_new_subscription": known & ~there_before,
        }
    )


def active_flag(flags: DataFrame) -> DataFrame:
    """Whether the subscription counts as active on the day."""
    active = (
        F.when(F.col("is_paused") & ~F.col("is_cancelled_today"), True)
        .when(F.col("has_future_intended_cancellation"), True)
        .when(
            F.col("has_old_transaction") | F.col("has_billing_issue") | F.col("is_past_renewal_date"), False
        )
        .otherwise(~F.col("is_cancelled") & F.col("has_transaction_within_past_year"))
    )
    return flags.withColumn("is_active", exists(active))


def protocol_transitions(active: DataFrame) -> DataFrame:
    """Reactivation and instalment changes against yesterday's row of the user and protocol.

    A join and not a window: where two subscriptions of one protocol share a day,
    each of yesterday's rows gives a row. Hand in a frame that was cut or written,
    since both sides read it.
    """
    before = active.select(
        "admin_user_id",
        "protocol",
        F.date_add("date_day", 1).alias("date_day"),
        F.col("is_active").alias("_was_active"),
        F.col("is_bnpl").alias("_was_bnpl"),
    )
    packed = _packed(active, [*_SPOT, "uuid", "subscription_sequence", "is_active", "is_bnpl"])
    joined = left_join(packed, before, _SPOT, ["uuid", "date_day", "subscription_sequence"])
    return (
        _unpacked(joined, active.columns)
        .withColumn("reactivated_today", exists(~F.col("_was_active") & F.col("is_active")))
        .withColumn("became_bnpl_today", exists((F.col("_was_bnpl") == "No") & (F.col("is_bnpl") == "Yes")))
        .withColumn("exited_bnpl_today", exists((F.col("_was_bnpl") == "Yes") & (F.col("is_bnpl") == "No")))
        .drop("_was_active", "_was_bnpl")
    )


def period_start(day: str, period: str) -> Column:
    """First day of the ``week`` (from Monday) or ``month`` the day lies in."""
    return F.to_date(F.date_trunc("week", day)) if period == "week" else F.trunc(day, "month")


def period_to_date_flag(keys: Sequence[str], flag: str, start: str, order: Sequence[str]) -> Column:
    """Whether ``flag`` was set on any row of the period so far (this row included).

    ``start`` is the column with the first day of the period. It has to be a column
    of its own: windows over the same expression would not share a partitioning.
    """
    so_far = (
        Window.partitionBy(*keys, start)
        .orderBy(*[F.col(c).asc_nulls_first() for c in order])
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return F.max(F.when(F.col(flag), 1).otherwise(0)).over(so_far) == 1


_DAY_ORDER = ["date_day", "protocol", "start_date_pst", "uuid"]
_USER, _USER_PROTOCOL = ["admin_user_id"], ["admin_user_id", "protocol"]


def period_to_date(transitions: DataFrame) -> DataFrame:
    """All sixteen period-to-date flags.

    New-user flags follow the user, new-protocol flags the user and protocol,
    transitions both. Per period the windows of the user come first: rows
    partitioned by (user, period) already serve those of (user, protocol, period),
    which leaves one shuffle per period.
    """
    new = {"user": "is_new_user", "sub": "is_new_protocol_user"}
    stems = ("reactivated", "became_bnpl", "exited_bnpl")
    columns = transitions.columns
    transitions = _packed(transitions, [*_DAY_ORDER, *_USER, *new.values(), *(f"{stem}_today" for stem in stems)])
    for period in ("week", "month"):
        transitions = transitions.withColumn("_start", period_start("date_day", period))
        for who, keys in (("user", _USER), ("sub", _USER_PROTOCOL)):
            flags = {f"{new[who]}_this_{period}": new[who]}
            flags |= {f"{stem}_{who}_this_{period}": f"{stem}_today" for stem in stems}
            transitions = transitions.withColumns(
                {name: period_to_date_flag(keys, flag, "_start", _DAY_ORDER) for name, flag in flags.items()}
            )
    return _unpacked(transitions.drop("_start"), columns)


# The columns of the reporting table.
REPORT_COLUMNS = (
    "uuid",
    "date_day",
    "subscription_uuid",
    "admin_user_id",
    "admin_email",
    "protocol",
    "user_protocol",
    "protocol_expanded",
    "product_category_2",
    "subscription_sequence",
    "next_subscription_sequence",
    "start_date",
    "start_dt_pst",
    "start_date_pst",
    "next_start_date",
    "next_start_date_pst",
    "active_mm_plan",
    "mm_plan",
    "billing_cycle_days",
    "subscription_length",
    "subscription_length_int",
    "tenure_months",
    "last_transaction_date",
    "last_transaction_dt",
    "billing_issue_unresolved",
    "renewal_or_end_date",
    "subscription_cancelled",
    "cancellation_reason",
    "system_cancellation_reason",
    "intended_cancellation_date",
    "intended_cancellation_pst",
    "intended_cancellation_dt_pst",
    "has_future_intended_cancellation",
    "pause_at",
    "resume_at",
    "past_pause",
    "past_pause_at",
    "past_resume_at",
    "future_pause",
    "future_pause_at",
    "future_resume_at",
    "is_autocancel",
    "is_active",
    "is_paused",
    "is_cancelled",
    "is_cancelled_today",
    "has_billing_issue",
    "is_active_past_renewal",
    "has_plan_change",
    "has_old_transaction",
    "has_transaction_within_past_year",
    "is_past_renewal_date",
    "paused_today",
    "cancelled_today",
    "reactivated_today",
    "is_bnpl",
    "is_bnpl_fod",
    "contains_bb",
    "contains_appt",
    "is_new_subscription",
    "is_new_user",
    "is_new_protocol_user",
    "is_new_user_this_week",
    "is_new_protocol_user_this_week",
    "is_new_user_this_month",
    "is_new_protocol_user_this_month",
    "became_bnpl_today",
    "exited_bnpl_today",
    "reactivated_user_this_week",
    "reactivated_sub_this_week",
    "reactivated_user_this_month",
    "reactivated_sub_this_month",
    "became_bnpl_user_this_week",
    "became_bnpl_sub_this_week",
    "exited_bnpl_user_this_week",
    "exited_bnpl_sub_this_week",
    "became_bnpl_user_this_month",
    "became_bnpl_sub_this_month",
    "exited_bnpl_user_this_month",
    "exited_bnpl_sub_this_month",
    "switch_lag",
    "current_date_pst",
)


def subscription_report(flags: DataFrame) -> DataFrame:
    """Names, keys and local times of the reporting table."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return (
        flags.withColumnRenamed("uuid", "subscription_uuid")
        .withColumns(
            {
                "uuid": F.md5(F.concat(text("date_day"), text("subscription_uuid"))),
                "user_protocol": F.concat(text("admin_user_id"), text("protocol")),
                "protocol_expanded": F.when(
                    F.col("product_category_2").isin(*ENCLOMIPHENE_PRODUCTS), ENCLOMIPHENE
                ).otherwise(F.col("protocol")),
                "subscription_length_int": rounded_long(F.col("subscription_length")),
                "switch_lag": F.datediff("next_start_date_pst", "start_date_pst"),
            }
        )
        .withColumns(
            {
                "start_dt_pst": local_date(F.col("start_date"), BUSINESS_ZONE),
                "start_date_pst": local_datetime(F.col("start_date"), BUSINESS_ZONE),
            }
        )
        .select(*REPORT_COLUMNS)
    )
