"""Bronze -> silver per domain: dedup, tombstones, gates, normalisation.

Gate and dedup order differs by domain on purpose: bookings dedup first, so
a bad newest version quarantines the key; seat holds and promotions gate
first, so the newest *good* version wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee import contracts as C
from marquee.operators.cdc import drop_tombstones, keys_present, latest_by_key
from marquee.operators.quality import FAILURES, Rule, failed_rules, gate, passes_all
from marquee.sources.landing import CORRUPT


def _present(col: str) -> str:
    return f"{col} IS NOT NULL"


def _known(col: str, allowed: tuple[str, ...]) -> str:
    return f"{col} IN ({', '.join(repr(v) for v in allowed)})"


# Rule predicates are SQL text, resolved against the frame when applied.
BOOKING_RULES = [
    Rule("booking_id_present", _present("booking_id")),
    Rule("user_id_present", _present("user_id")),
    Rule("show_id_present", _present("show_id")),
    Rule("num_seats_positive", "num_seats IS NOT NULL AND num_seats > 0"),
    Rule("total_amount_non_negative", "total_amount IS NOT NULL AND total_amount >= 0"),
    Rule("booking_status_known", _known("booking_status", C.BOOKING_STATUSES)),
]

PAYMENT_RULES = [
    Rule("payment_id_present", _present("payment_id")),
    Rule("booking_id_present", _present("booking_id")),
    Rule("amount_non_negative", "amount IS NOT NULL AND amount >= 0"),
]

SEAT_HOLD_RULES = [
    Rule("show_id_present", _present("show_id")),
    Rule("seat_no_present", _present("seat_no")),
    Rule("hold_status_known", _known("hold_status", C.HOLD_STATUSES)),
]

PROMOTION_RULES = [
    Rule("promotion_id_present", _present("promotion_id")),
    Rule("discount_type_known", _known("discount_type", C.DISCOUNT_TYPES)),
    Rule("discount_value_positive", "discount_value IS NOT NULL AND discount_value > 0"),
    Rule("status_known", _known("status", C.PROMOTION_STATUSES)),
]

REDEMPTION_RULES = [
    Rule("redemption_id_present", _present("redemption_id")),
    Rule("promotion_id_present", _present("promotion_id")),
    Rule("booking_id_present", _present("booking_id")),
    Rule("discount_amount_non_negative", "discount_amount IS NOT NULL AND discount_amount >= 0"),
]

RULES = {
    "bookings": BOOKING_RULES,
    "payments": PAYMENT_RULES,
    "seat_holds": SEAT_HOLD_RULES,
    "promotions": PROMOTION_RULES,
    "promotion_redemptions": REDEMPTION_RULES,
    **{e: [Rule(f"{k}_present", _present(k)) for k in C.KEYS[e]] for e in ("users", "venues", "movies", "shows")},
}
#: the newest valid version of a key stands for it; elsewhere the newest version does, valid or not
GATE_FIRST = ("seat_holds", "promotions")
#: columns that a valid row has in upper case and without spaces around
NORMALISED = {"bookings": "booking_status", "payments": "payment_status"}


# fixed values: the declared expectations of the silver tables
EXPECTATIONS = {
    "silver_bookings": {"valid_booking_id": "booking_id IS NOT NULL", "valid_amount": "total_amount >= 0"},
    "silver_payments": {"valid_booking_ref": "booking_id IS NOT NULL"},
    "silver_seat_holds": {"valid_show_and_seat": "show_id IS NOT NULL AND seat_no IS NOT NULL"},
    "silver_promotion_redemptions": {"valid_refs": "promotion_id IS NOT NULL AND booking_id IS NOT NULL"},
}


PARSE_FAILURE = "record_parsed"


def split_parsed(df: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Separate malformed landed lines (``_corrupt_record`` set) from parsed
    rows. A malformed line is not a version of any key: it goes straight to
    quarantine and never takes part in a dedup."""
    if CORRUPT not in df.columns:
        return df, None
    malformed = df.filter(F.col(CORRUPT).isNotNull()).withColumn(FAILURES, F.lit(PARSE_FAILURE))
    return df.filter(F.col(CORRUPT).isNull()), malformed


def _with_malformed(
    valid: DataFrame, quarantined: DataFrame, malformed: DataFrame | None
) -> tuple[DataFrame, DataFrame]:
    if malformed is None:
        return valid, quarantined
    return valid.drop(CORRUPT), quarantined.unionByName(malformed)


def _normalise(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.upper(F.trim(F.col(col))))


def latest_bookings(bronze: DataFrame) -> DataFrame:
    """Newest version per booking_id; NULL ids pass through for the gate."""
    return latest_by_key(bronze, C.KEYS["bookings"], C.version_order("bookings"), null_keys="bypass")


def clean_bookings(
    bronze: DataFrame, null_safe: bool = True, normalize_first: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Dedup -> drop tombstones -> gate -> ``upper(trim(status))`` on valid rows.

    The status is checked as landed (``normalize_first=False``), so a padded
    lower-case status is quarantined and the normalisation only shapes the
    valid rows. Rows without a booking_id skip the dedup and go straight to
    quarantine, so the valid side keeps the dedup's hash partitioning on
    booking_id for the joins that follow.
    """
    keys = C.KEYS["bookings"]
    present = keys_present(keys)
    bronze, malformed = split_parsed(bronze)

    def checked(frame: DataFrame) -> tuple[DataFrame, DataFrame]:
        live = drop_tombstones(frame)
        if normalize_first:
            live = _normalise(live, "booking_status")
        return gate(live, BOOKING_RULES, null_safe=null_safe)

    valid, quarantined = checked(
        latest_by_key(bronze, keys, C.version_order("bookings"), null_keys="drop")
    )
    _, unkeyed = checked(bronze.filter(~present))
    return _with_malformed(_normalise(valid, "booking_status"), quarantined.unionByName(unkeyed), malformed)


def _dedup_then_gate(bronze: DataFrame, entity: str, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid newest versions, quarantine): the newest version of a key stands
    for it; rows without a key and malformed lines are quarantined. The valid
    side keeps the dedup's partitioning on the key."""
    keys = C.KEYS[entity]
    parsed, malformed = split_parsed(bronze)
    valid, bad = gate(latest_by_key(parsed, keys, C.version_order(entity), null_keys="drop"), rules)
    _, unkeyed = gate(parsed.filter(~keys_present(keys)), rules)
    return _with_malformed(valid, bad.unionByName(unkeyed), malformed)


def clean_payments(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Dedup on payment_id -> gate on references and amounts -> normalise status."""
    valid, quarantined = _dedup_then_gate(bronze, "payments", PAYMENT_RULES)
    return _normalise(valid, "payment_status"), quarantined


def clean_dimension(bronze: DataFrame, entity: str) -> tuple[DataFrame, DataFrame]:
    """Newest version per key; rows without a key are quarantined."""
    return _dedup_then_gate(bronze, entity, RULES[entity])


def clean_seat_holds(bronze: DataFrame, null_safe: bool = True) -> tuple[DataFrame, DataFrame]:
    """Gate -> latest state per (show_id, seat_no) among the valid events."""
    parsed, malformed = split_parsed(bronze)
    valid, quarantined = gate(parsed, SEAT_HOLD_RULES, null_safe=null_safe)
    return _with_malformed(latest_seat_state(valid), quarantined, malformed)


def latest_seat_state(valid_holds: DataFrame) -> DataFrame:
    return latest_by_key(valid_holds, C.KEYS["seat_holds"], C.version_order("seat_holds"), null_keys="drop")


def clean_promotions(bronze: DataFrame, null_safe: bool = True) -> tuple[DataFrame, DataFrame]:
    """Gate -> newest valid version per promotion_id."""
    parsed, malformed = split_parsed(bronze)
    valid, quarantined = gate(parsed, PROMOTION_RULES, null_safe=null_safe)
    latest = latest_by_key(valid, C.KEYS["promotions"], C.version_order("promotions"), null_keys="drop")
    return _with_malformed(latest, quarantined, malformed)


def clean_redemptions(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Dedup on redemption_id -> gate on references and discounts."""
    return _dedup_then_gate(bronze, "promotion_redemptions", REDEMPTION_RULES)


def clean(bronze: DataFrame, entity: str) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine) of any entity."""
    gates = {
        "bookings": clean_bookings,
        "payments": clean_payments,
        "seat_holds": clean_seat_holds,
        "promotions": clean_promotions,
        "promotion_redemptions": clean_redemptions,
    }
    return gates[entity](bronze) if entity in gates else clean_dimension(bronze, entity)


def judged(newest: DataFrame, entity: str) -> DataFrame:
    """Rows that stand for themselves with ``_dq_failures``, which is NULL for
    the valid ones; deleted bookings are gone and valid statuses normalised."""
    if entity == "bookings":
        newest = drop_tombstones(newest)
    rules = RULES[entity]
    failures = F.when(~passes_all(rules), F.array_join(failed_rules(rules), ","))  # names are for the few that fail
    if CORRUPT in newest.columns:
        failures = F.when(F.col(CORRUPT).isNotNull(), F.lit(PARSE_FAILURE)).otherwise(failures)
    out = newest.withColumn(FAILURES, failures)
    if entity in NORMALISED:
        status = F.col(NORMALISED[entity])
        out = out.withColumn(NORMALISED[entity], F.when(F.col(FAILURES).isNull(), F.upper(F.trim(status))).otherwise(status))
    return out


def alone(bronze: DataFrame, entity: str) -> Column:
    """Whether a row is no version of any key: a malformed line, a row without
    a key, or, where the gate comes before the dedup, one that fails it."""
    out = ~passes_all(RULES[entity]) if entity in GATE_FIRST else ~keys_present(C.KEYS[entity])
    return out | F.col(CORRUPT).isNotNull() if CORRUPT in bronze.columns else out


def checked(bronze: DataFrame, entity: str) -> DataFrame:
    """Both outcomes of an entity's cleaning in one frame: the rows of ``clean``'s
    valid and quarantined side, told apart by ``_dq_failures``.

    Bronze is read once and shuffled once. Rows that are no version of any key
    go through the dedup as groups of their own, dealt evenly by a number that
    each gets, so a mass of rows without a key is no hot group.
    """
    own = F.when(alone(bronze, entity), F.monotonically_increasing_id())
    keys = [*C.KEYS[entity], "_alone"]
    newest = latest_by_key(bronze.withColumn("_alone", own), keys, C.version_order(entity), null_keys="group")
    return judged(newest.drop("_alone"), entity)
