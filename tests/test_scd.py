from datetime import date, datetime

from starwright.operators.keys import number_in_order, seed_unknown, unknown_member
from starwright.operators.quality import duplicate_keys, interval_violations
from starwright.operators.scd import scd1_upsert, scd2_classify, scd2_merge, scd2_replay
from starwright.plans.model import BY_NAME
from starwright.plans.star import seeded_dimension
from tests.tiny import content, frame
from pyspark.sql import functions as F

SELLER = BY_NAME["salesperson"]
OPEN = date(9999, 12, 31)
VERSION = ("employee_id", "job_title", "valid_from", "valid_to", "is_current")


def staged(spark, *rows):
    return frame(spark, "employee_id BIGINT, full_name STRING, job_title STRING", *rows)


def merge(dim, batch, day, strict=False):
    return scd2_merge(
        dim, batch, SELLER.business_key, SELLER.key, SELLER.attributes, day, strict
    )


def loaded(spark):
    batch = staged(spark, (3, "C", "x"), (1, "A", "x"), (2, "B", "x"))
    return merge(seeded_dimension(spark, SELLER), batch, "2024-01-01")


def known(dim):
    return dim.where("employee_id > 0")


def test_new_rows_open_numbered_versions(spark):
    rows = content(loaded(spark), "salesperson_key", "employee_id", "valid_from", "valid_to",
                   "is_current")
    assert rows == [
        (-1, -1, date(1900, 1, 1), OPEN, True),
        (1, 1, date(2024, 1, 1), OPEN, True),
        (2, 2, date(2024, 1, 1), OPEN, True),
        (3, 3, date(2024, 1, 1), OPEN, True),
    ]


def test_the_four_cases(spark):
    # Key 1 unchanged, 2 changed later, 4 new, and 3 absent from the batch.
    batch = staged(spark, (1, "A", "x"), (2, "B", "y"), (4, "D", "x"))
    after = merge(loaded(spark), batch, "2024-02-01")
    assert content(known(after), "salesperson_key", *VERSION) == [
        (1, 1, "x", date(2024, 1, 1), OPEN, True),
        (2, 2, "x", date(2024, 1, 1), date(2024, 2, 1), False),
        (3, 3, "x", date(2024, 1, 1), OPEN, True),
        (4, 2, "y", date(2024, 2, 1), OPEN, True),
        (5, 4, "x", date(2024, 2, 1), OPEN, True),
    ]
    actions = scd2_classify(
        loaded(spark), batch, "employee_id", SELLER.key, SELLER.attributes, "2024-02-01"
    )
    assert content(actions, "employee_id", "action") == [
        (1, "UNCHANGED"), (2, "CHANGED"), (4, "NEW"),
    ]


def test_change_on_the_same_day_overwrites(spark):
    after = merge(loaded(spark), staged(spark, (2, "B", "y"), (0, "Z", "z")), "2024-01-01")
    assert content(known(after).where("employee_id = 2"), "salesperson_key", *VERSION) == [
        (2, 2, "y", date(2024, 1, 1), OPEN, True)
    ]
    # The same-day row takes no number: the new key follows the last one.
    assert content(after.where("employee_id = 0"), "salesperson_key") == [(4,)]


def test_change_and_back_makes_three_versions(spark):
    dim = merge(loaded(spark), staged(spark, (2, "B", "y")), "2024-02-01")
    dim = merge(dim, staged(spark, (2, "B", "x")), "2024-03-01")
    assert content(dim.where("employee_id = 2"), *VERSION[1:]) == [
        ("x", date(2024, 1, 1), date(2024, 2, 1), False),
        ("x", date(2024, 3, 1), OPEN, True),
        ("y", date(2024, 2, 1), date(2024, 3, 1), False),
    ]
    assert interval_violations(dim, "employee_id").isEmpty()
    assert duplicate_keys(dim, ["employee_id", "valid_from"]).isEmpty()
    assert duplicate_keys(dim, ["salesperson_key"]).isEmpty()


def test_a_batch_twice_is_a_batch_once(spark):
    batch = staged(spark, (2, "B", "y"), (4, "D", "x"))
    once = merge(loaded(spark), batch, "2024-02-01")
    assert content(merge(once, batch, "2024-02-01")) == content(once)


def test_null_and_empty_differ_only_when_strict(spark):
    dim = merge(seeded_dimension(spark, SELLER), staged(spark, (1, "A", None)), "2024-01-01")
    same = merge(dim, staged(spark, (1, "A", "")), "2024-02-01")
    assert known(same).count() == 1
    strict = merge(
        seeded_dimension(spark, SELLER), staged(spark, (1, "A", None)), "2024-01-01", True
    )
    changed = merge(strict, staged(spark, (1, "A", "")), "2024-02-01", True)
    assert known(changed).count() == 2


def test_type_one_overwrites_and_keeps_keys(spark):
    spec = BY_NAME["ship_method"]
    columns = "ship_method_id BIGINT, method_name STRING, ship_base DECIMAL(10,2),"
    columns += " ship_rate DECIMAL(10,2)"

    def upsert(dim, *rows):
        return scd1_upsert(
            dim, frame(spark, columns, *rows), spec.business_key, spec.key, spec.attributes
        )

    first = upsert(seeded_dimension(spark, spec), (7, "Air", None, None), (5, "Sea", None, None))
    second = upsert(first, (7, None, None, None), (6, "Rail", None, None))
    assert content(second, "ship_method_key", "ship_method_id", "method_name") == [
        (-1, -1, "Desconhecido"), (1, 5, "Sea"), (2, 7, None), (3, 6, "Rail"),
    ]
    again = upsert(second, (7, None, None, None), (6, "Rail", None, None))
    assert content(again) == content(second)


def test_seeding_twice_keeps_one_unknown_member(spark):
    dim = seeded_dimension(spark, SELLER).withColumn("full_name", F.lit("kept"))
    args = (SELLER.table, SELLER.key, SELLER.business_key, SELLER.unknown)
    assert content(seed_unknown(dim, *args), "full_name") == [("kept",)]
    assert content(unknown_member(dim, *args), "full_name") == [("Desconhecido",)]


def test_numbers_are_dense_and_ordered(spark):
    df = spark.range(0, 10000, 1, 13).select((F.col("id") * 7919 % 10007).alias("k"))
    numbered = number_in_order(df, ["k"], "n", 50)
    ranked = sorted(content(numbered, "k", "n"))
    assert [n for _, n in ranked] == list(range(51, 10051))


def test_replay_equals_daily_merges(spark):
    history = frame(
        spark, "employee_id BIGINT, ts TIMESTAMP_NTZ, full_name STRING, job_title STRING",
        (1, datetime(2024, 1, 1, 8), "A", "x"), (1, datetime(2024, 1, 1, 9), "A", "y"),
        (1, datetime(2024, 1, 2, 8), "A", "y"), (1, datetime(2024, 1, 3, 8), "A", "x"),
        (2, datetime(2024, 1, 2, 8), "B", "x"), (1, datetime(2024, 1, 5, 8), "A", "y"),
    )
    dim = seeded_dimension(spark, SELLER)
    for day in range(1, 6):
        daily = history.where(F.dayofmonth("ts") == day).orderBy("ts").collect()
        last = {r.employee_id: (r.employee_id, r.full_name, r.job_title) for r in daily}
        if last:
            dim = merge(dim, staged(spark, *last.values()), f"2024-01-0{day}")
    replayed = scd2_replay(history, "employee_id", "ts", SELLER.attributes)
    assert content(replayed, *VERSION) == content(known(dim), *VERSION)
